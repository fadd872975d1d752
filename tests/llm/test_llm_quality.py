from collections import Counter

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL
from lanekit.llm import quality
from lanekit.llm.queries import QUERIES
from llm_helpers import edge_docs, empty_docs, words


def brute(text):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeat = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat))


def test_measures_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    texts = docs.text.tolist() + [r.text for r in edge_docs(spark).collect()] + ["a b c a b c", "x\nx\n\n\nx", "a a a a"]
    for t in texts:
        assert quality.measures(t and t.encode())[:5] == brute(t)


def test_query_result(spark):
    got = QUERIES["op1_quality_rules"](spark, SF_SMALL).toPandas()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    failed = (got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)
    assert (failed == got.base_failed).all() and not (got.kept & got.base_failed).any()


def test_agrees_with_labels(spark):
    """Junk of every kind goes, clean prose stays."""
    d = "/root/testdata/sf0.01"
    got = QUERIES["op1_quality_rules"](spark, d).toPandas().merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id")
    judged = got[~got.base_failed]
    assert (judged.kept == (judged.quality == 1)).mean() > 0.98


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.8, 0.7])
    right = rng.random((len(good), 4)) < accuracy
    votes = np.where(right == good[:, None], 1, -1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float), rounds=2000)
    assert abs(model.good_share - 0.7) < 0.03
    assert np.abs(model.accuracies() - accuracy).max() < 0.04


def test_no_documents_no_verdict():
    model = quality.estimate(np.zeros((0, 3), np.int64), np.zeros(0))
    assert model.good_share == 0.5 and np.allclose(model.votes, 1 / 3)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = quality.judged(docs.withColumn("copy", docs.text), "q").collect()
    assert len(got) == docs.count()
    for r in got:
        if not (r["copy"] or "").strip(" \t\n"):
            assert r.q.n_words == 0 and r.q.base_failed and not r.q.kept
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.judged(empty_docs(spark), "q").count() == 0


@pytest.mark.parametrize("ids, expected", [([], 0), ([1, 2, 3], 0), ([1, 1, 1, 1], 4), ([1, 2, 3, 9, 1, 2, 3], 6)])
def test_repeated_words(ids, expected):
    assert quality.repeated_words(np.array(ids, np.int64)) == expected


def test_rules_do_not_turn_against_long_texts(spark):
    """Texts from one Zipf vocabulary get the same votes, whatever their length."""
    rng = np.random.default_rng(1)
    vocabulary = np.array(["".join(rng.choice(list("abcdefgh"), k)) for k in rng.integers(2, 9, 20_000)])
    share = 1 / (np.arange(20_000) + 20.0)
    words_of = [rng.choice(vocabulary, n, p=share / share.sum()) for n in (400, 5_000, 60_000)]
    assert len(set(words_of[2])) / 60_000 < 0.25
    rows = [quality.measures(" ".join(w).encode()) for w in words_of]
    m = spark.createDataFrame(rows, ", ".join(f"{x} bigint" for x in quality.MEASURES))
    rules = [r for r in quality.RULES if r.name in ("distinct_words", "repeated_windows")]
    for r in m.select(*[x.vote(m).alias(x.name) for x in rules]).collect():
        assert r.distinct_words == 1 and r.repeated_windows >= 0


def test_distinct_words_over_the_whole_text():
    ids = np.concatenate([np.arange(500), np.zeros(500, np.int64), np.arange(250)])
    assert quality.distinct_words(ids) == (1500, 500 + 1 + 250)
    assert quality.distinct_words(ids[:3]) == (3, 3) and quality.distinct_words(ids[:0]) == (0, 0)


def test_short_words_are_counted_in_letters():
    at = quality.MEASURES.index("n_short_words")
    assert quality.measures("и на два слова the cats 日本語 日本語文".encode())[at] == 5
