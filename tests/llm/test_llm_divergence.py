"""Source divergence: brute force over small tables, exact cells, edges."""

import random
import re
from collections import Counter, defaultdict

import pytest
from llm_helpers import edge_docs, empty_docs

from lanekit.llm import divergence
from lanekit.llm.common import stage

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, min_docs, top=10):
    """rows: (text, lang, source) -> set of result rows."""
    docs, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        sources[lang].add(source)
    out = set()
    for lang in sources:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = {t: sum(counts[lang, s][t] for s in sources[lang]) for t in kept}

        def p(count, total, kept=kept):
            return 1 + 1_000_000_000 * (count + 2) // (total + 2 * len(kept))

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        probability = {s: {t: p(counts[lang, s][t], sum(counts[lang, s][u] for u in kept)) for t in kept} for s in sources[lang]}
        of_lang = {t: p(whole[t], sum(whole.values())) for t in kept}
        for s in sources[lang]:
            mine = probability[s]
            pairs = [(-sum(f(mine[t], probability[o][t]) for t in kept), o.encode(), o) for o in sources[lang] if o != s]
            terms = [(-f(mine[t], of_lang[t]), t.encode(), t) for t in kept if counts[lang, s][t] and mine[t] > of_lang[t]]
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))}
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:top])}
    return out


def run(df, **kw):
    got = [tuple(r) for r in divergence.audit(df, **kw).select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "delta", "Éa", "éa", "日本", "x1y", "z_w", "long-er", "q"] + [f"t{c}" for c in "abcdefgh"]
    return [(" ".join(rng.choices(words, k=rng.randrange(0, 12))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None]))
            for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 16)       # several blocks a language
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert run(df, min_docs=3) == brute(rows, 3)


def test_many_ties_take_the_first_in_byte_order(spark):
    terms = [a + b for a in "YzaéB" for b in "mnopq"]        # all occur alike: one cell, 25 terms, 10 ranks
    rows = [(" ".join(terms), "en", "a")] * 2 + [("other words here", "en", "b")] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = run(df, min_docs=2)
    assert got == brute(rows, 2)
    assert len({r[4] for r in got if r[1] == "a" and r[2] == "term"}) == 1


def test_held_sums_are_flushed(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_SUMS", 5)
    rows = random_rows(3, 40)
    held = [b for b in divergence._sums(iter(_batches(rows)))]
    assert len(held) > 3
    sums = Counter()
    for b in held:
        for lang, source, term, n, docs in zip(*b.to_pydict().values()):
            sums[lang, source, term] += n
    plain = Counter()
    for text, lang, source in rows:
        for t in divergence.terms_of(text):
            plain[lang or "", source or "", t.decode()] += 1
    assert {k: v for k, v in sums.items() if k[2] is not None} == dict(plain)


def _batches(rows):
    import pyarrow as pa
    for i in range(0, len(rows), 4):
        part = rows[i:i + 4]
        yield pa.RecordBatch.from_pydict({"lang": [r[1] or "" for r in part], "source": [r[2] or "" for r in part],
                                          "text": [r[0] for r in part]})


def test_stripes_of_sources_cover_every_pair(spark):
    rows = [(f"one two {'three ' * (i % 3)}", "en", f"s{i}") for i in range(7)] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    counts = stage(divergence.term_counts(df), "test")
    kept = stage(divergence.kept_terms(counts, 2), "test")
    used = stage(counts.filter("term is not null").join(kept, ["lang", "term"]), "test")
    groups = stage(divergence.group_sizes(counts, kept, used), "test")
    pairs = [tuple(r) for r in divergence.source_gaps(used, groups, width=2).collect()]
    assert sorted((a, s, "pair", i, v, n) for a, s, i, v, n in pairs) == sorted(r for r in brute(rows, 2) if r[2] == "pair")


def test_awkward_rows(spark):
    df = edge_docs(spark, "term string, n bigint, place bigint, total bigint, rank bigint, value bigint")
    rows = [(r.text, r.lang, r.source) for r in df.select("text", "lang", "source").collect()]
    for least in (1, 2, 10):                                 # 10: no kept terms, pairs of value 0
        assert run(df, min_docs=least) == brute(rows, least)


def test_single_source_and_no_rows(spark):
    df = spark.createDataFrame([("a b", "en", "s")] * 3, "text string, lang string, source string")
    assert {r[2] for r in run(df, min_docs=2)} <= {"term"}
    assert run(empty_docs(spark)) == set()


def test_counts_beyond_64_bit_products_stay_exact(spark):
    df = spark.createDataFrame([(10 ** 13, 3 * 10 ** 13, 10 ** 6)], "c long, total long, v long")
    from pyspark.sql import functions as F
    got = df.select(divergence.smoothed(F.col("c"), F.col("total"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (10 ** 13 + 2) // (3 * 10 ** 13 + 2 * 10 ** 6)
