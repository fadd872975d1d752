import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from conftest import SF_SMALL
from lanekit.llm import bpe, mixing, quality, simhash, substring
from llm_helpers import edge_docs, empty_docs


def test_registered():
    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "substring dedup", "mixing", "bpe"]
    assert {k.split("_")[0] for k in queries if k.startswith("op")} >= {f"op{n}" for n in range(1, 11)}


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_stages_keep_the_columns(spark, make):
    docs = make(spark)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        done = apply(spark, docs, SF_SMALL)
        assert done.columns == docs.columns and done.schema.simpleString() == docs.schema.simpleString(), name
        done.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_run_matches_the_stages_by_hand(spark):
    """run() against the stages' brute-force versions on the small table."""
    import test_llm_simhash as near
    import test_llm_substring as sub
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality.judged(docs, "q").filter("q.kept").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in kept]
    group = {d: g for (_, d), _, g in near.brute([(d, t) for d, t, _ in rows])}
    rows = [r for r in rows if group[r[0]] == r[0]]
    cut = {r.doc_id: r.text for r in substring.drop_repeats(
        spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id bigint, text string")).collect()}
    removed = {d: n for _, d, _, n, _ in sub.brute([(d, t) for d, t, _ in rows], 20)}
    assert all(len(t.split()) - len(cut[d].split()) == removed[d] for d, t, _ in rows)
    rows = [(d, cut[d], s) for d, _, s in rows]
    taken = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    times = {r.doc_id: r.taken // r["size"] if r["size"] else 0 for r in taken}
    library = Tokenizer.from_file(bpe.default_path())
    wanted = []
    for d, t, _ in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        wanted += [(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(t.encode()).hexdigest())] * times[d]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(wanted)
    assert simhash.SHINGLE == 3 and simhash.MAX_BITS == 2
