import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lanekit.llm import mixing
from lanekit.llm.queries import ORACLE, QUERIES
from llm_helpers import edge_docs, empty_docs, words
from oracle_compare import compare, duck


def test_matches_sql(spark):
    res = compare(QUERIES["op8_mix_sources"](spark, SF_SMALL), ORACLE["op8_mix_sources"], duck(SF_SMALL))
    assert res["ok"] and res["types_match"], res


def targets(sizes, weights=(5, 2, 1), epochs=3):
    """Share, cap, share the excess again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        capped = [s for s in open_ if weight[s] * level > epochs * sizes[s]]
        if not capped:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in capped:
            target[s] = float(epochs * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 5, None: 300}, {"a": 10}, {None: 4, "z": 0}, {"x": 7, "y": 7, "z": 7, "zz": 1000, "é": 3},
    {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size bigint, n_docs bigint")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(targets(sizes))


def test_budgets_epochs_and_reruns(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 40 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "tiny").otherwise("rest").alias("source"))
    got = mixing.mix(docs, rows_per_range=16).toPandas()
    again = mixing.mix(docs.repartition(7), rows_per_range=500).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    per = got.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert ((per.taken - per.target).abs() <= 20).all()
    assert (got.taken <= 3 * got["size"]).all() and (got.taken % got["size"] == 0).all()


def test_edge_rows(spark):
    docs = edge_docs(spark)
    got = mixing.mix(docs).collect()
    rows = docs.collect()
    assert sorted((r.doc_id is None, r.doc_id, r["size"]) for r in got) == sorted(
        (r.doc_id is None, r.doc_id, len(words(r.text))) for r in rows)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_rows_of_the_mix(spark):
    docs = edge_docs(spark)
    taken = {}
    for r in mixing.mix(docs).collect():
        if r["size"]:
            taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken // r["size"]
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns
    got = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in taken.items() if v}
    assert mixing.mixed(empty_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op8_mix_sources"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_source_without_ids_meets_its_target(spark):
    # all ids of one source are null (and one id repeats throughout another): texts tell the rows apart
    rows = [(None, " ".join([f"a{i}"] * 10), "a") for i in range(3000)] + [(7, " ".join([f"b{i}"] * 10), "b") for i in range(3000)] \
        + [(i, "c " * 10, "c") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).join(spark.createDataFrame([(30_000,)], "source_size long"), "source_size")
    sums = got.groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    assert len(sums) == 3 and all(abs(r.taken - r.target) <= 10 for r in sums)
