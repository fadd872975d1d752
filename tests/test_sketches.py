import random
from collections import defaultdict
from datetime import date, timedelta

from lanekit.operators import sketches
from conftest import plan_text


def hot_rows(spark, n=60_000):
    """A third of the rows under key 0, values of many kinds."""
    rng = random.Random(3)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 6), i % 4, rng.randrange(40_000), date(2020, 1, 1) + timedelta(rng.randrange(900)),
             rng.lognormvariate(0, 2)) for i in range(n)]
    return data, spark.createDataFrame(data, "k int, part int, v int, d date, x double").repartition(16)


def test_merged_sketches_keep_their_bounds(spark):
    data, df = hot_rows(spark)
    stored = sketches.sketched(df, ["k", "part"], {"vs": "v", "ds": "d"}, {"xs": "x"})
    values = defaultdict(lambda: (set(), set(), []))
    for k, _, v, d, x in data:
        for key in (k, None):
            for kept, value in zip(values[key], (v, d, x)):
                (kept.append if isinstance(kept, list) else kept.add)(value)
    for keys in (["k"], []):
        merged = sketches.merged(stored, keys, ["vs", "ds"], ["xs"])
        assert "Scan" in plan_text(merged) and "x#" not in plan_text(merged)              # no raw rows
        ranks = (0.0, 0.05, 0.5, 0.95, 1.0)
        got = merged.select(*keys, sketches.distinct_estimate("vs").alias("vs"), sketches.distinct_estimate("ds").alias("ds"),
                            sketches.n_values("xs").alias("n"), *[sketches.quantile("xs", r).alias(f"q{i}") for i, r in enumerate(ranks)])
        for row in got.collect():
            vs, ds, xs = values[row.k if keys else None]
            assert abs(row.vs - len(vs)) <= sketches.distinct_error(deviations=5) * len(vs)
            assert abs(row.ds - len(ds)) <= max(1, sketches.distinct_error(deviations=5) * len(ds))
            assert row.n == len(xs)
            for i, r in enumerate(ranks):
                q = row[f"q{i}"]
                assert sum(x < q for x in xs) <= (r + 2 * sketches.rank_error()) * len(xs)
                assert sum(x <= q for x in xs) >= (r - 2 * sketches.rank_error()) * len(xs)


def test_sketches_of_later_rows_are_added(spark):
    first = spark.range(5_000).selectExpr("1 AS k", "id AS v")
    later = spark.range(4_000, 9_000).selectExpr("1 AS k", "id AS v")
    both = sketches.sketched(first, ["k"], {"s": "v"}, {"q": "v"}).unionByName(sketches.sketched(later, ["k"], {"s": "v"}, {"q": "v"}))
    row = sketches.merged(both, ["k"], ["s"], ["q"]).select(sketches.distinct_estimate("s"), sketches.n_values("q")).first()
    assert abs(row[0] - 9_000) <= sketches.distinct_error(deviations=5) * 9_000 and row[1] == 10_000


def test_partial_aggregation_comes_before_the_shuffle(spark):
    _, df = hot_rows(spark, 100)
    text = plan_text(df.groupBy("k").agg(sketches.F.hll_sketch_agg("v"), sketches.F.kll_sketch_agg_double("x")))
    assert text.count("partial_hll_sketch_agg") >= 1 and text.count("partial_kll_sketch_agg_double") >= 1


def test_edge_groups(spark):
    """Null keys, groups of nulls only, NaN, repeated values, no rows."""
    nan = float("nan")
    df = spark.createDataFrame([("a", None, None), ("a", None, nan), (None, "x", 1.0), (None, "x", 1.0), ("b", "", 2.0), ("b", "é", None)],
                               "k string, v string, x double")
    stored = sketches.sketched(df, ["k"], {"s": "v"}, {"q": "x"})
    for table in (stored, sketches.merged(stored, ["k"], ["s"], ["q"])):
        got = {r[0]: tuple(r)[1:] for r in table.select("k", sketches.distinct_estimate("s"), sketches.n_values("q"),
                                                        sketches.quantile("q", 0.5)).collect()}
        assert got == {"a": (0, 0, None), None: (1, 2, 1.0), "b": (2, 1, 2.0)}
    assert sketches.sketched(df.limit(0), ["k"], {"s": "v"}, {"q": "x"}).count() == 0


def test_empty_binaries_and_other_types(spark):
    df = spark.sql("SELECT * FROM VALUES (X'', 1.5D, TRUE), (X'00', 1.5D, FALSE), (X'', -0.5D, NULL) AS t(b, f, t)")
    stored = sketches.sketched(df, [], {"b": "b", "f": "f", "t": "t"})
    assert tuple(stored.select(*[sketches.distinct_estimate(c) for c in "bft"]).first()) == (2, 2, 2)
