from pyspark.sql import functions as F

from conftest import optimized_text, plan_text
from lanekit.operators import aggregates as A
from lanekit.operators import filters as FL
from lanekit.operators import generators as G
from lanekit.operators import joins as J
from lanekit.operators import projections as P
from lanekit.operators import windows as W


def test_current_rows_and_half_open(spark):
    df = spark.createDataFrame([(1, "9999-12-31", "2022-01-23 12:00:00"), (1, "2021-01-01", "2022-01-23 12:00:00"),
                                (2, "9999-12-31", "2022-01-24 12:00:00"), (3, "9999-12-31", "2022-01-22 00:00:00")],
                               "id int, end_time string, ts string")
    assert FL.current_rows(df).count() == 3
    got = FL.half_open(df, "ts", "2022-01-23 12:00:00", "2022-01-24 12:00:00").select("id").collect()
    assert sorted(r[0] for r in got) == [1, 1]          # lower bound in, upper bound out
    assert FL.half_open(df, "ts", None, None).count() == 4


def test_prefix_filter_is_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("PD/ANE1",), ("XX",)], "gid string").write.parquet(path)
    df = FL.has_prefix(spark.read.parquet(path), "gid", "PD/ANE")
    assert [r[0] for r in df.collect()] == ["PD/ANE1"]
    assert "StringStartsWith" in plan_text(df)


def test_apply_conditions(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    out = FL.apply_conditions(df, {"having": ["x < 8"], "where": ["x > 2", " ", "x != 5"]})
    assert sorted(r[0] for r in out.collect()) == [3, 4, 6, 7]
    assert FL.apply_conditions(df, None).count() == 10


def test_enrich_residual_keeps_unmatched_left_rows(spark):
    left = spark.createDataFrame([("1",), ("2",), ("3",)], "site string")
    org = spark.createDataFrame([("1", "A", 5), ("1", "B", 3), ("2", "C", 7), ("3", "D", 4)],
                                "id string, name string, lvl int")
    out = J.enrich(left, org, {"site": "id"}, {"name": "org_name"}, dim_filter=F.col("lvl").isin(5, 7))
    assert sorted(tuple(r) for r in out.collect()) == [("1", "A"), ("2", "C"), ("3", None)]


def test_enrich_role_playing_and_null_keys(spark):
    facts = spark.createDataFrame([("1", "2"), ("2", None)], "a string, b string")
    dim = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    out = J.enrich(J.enrich(facts, dim, {"a": "k"}, {"v": "a_v"}), dim, {"b": "k"}, {"v": "b_v"})
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([("1", "2", "x", "y"), ("2", None, "y", None)], key=str)


def test_keep_matching_is_a_semi_join_without_duplicates(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    out = J.keep_matching(df, keys, ["k"])
    assert sorted(r[0] for r in out.collect()) == [1, 3]
    assert "LeftSemi" in optimized_text(out)


def test_existence_tests_reduce_a_hot_right_side(spark):
    """With broadcasts off, a key that holds most of the right side reaches
    the join as one row."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(10).withColumnRenamed("id", "k")
        hot = spark.range(5000).select(F.when(F.col("id") < 4900, 3).otherwise(F.col("id") % 7).cast("long").alias("r"))
        for join, kept in ((J.keep_matching, [0, 1, 2, 3, 4, 5, 6]), (J.keep_missing, [7, 8, 9])):
            out = join(left, hot, {"k": "r"})
            assert sorted(r[0] for r in out.collect()) == kept
            text = plan_text(out)
            assert "HashAggregate" in text.split("Join", 1)[1] and "Broadcast" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_per_group_uses_window_group_limit(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3), (1, "a", 0)], "g int, t string, v int")
    out = W.first_per_group(df, ["g"], ["t", "v"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 0), (2, "c", 3)]
    assert "WindowGroupLimit" in plan_text(out)
    ranked = W.rank_rows(df, ["g"], ["t", "v"])
    assert sorted(r["rn"] for r in ranked.where("g = 1").collect()) == [1, 2, 3]


def test_aggregates(spark):
    df = spark.createDataFrame([("k", "LARGE", 2.0, None), ("k", "SMALL", 3.0, "e1"), ("k", None, None, "e2")],
                               "k string, cat string, v double, ewb string")
    out = df.groupBy("k").agg(A.sum_or_zero("v").alias("s"), A.present_count("ewb").alias("n")).first()
    assert (out["s"], out["n"]) == (5.0, 2)
    cs = A.category_sums(df, ["k"], "cat", {"large": ("LARGE", F.col("v")), "promo": ("PROMO", F.col("v"))}).first()
    assert cs["large"] == 2.0 and cs["promo"] is None       # absent category -> null
    h = A.grouped_having(df, ["k"], [F.count(F.lit(1)).alias("n")], F.col("n") > 5)
    assert h.count() == 0
    assert A.distinct_keys(df, ["k"]).count() == 1


def test_generators(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, arr array<string>")
    out = G.explode_values(df, "arr", "x")
    assert sorted((r["id"], r["x"]) for r in out.collect()) == [(1, "a"), (1, "b")]
    t = spark.createDataFrame([(1, "l1\nl2\n")], "id int, text string")
    lines = G.flat_map_lines(t, "text", with_position=True).select("line_no", "line").collect()
    assert [tuple(r) for r in lines] == [(0, "l1"), (1, "l2"), (2, "")]


def test_projections(spark):
    df = spark.createDataFrame([("20220123", "x")], "dt string, month string")
    assert P.derive_month(df).first()["month"] == "202201"
    df2 = spark.createDataFrame([("x",)], "a string")
    assert P.derive_month(df2).columns == ["a"]           # fires only on a real column
    z = spark.createDataFrame([("P", 12), ("F", 12)], "s string, c int") \
        .select(P.zero_when(F.col("s") == "P", "c").alias("c")).collect()
    assert [r[0] for r in z] == [0, 12]


def test_skew_safe_rank_equals_window(spark):
    # one hot key holding most rows, plus cold keys and null keys
    rows = [("hot", i % 97, i) for i in range(3000)] + [("c1", 1, 1), ("c1", 0, 2)] \
        + [(None, i % 5, i) for i in range(300)] + [("c2", None, 3)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    plain = W.rank_rows(df, ["k"], ["t", "id"], skew_safe=False)
    split = W.rank_rows(df, ["k"], ["t", "id"], skew_safe=True, hot_threshold=100, partitions=7)
    key = lambda r: repr(tuple(r))
    assert sorted(split.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hot_group_of_400k_rows_with_payload(spark):
    """All columns equal the plain window's."""
    df = spark.range(420_000, numPartitions=5).select(
        F.when(F.col("id") % 21 == 0, F.col("id") % 50).otherwise(-1).alias("k"),
        (F.hash("id") % 1000).alias("t"), "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    plain = W.rank_rows(df, ["k"], ["t", "id"], skew_safe=False)
    split = W.rank_rows(df, ["k"], ["t", "id"], hot_threshold=1000, partitions=16)
    assert split.columns == plain.columns and split.count() == 420_000
    assert split.exceptAll(plain).isEmpty()
