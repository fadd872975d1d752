"""Property tests: Spark expressions against brute-force Python on random
small inputs (routes, prorated sums, per-category sums)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lanekit.functions import columns as C
from lanekit.operators import aggregates as A
from lanekit.plans import mart as M

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

stop = st.sampled_from(["HZ", "SH", "BJ", "GZ"])
route = st.one_of(st.none(), st.lists(stop, min_size=0, max_size=5).map(lambda xs: "-".join(xs)))


def brute_segments(sched, factor=1.0, base=1):
    if sched is None:
        return None
    stops = sched.split("-")
    seen = []
    for s in stops:
        if s not in seen:
            seen.append(s)
    mode = "-".join(chr(65 + seen.index(s)) for s in stops)
    return [f"{mode}*{stops[k - 1]}-{stops[k]}*{factor}*{k + base - 1}" for k in range(1, len(stops))]


@SETTINGS
@given(st.lists(route, min_size=1, max_size=12))
def test_route_segments_matches_brute_force(spark, routes):
    df = spark.createDataFrame([(r,) for r in routes], "s string")
    got = [r[0] for r in df.select(C.route_segments("s")).collect()]
    assert got == [brute_segments(r) for r in routes]


@SETTINGS
@given(st.lists(route, min_size=1, max_size=12))
def test_builtin_segment_path_equals_exploded_rule(spark, routes):
    """The mart's posexplode path gives the same rows as exploding and parsing
    the segment strings."""
    rows = [(f"g{i}", r) for i, r in enumerate(routes)]
    ship = spark.createDataFrame(rows, "shipment_gid string, actual_schedule string")
    for c in M._SHIP_COLS:
        if c not in ship.columns:
            ship = ship.withColumn(c, F.lit(None).cast("string"))
    ship = ship.withColumn("__load_mode", F.lit("x"))
    p = M.MartParams(20220123, "2022-01-23 12:00:00", None, None)
    a = M._segments_builtin(ship, p).select("shipment_gid", "trans_mode", "trans_rodes", "by_road_method", "by_road_num")
    p2 = M.MartParams(20220123, "2022-01-23 12:00:00", None, None, segment_rule=lambda mode, sched: C.route_segments(sched))
    b = M._segments_by_rule(ship, p2).select("shipment_gid", "trans_mode", "trans_rodes", "by_road_method", "by_road_num")
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


row = st.tuples(st.sampled_from(["k1", "k2", "k3"]),
                st.one_of(st.none(), st.sampled_from(["LARGE", "SMALL", "PROMO"])),
                st.one_of(st.none(), st.integers(0, 500).map(float)),
                st.one_of(st.none(), st.integers(0, 4)),
                st.one_of(st.none(), st.integers(0, 9)))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=30))
def test_prorated_category_sums_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, cat string, w double, piece int, qty int")
    share = C.prorated("w", "piece", "qty")
    got = {r["k"]: r.asDict() for r in A.category_sums(
        df.withColumn("share", share), ["k"], "cat",
        {"large": ("LARGE", F.col("share")), "small": ("SMALL", F.col("share"))}).collect()}
    total = {r["k"]: r["t"] for r in df.groupBy("k").agg(F.sum(share).alias("t")).collect()}

    exp_cat, exp_tot = defaultdict(dict), {}
    for k, cat, w, piece, qty in rows:
        p = piece or 0
        v = None if p == 0 else (w or 0.0) / p * (qty or 0)
        exp_tot.setdefault(k, None)
        if v is not None:
            exp_tot[k] = (exp_tot[k] or 0.0) + v
        for name, c in (("large", "LARGE"), ("small", "SMALL")):
            exp_cat[k].setdefault(name, None)
            if cat == c and v is not None:
                exp_cat[k][name] = (exp_cat[k][name] or 0.0) + v
    assert set(got) == set(exp_tot)
    for k in got:
        for name in ("large", "small"):
            e, g = exp_cat[k][name], got[k][name]
            assert (e is None and g is None) or abs(e - g) < 1e-6
        e, g = exp_tot[k], total[k]
        assert (e is None and g is None) or abs(e - g) < 1e-6
