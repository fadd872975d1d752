"""Registered queries over ordered and ranged data: as-of, interval and
inequality joins, row frames over hot groups, cubes. Joined into
:mod:`lanekit.plans.catalog`.

The test tables have orders over seven years and events over one month. The
orders' dates are mapped onto that month (18 minutes a day), so that an order
is a version of its customer's state that events can ask for. A third of the
rows of either side have one key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanekit.operators import lattice, ordered, ranges, sketches
from lanekit.plans.step_functions import Aggregate, call
from lanekit.plans.views import last_view, run_views
from lanekit.sources.incremental import follow_export, read_followed
from lanekit.sources.scratch import scratch_path
from lanekit.sources.tables import load
from lanekit.sources.transfer import export_table, read_definition
from lanekit.streaming import sessions as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = oracle
        return fn
    return deco


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cust, valid_from, o_orderkey, o_orderstatus, cents."""
    return load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey") % 150).cast("long").alias("cust"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("long")
                           * 18 * 60_000_000).cast("timestamp_ntz").alias("valid_from"),
        "o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, cust, ts, event_type, value."""
    return load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("cust"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")


VERSIONS_SQL = """
  versions AS (
    SELECT (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 150 END)::BIGINT AS cust,
           make_timestamp(1704067200000000 + datediff('day', DATE '1995-01-01', o_orderdate::DATE) * 18 * 60000000) AS valid_from,
           o_orderkey, o_orderstatus, round(o_totalprice * 100)::BIGINT AS cents
    FROM orders),
  asked AS (
    SELECT event_id, (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END)::BIGINT AS cust, ts::TIMESTAMP AS ts, event_type, value
    FROM events)"""


# ------------------------------------------------------------------ as-of joins

@register("as_of_join", f"""
  WITH {VERSIONS_SQL},
  latest AS (
    SELECT cust, valid_from, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
    FROM versions GROUP BY cust, valid_from)
  SELECT a.event_id, a.cust, a.ts, v.o_orderkey, v.o_orderstatus
  FROM asked a ASOF LEFT JOIN latest v ON a.cust = v.cust AND a.ts >= v.valid_from""")
def as_of_join(spark, sf_dir):
    """The customer's last order at the time of every event, a null one
    included where there was none yet."""
    events = keyed_events(spark, sf_dir).select("event_id", "cust", "ts")
    return ordered.as_of_join(events, order_versions(spark, sf_dir), ["cust"], "ts", "valid_from",
                              {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"}, tie=["o_orderkey"])


@register("as_of_recent", f"""
  WITH {VERSIONS_SQL},
  latest AS (
    SELECT cust, valid_from, max(o_orderkey) AS o_orderkey, arg_max(cents, o_orderkey) AS cents FROM versions GROUP BY cust, valid_from)
  SELECT a.event_id, a.event_type, v.valid_from, v.o_orderkey, v.cents
  FROM asked a ASOF JOIN latest v ON a.cust = v.cust AND a.ts > v.valid_from
  WHERE v.valid_from >= a.ts - INTERVAL 2 HOUR""")
def as_of_recent(spark, sf_dir):
    """Only orders before the event, two hours old at most; other events go."""
    events = keyed_events(spark, sf_dir).select("event_id", "cust", "ts", "event_type")
    found = ordered.as_of_join(events, order_versions(spark, sf_dir), ["cust"], "ts", "valid_from",
                               {"valid_from": "valid_from", "o_orderkey": "o_orderkey", "cents": "cents"}, tie=["o_orderkey"],
                               how="inner", strict=True, since=lambda t: t - F.expr("INTERVAL 2 HOURS"))
    return found.select("event_id", "event_type", "valid_from", "o_orderkey", "cents")


# --------------------------------------------------------------- row frames

@register("frames_hot", f"""
  WITH {VERSIONS_SQL}
  SELECT cust, o_orderkey, sum(cents) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)::BIGINT AS week,
         max(cents) OVER (w ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS peak, lag(cents, 5) OVER (w) AS fifth_before,
         lead(valid_from, 1) OVER (w) AS valid_to
  FROM versions WINDOW w AS (PARTITION BY cust ORDER BY valid_from, o_orderkey)""")
def frames_hot(spark, sf_dir):
    """Moving sums, lags and leads with a third of all rows under one key;
    groups of over 100 rows go the way of hot groups, in blocks of 64."""
    done = ordered.framed(order_versions(spark, sf_dir), ["cust"], ["valid_from", "o_orderkey"], {
        "week": lambda w: F.sum("cents").over(w.rowsBetween(-6, 0)), "peak": lambda w: F.max("cents").over(w.rowsBetween(-3, 2)),
        "fifth_before": lambda w: F.lag("cents", 5).over(w), "valid_to": lambda w: F.lead("valid_from", 1).over(w)},
        before=6, after=2, block=64, hot_threshold=100)
    return done.select("cust", "o_orderkey", "week", "peak", "fifth_before", "valid_to")


# ------------------------------------------------------------ interval joins

@register("interval_join", f"""
  WITH {VERSIONS_SQL},
  periods AS (SELECT *, lead(valid_from) OVER (PARTITION BY cust ORDER BY valid_from, o_orderkey) AS valid_to FROM versions)
  SELECT a.event_id, a.cust, p.o_orderkey, p.valid_from, p.valid_to
  FROM asked a JOIN periods p ON a.cust = p.cust AND a.ts >= p.valid_from AND (a.ts < p.valid_to OR p.valid_to IS NULL)""")
def interval_join(spark, sf_dir):
    """Every event with the version of its customer whose validity period,
    open for the last one, it falls into."""
    periods = ordered.framed(order_versions(spark, sf_dir), ["cust"], ["valid_from", "o_orderkey"],
                             {"valid_to": lambda w: F.lead("valid_from", 1).over(w)}, after=1)
    events = keyed_events(spark, sf_dir).select("event_id", "cust", "ts")
    met = ranges.interval_join(events, periods.select("cust", "valid_from", "valid_to", "o_orderkey"), ("ts", None),
                               ("valid_from", "valid_to"), ["cust"], "e", "p")
    return met.select("e.event_id", "e.cust", "p.o_orderkey", "p.valid_from", "p.valid_to")


@register("interval_overlap", f"""
  WITH {VERSIONS_SQL},
  stays AS (SELECT event_id, ts, ts + to_microseconds((value * 30000000)::BIGINT) AS until FROM asked),
  offers AS (
    SELECT o_orderkey, cents, valid_from, valid_from + to_minutes(CASE WHEN o_orderkey % 500 = 0 THEN 1440 ELSE 1 + o_orderkey % 5 END) AS ends
    FROM versions)
  SELECT s.event_id, count(*) AS n_offers, sum(o.cents)::BIGINT AS cents, min(o.o_orderkey) AS first_offer
  FROM stays s JOIN offers o ON s.ts < o.ends AND o.valid_from < s.until
  GROUP BY s.event_id""")
def interval_overlap(spark, sf_dir):
    """Stays of seconds to minutes against offers of minutes, some of a day,
    without a key: per stay the offers that it overlaps."""
    stays = keyed_events(spark, sf_dir).select(
        "event_id", "ts", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("value") * 30_000_000).cast("long"))
        .cast("timestamp_ntz").alias("until"))
    minutes = F.when(F.col("o_orderkey") % 500 == 0, F.lit(1440)).otherwise(1 + F.col("o_orderkey") % 5)
    offers = order_versions(spark, sf_dir).select(
        "o_orderkey", "cents", "valid_from", F.timestamp_micros(F.unix_micros(F.col("valid_from").cast("timestamp")) + minutes * 60_000_000)
        .cast("timestamp_ntz").alias("ends"))
    met = ranges.interval_join(stays, offers, ("ts", "until"), ("valid_from", "ends"), left_name="s", right_name="o",
                               measures={"n_offers": ("count", "*"), "cents": ("sum", "cents"), "first_offer": ("min", "o_orderkey")})
    return met.groupBy("s.event_id").agg(F.sum("n_offers").alias("n_offers"), F.sum("cents").alias("cents"),
                                         F.min("first_offer").alias("first_offer"))


# ---------------------------------------------------------- inequality joins

@register("inequality_join", """
  SELECT c_custkey, count(*) AS n_suppliers, min(s_suppkey) AS first_supplier, max(s_acctbal) AS best
  FROM customer JOIN supplier ON c_acctbal < s_acctbal AND c_nationkey >= s_nationkey
  GROUP BY c_custkey""")
def inequality_join(spark, sf_dir):
    """Two inequalities and no key: per customer the suppliers with a larger
    balance from a nation that does not come later."""
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    met = ranges.inequality_join(customers, suppliers, [("c_acctbal", "<", "s_acctbal"), ("c_nationkey", ">=", "s_nationkey")],
                                 left_name="c", right_name="s",
                                 measures={"n_suppliers": ("count", "*"), "first_supplier": ("min", "s_suppkey"), "best": ("max", "s_acctbal")})
    return met.groupBy("c.c_custkey").agg(F.sum("n_suppliers").alias("n_suppliers"), F.min("first_supplier").alias("first_supplier"),
                                          F.max("best").alias("best"))


@register("inequality_keyed", """
  SELECT a.c_custkey AS richer, b.c_custkey AS later, a.c_nationkey AS nation
  FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment
   AND a.c_acctbal > b.c_acctbal AND a.c_custkey <= b.c_custkey""")
def inequality_keyed(spark, sf_dir):
    """Within a nation and market segment: pairs of customers whose earlier
    one has the larger balance."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    met = ranges.inequality_join(c, c, [("c_acctbal", ">", "c_acctbal"), ("c_custkey", "<=", "c_custkey")],
                                 ["c_nationkey", "c_mktsegment"], "a", "b")
    return met.select(F.col("a.c_custkey").alias("richer"), F.col("b.c_custkey").alias("later"), F.col("a.c_nationkey").alias("nation"))


# --------------------------------------------------------------------- cubes

_CUBE_SQL = """
  SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10 AS lane,
         grouping(l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10) AS grouping_id, count(*) AS n_lines,
         sum(l_quantity::BIGINT)::BIGINT AS quantity, min(l_shipdate) AS first_ship, max(l_extendedprice) AS dearest
  FROM lineitem GROUP BY {sets}"""


def _lines(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber", (F.col("l_suppkey") % 10).alias("lane"),
        F.col("l_quantity").cast("long").alias("quantity"), "l_shipdate", "l_extendedprice")


_DIMS = ("l_returnflag", "l_linestatus", "l_linenumber", "lane")
_MEASURES = {"n_lines": ("count", "*"), "quantity": ("sum", "quantity"), "first_ship": ("min", "l_shipdate"),
             "dearest": ("max", "l_extendedprice")}


@register("cube_lattice", _CUBE_SQL.format(sets="CUBE (l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10)"))
def cube_lattice(spark, sf_dir):
    """All 16 groupings of four dimensions from one scan of lineitem."""
    return lattice.grouped(_lines(spark, sf_dir), _DIMS, _MEASURES, lattice.cube(_DIMS))


@register("rollup_lattice", _CUBE_SQL.format(sets="ROLLUP (l_returnflag, l_linestatus, l_linenumber, l_suppkey % 10)"))
def rollup_lattice(spark, sf_dir):
    return lattice.grouped(_lines(spark, sf_dir), _DIMS, _MEASURES, lattice.rollup(_DIMS))


# --------------------------------------------------------- distinct counts

@register("distinct_counts", """
  SELECT flag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_shipdate) AS days,
         count(DISTINCT l_comment_like) AS kinds
  FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS flag,
               l_returnflag || l_linenumber AS l_comment_like FROM lineitem)
  GROUP BY flag""")
def distinct_counts(spark, sf_dir):
    """Four exact distinct counts per supplier, with a third of the rows under
    one key."""
    li = load(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).cast("long").alias("flag"), "l_partkey", "l_orderkey",
        "l_shipdate", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("kind"))
    return lattice.distinct_counts(lattice.value_sets(li, ["flag"], {"parts": "l_partkey", "orders": "l_orderkey", "days": "l_shipdate",
                                                                     "kinds": "kind"}), ["flag"])


@register("distinct_merged", """
  SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_shipdate) AS days
  FROM lineitem GROUP BY l_returnflag""")
def distinct_merged(spark, sf_dir):
    """Exact distinct counts of a coarser grouping, merged from the stored sets
    of a finer one without another look at the rows."""
    li = load(spark, sf_dir, "lineitem")
    stored = lattice.value_sets(li, ["l_returnflag", "l_linestatus", "l_linenumber"], {"parts": "l_partkey", "days": "l_shipdate"})
    return lattice.distinct_counts(stored, ["l_returnflag"])


# ------------------------------------------------------------------ sketches

def _line_sketches(spark, sf_dir):
    """Sketches per supplier, flag and status, with a third of the rows under
    one supplier."""
    li = load(spark, sf_dir, "lineitem").withColumn(
        "supplier", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey") % 5 + 1).cast("long"))
    stored = sketches.sketched(li, ["supplier", "l_returnflag", "l_linestatus"], {"parts": "l_partkey", "days": "l_shipdate"},
                               {"price": "l_extendedprice"})
    return li, sketches.merged(stored, ["supplier"], ["parts", "days"], ["price"])


@register("sketch_distinct", """
  SELECT supplier, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_shipdate) AS days, TRUE AS parts_near, TRUE AS days_near
  FROM (SELECT *, (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey % 5 + 1 END)::BIGINT AS supplier FROM lineitem)
  GROUP BY supplier""")
def sketch_distinct(spark, sf_dir):
    """Distinct counts of suppliers merged from stored sketches of a finer
    grouping, held against the exact ones: ``_near`` says that the estimate is
    within the documented error."""
    li, coarse = _line_sketches(spark, sf_dir)
    exact = lattice.distinct_counts(lattice.value_sets(li, ["supplier"], {"parts": "l_partkey", "days": "l_shipdate"}), ["supplier"])
    found = coarse.select("supplier", *[sketches.distinct_estimate(c).alias(f"{c}_found") for c in ("parts", "days")])
    near = [(F.abs(F.col(f"{c}_found") - F.col(c)) <= F.greatest(F.lit(1.0), sketches.distinct_error(deviations=5) * F.col(c)))
            .alias(f"{c}_near") for c in ("parts", "days")]
    return exact.join(found, "supplier").select("supplier", "parts", "days", *near)


_RANKS = (0.1, 0.5, 0.99)


@register("sketch_quantiles", """
  SELECT supplier, count(l_extendedprice) AS n_lines, TRUE AS p10_near, TRUE AS p50_near, TRUE AS p99_near
  FROM (SELECT *, (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey % 5 + 1 END)::BIGINT AS supplier FROM lineitem)
  GROUP BY supplier""")
def sketch_quantiles(spark, sf_dir):
    """Price quantiles of suppliers merged from stored sketches: the number of
    values is exact, and ``_near`` says that the share of the supplier's rows
    below each quantile is within twice the documented error."""
    li, coarse = _line_sketches(spark, sf_dir)
    found = coarse.select("supplier", sketches.n_values("price").alias("n_lines"),
                          *[sketches.quantile("price", r).alias(f"p{round(100 * r)}") for r in _RANKS])
    price = F.col("l_extendedprice").cast("double")
    counts = [f(F.when(op, 1)) for r in _RANKS for f, op in (
        (F.count, price < F.col(f"p{round(100 * r)}")), (F.count, price <= F.col(f"p{round(100 * r)}")))]
    names = [f"{side}{round(100 * r)}" for r in _RANKS for side in ("below", "upto")]
    # a row per supplier joins the lines, which are summed up before any shuffle
    ranked = li.join(found, "supplier").groupBy("supplier", "n_lines").agg(*[c.alias(n) for c, n in zip(counts, names)])
    slack = 2 * sketches.rank_error()
    near = [((F.col(f"below{p}") <= (r + slack) * F.col("n_lines") + 1) & (F.col(f"upto{p}") >= (r - slack) * F.col("n_lines") - 1))
            .alias(f"p{p}_near") for r in _RANKS for p in (round(100 * r),)]
    return ranked.select("supplier", "n_lines", *near)


# ------------------------------------------------------- incremental restores

@register("incremental_restore", "SELECT * FROM orders")
def incremental_restore(spark, sf_dir):
    """Orders exported in two parts and restored as they arrive, two files a
    batch; a third run finds nothing new."""
    out = scratch_path(spark, "incremental")
    orders = load(spark, sf_dir, "orders")
    parts = {"first": F.col("o_orderkey") % 3 == 0, "later": F.col("o_orderkey") % 3 != 0}
    for name, part in parts.items():
        src = export_table(spark, orders.filter(part), f"{out}/{name}", name="orders")
        follow_export(spark, f"{out}/*/orders", f"{out}/restored", f"{out}/noted", read_definition(spark, src), files_per_batch=2)
    follow_export(spark, f"{out}/*/orders", f"{out}/restored", f"{out}/noted", read_definition(spark, src), files_per_batch=2)
    return read_followed(spark, f"{out}/restored").drop("batch_id")


# ------------------------------------------------------------------- sessions

_ARRIVALS = 3
_GAP, _LATE_BY = 20, 2 * 24 * 60          # minutes


def _session_sql() -> str:
    """The stream's rule, batch by batch: rows whose window ended by the
    watermark are late, the others meet the sessions that are still open."""
    parts = ["""
  asked AS (
    SELECT (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END)::BIGINT AS cust, ts::TIMESTAMP AS ts, round(value * 100)::BIGINT AS cents,
           least(3, (day(ts) - 1) // 10 + 1 + (CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)) AS arrival
    FROM events)""", """
  open0 AS (SELECT 0::BIGINT AS cust, NULL::TIMESTAMP AS started, NULL::TIMESTAMP AS ended, 0::BIGINT AS n, 0::BIGINT AS cents WHERE false)"""]
    mark = f"(SELECT max(ts) FROM asked WHERE arrival {{}} {{}}) - INTERVAL {_LATE_BY} MINUTE"
    for i in range(1, _ARRIVALS + 1):
        parts.append(f"""
  timely{i} AS (
    SELECT cust, ts AS started, ts + INTERVAL {_GAP} MINUTE AS ended, 1::BIGINT AS n, cents FROM asked
    WHERE arrival = {i} AND ts + INTERVAL {_GAP} MINUTE > coalesce({mark.format('<', i)}, TIMESTAMP '1970-01-01')
    UNION ALL SELECT * FROM open{i - 1}),
  met{i} AS MATERIALIZED (
    SELECT cust, min(started) AS started, max(ended) AS ended, sum(n)::BIGINT AS n, sum(cents)::BIGINT AS cents
    FROM (SELECT *, sum(CASE WHEN started <= before THEN 0 ELSE 1 END) OVER (PARTITION BY cust ORDER BY started, ended, n, cents
                                                                            ROWS UNBOUNDED PRECEDING) AS run
          FROM (SELECT *, max(ended) OVER (PARTITION BY cust ORDER BY started, ended, n, cents
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM timely{i}))
    GROUP BY cust, run),
  closed{i} AS (SELECT * FROM met{i} WHERE ended <= {mark.format('<=', i)}),
  open{i} AS (SELECT * FROM met{i} WHERE ended > {mark.format('<=', i)})""")
    closed = " UNION ALL ".join(f"SELECT * FROM closed{i}" for i in range(1, _ARRIVALS + 1))
    return f"""
  WITH {','.join(parts)},
  closed AS ({closed}),
  counts AS (SELECT (SELECT count(*) FROM asked) AS arrived, (SELECT coalesce(sum(n), 0) FROM closed)::BIGINT AS ended,
                    (SELECT coalesce(sum(n), 0) FROM open{_ARRIVALS})::BIGINT AS waiting)
  SELECT 'closed' AS part, cust, started, ended, n AS n_events, cents FROM closed
  UNION ALL SELECT 'open', NULL, NULL, NULL, waiting, NULL FROM counts
  UNION ALL SELECT 'late', NULL, NULL, NULL, arrived - ended - waiting, NULL FROM counts"""


@register("session_windows", _session_sql())
def session_windows(spark, sf_dir):
    """Sessions of events that arrive in three parts, a tenth of them one part
    late: those that ended, and the numbers of rows that are in open sessions
    or came too late. A third of the rows have one key."""
    out = scratch_path(spark, "sessions")
    events = (keyed_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
              .withColumn("cents", F.round(F.col("value") * 100).cast("long")))
    part = F.least(F.lit(_ARRIVALS), F.expr("(day(ts) - 1) div 10 + 1") + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    settings = dict(keys=["cust"], time="ts", gap=f"{_GAP} minutes", measures={"cents": F.sum("cents")})
    columns = events.select("cust", "ts", "cents")
    stream = spark.readStream.schema(columns.schema).parquet(f"{out}/arrived/*")
    for i in range(1, _ARRIVALS + 1):
        events.filter(part == i).select(*columns.columns).write.parquet(f"{out}/arrived/{i}")
        S.follow_sessions(S.sessions(stream, late_by=f"{_LATE_BY} minutes", **settings), f"{out}/closed", f"{out}/noted")
    closed = S.read_sessions(spark, f"{out}/closed", S.sessions(columns, **settings))
    counts = S.late_rows(columns, closed, S.open_rows(spark, f"{out}/noted", 1), "ts")
    number = lambda name: counts.select(F.lit(name).alias("part"), F.col(f"n_{name}").alias(S.ROWS))
    plain = closed.select(F.lit("closed").alias("part"), "cust", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "ended")],
                          S.ROWS, "cents")
    return plain.unionByName(number("open"), allowMissingColumns=True).unionByName(number("late"), allowMissingColumns=True)


# ------------------------------------------------------ functions of SQL steps

def three_dearest(key: str = "bigint") -> Aggregate:
    """The three largest different numbers, largest first, joined by ``|``."""
    first = lambda numbers: sorted(set(numbers), reverse=True)[:3]

    def add(state, v):
        if state is None:
            return [] if v is None else [v]
        # most rows change nothing: nothing is sorted for them
        return state if v is None or len(state) == 3 and v <= state[-1] else first([*state, v])
    return Aggregate(add, lambda a, b: first(a + b), lambda state: "|".join(map(str, state)), "string", key)


@register("step_aggregate", """
  WITH lines AS (SELECT (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END)::BIGINT AS key,
                        round(l_extendedprice * 100)::BIGINT AS value FROM lineitem),
  turns AS (SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY value DESC) AS turn FROM (SELECT DISTINCT * FROM lines))
  SELECT key AS supplier, string_agg(value::VARCHAR, '|' ORDER BY value DESC) AS dearest FROM turns WHERE turn <= 3 GROUP BY key""")
def step_aggregate(spark, sf_dir):
    """A Python aggregate in a SQL step, summed up in the tasks that read the
    rows; a third of these have one key."""
    load(spark, sf_dir, "lineitem").createOrReplaceTempView("step_lines")
    rows = """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0L ELSE CAST(l_suppkey AS BIGINT) END AS key,
                     CAST(round(l_extendedprice * 100) AS BIGINT) AS value FROM step_lines"""
    return last_view(run_views(spark, [
        ("dearest_lines", call("three_dearest", rows)),
        ("dearest_named", "SELECT key AS supplier, result AS dearest FROM dearest_lines")],
        aggregates={"three_dearest": three_dearest()}))


class FirstAlerts:
    """Of a group's rows in order of time, those at least two hours after the
    last that was taken."""

    def __init__(self):
        self.last = None

    def eval(self, row):
        if self.last is None or row["ts"] - self.last >= 2 * 3_600_000_000:
            self.last = row["ts"]
            yield row["event_id"], row["cust"], row["ts"]


@register("step_table_function", """
  WITH RECURSIVE asked AS (
    SELECT event_id, (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END)::BIGINT AS cust, epoch_us(ts) AS ts, ts::DATE AS day FROM events),
  taken AS (
    SELECT cust, day, min(ts) AS ts FROM asked GROUP BY cust, day
    UNION ALL
    SELECT t.cust, t.day, min(a.ts) FROM taken t JOIN asked a ON a.cust = t.cust AND a.day = t.day AND a.ts >= t.ts + 7200000000
    GROUP BY t.cust, t.day)
  SELECT min(event_id) AS event_id, cust, ts FROM taken JOIN asked USING (cust, day, ts) GROUP BY cust, ts""")
def step_table_function(spark, sf_dir):
    """A Python table function in a SQL step, called per customer and day on
    rows in order: alerts with a pause of two hours or more."""
    keyed_events(spark, sf_dir).createOrReplaceTempView("step_events")
    return last_view(run_views(spark, [
        ("alert_rows", "SELECT event_id, cust, unix_micros(CAST(ts AS TIMESTAMP)) AS ts, CAST(ts AS DATE) AS day FROM step_events"),
        ("alerts", "SELECT * FROM first_alerts(TABLE(alert_rows) PARTITION BY (cust, day) ORDER BY (ts, event_id))")],
        table_functions={"first_alerts": (FirstAlerts, "event_id: bigint, cust: bigint, ts: bigint")}))
