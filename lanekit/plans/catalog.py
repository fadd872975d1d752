"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or data Spark derives from them), plus the equivalent DuckDB
SQL used as the correctness oracle.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame; doubles
that are sums or ratios are rounded to 2 digits in both the query and its
oracle, since float sums depend on the order of addition.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanekit.plans import mart as M
from lanekit.plans import mart_sql
from lanekit.plans.standins import standin_params, standin_warehouse
from lanekit.plans.views import last_view, run_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# Half-way values (x.xx5) are common here (2-decimal prices divided by small
# piece counts); two sums that differ only in the last bit would round apart,
# so both sides add the same tiny nudge before rounding.
NUDGE = 1e-7


def stable_round(c, digits: int = 2):
    return F.round(c + F.lit(NUDGE), digits)


def sql_round(expr: str, digits: int = 2) -> str:
    return f"round(({expr}) + {NUDGE}, {digits})"


def round_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    return df.select(*[stable_round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ------------------------------------------------------------------ flagship

def load_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load-rate mart over the stand-in inputs (unrounded)."""
    return M.build(spark, standin_warehouse(spark, sf_dir), standin_params())


@register("route_load_mart", mart_sql.duckdb_oracle(2))
def route_load_mart(spark, sf_dir):
    return round_doubles(load_mart(spark, sf_dir), 2)


@register("view_steps", mart_sql.duckdb_oracle(2))
def view_steps(spark, sf_dir):
    """The same mart as ordered SQL steps over the input tables, with one
    disabled and one blank step that must be skipped."""
    from lanekit.plans.views import Step
    for name, df in standin_warehouse(spark, sf_dir).items():
        df.createOrReplaceTempView(name)
    steps = [Step(n, s) for n, s in mart_sql.spark_steps()]
    steps.insert(3, Step("x_disabled", "SELECT * FROM no_such_table", enabled=False))
    steps.insert(5, Step("", "   ", description="blank step"))
    return last_view(run_views(spark, steps))


@register("mart_publish", mart_sql.duckdb_oracle(2))
def mart_publish(spark, sf_dir):
    """From steps to the published table: the mart's SQL steps, its columns
    appended as ORC to a table partitioned by ``dt``, and read back."""
    db = X.scratch_database(spark, "lk_mart")
    X.publish(view_steps(spark, sf_dir), f"{db}.mart", cluster=False)      # the steps give one dt
    return spark.table(f"{db}.mart").select(*M.MART_COLUMNS)


# ---------------------------------------------------------------- helpers

def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from lanekit.sources.tables import load
    return load(spark, sf_dir, name)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spread when they arrive in fewer splits than cores: each
    text explodes into many lines, so the per-line work needs the tasks."""
    from lanekit.sources.tables import spread
    return spread(_t(spark, sf_dir, "documents"))


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Literal token lists used by the text queries (part names of the test data).
PART_NAME_TOKENS = ("small ", "large ", "hot ", "cold ")
REWRITE_RULES = (("the", "THE"), ("THE ", "the_"), ("and", "&"))
LINE_FILTER = "e"


# ---------------------------------------------------------------- scans / projections

from lanekit.functions import columns as C  # noqa: E402
from lanekit.operators import aggregates as A  # noqa: E402
from lanekit.operators import filters as FL  # noqa: E402
from lanekit.operators import generators as G  # noqa: E402
from lanekit.operators import joins as J  # noqa: E402
from lanekit.operators import projections as P  # noqa: E402
from lanekit.operators import windows as W  # noqa: E402
from lanekit.sources import transfer as X  # noqa: E402
from lanekit.sources.scratch import scratch_path  # noqa: E402


@register("scan_project", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def scan_project(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@register("rename_cast", """
    SELECT cast(c_custkey AS VARCHAR) AS cust_id, c_name AS cust_name,
           cast(c_nationkey AS VARCHAR) AS nation_id, '2022-01-23 12:00:00' AS stat_date,
           20220123 AS dt
    FROM customer""")
def rename_cast(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return P.project(c, {
        "cust_id": F.col("c_custkey").cast("string"),
        "cust_name": "c_name",
        "nation_id": F.col("c_nationkey").cast("string"),
        "stat_date": F.lit("2022-01-23 12:00:00"),
        "dt": F.lit(20220123),
    })


@register("case_measure", """
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS rated_total
    FROM orders""")
def case_measure(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    P.zero_when(F.col("o_orderstatus") == "P", "o_totalprice").alias("rated_total"))


@register("derive_month", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dt,
           substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) AS month
    FROM orders""")
def derive_month(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("dt"))
    return P.derive_month(o, "dt", "month")


# ---------------------------------------------------------------- filters

@register("current_rows", """
    SELECT o_orderkey, o_orderstatus, end_time FROM (
      SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'F' THEN '2021-06-30' ELSE '9999-12-31' END AS end_time
      FROM orders) t
    WHERE end_time = '9999-12-31'""")
def current_rows(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", F.lit("2021-06-30")).otherwise(F.lit(FL.OPEN_END)).alias("end_time"))
    return FL.current_rows(o, "end_time")


@register("filter_conjunction", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 25""")
def filter_conjunction(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.where(FL.all_of(F.col("l_returnflag") == "R", F.col("l_linestatus") == "F",
                              F.col("l_quantity") > 25)) \
        .select("l_orderkey", "l_linenumber", "l_quantity")


@register("filter_half_open", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'""")
def filter_half_open(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return FL.half_open(o, "o_orderdate", F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"),
                        F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))


@register("filter_prefix", """
    SELECT page_id, url FROM pages WHERE substr(url, 1, 8) = 'https://'""")
def filter_prefix(spark, sf_dir):
    return FL.has_prefix(_t(spark, sf_dir, "pages").select("page_id", "url"), "url", "https://")


@register("filter_in_list", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderstatus IN ('F', 'O')""")
def filter_in_list(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    o = FL.in_list(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])
    return FL.in_list(o, "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderpriority")


@register("filter_nulls", """
    SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE l.l_orderkey IS NULL""")
def filter_nulls(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return J.keep_missing(o, _t(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"})


@register("filter_not_equal", """
    SELECT o.o_orderkey, l.l_linenumber, l.l_returnflag
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE l.l_returnflag != 'R'""")
def filter_not_equal(spark, sf_dir):
    """``!=`` under three-valued logic: orders without lines (null flag) are
    dropped along with the 'R' lines."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    li = _t(spark, sf_dir, "lineitem")
    j = J.enrich(o, li, {"o_orderkey": "l_orderkey"},
                 {"l_linenumber": "l_linenumber", "l_returnflag": "l_returnflag"})
    return j.where(F.col("l_returnflag") != "R")


# ---------------------------------------------------------------- literal dim / union

def _vehicle_values_sql(extra_dup: bool = True) -> str:
    from lanekit.plans.standins import STANDIN_VEHICLES
    rows = list(STANDIN_VEHICLES) + ([STANDIN_VEHICLES[0]] if extra_dup else [])
    return " UNION ".join(f"SELECT {_q(n)} AS car_type, {c} AS capacity, {s} AS squares" for n, c, s in rows)


@register("inline_dim", f"""
    {_vehicle_values_sql()}
    UNION SELECT o_orderpriority AS car_type, 0 AS capacity, 0 AS squares FROM orders""")
def inline_dim(spark, sf_dir):
    """UNION (distinct) of a literal table holding a duplicate row and rows
    derived from orders (many duplicates)."""
    from lanekit.plans.standins import STANDIN_VEHICLES
    lit = M.vehicle_dim(spark, tuple(STANDIN_VEHICLES) + (STANDIN_VEHICLES[0],))
    derived = _t(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("car_type"), F.lit(0).alias("capacity"), F.lit(0).alias("squares"))
    return lit.unionByName(derived).distinct()


# ---------------------------------------------------------------- scalar text functions

@register("strip_tokens", f"""
    SELECT p_partkey, p_name,
           {"".join("replace(" for _ in PART_NAME_TOKENS)}p_name{"".join(f", {_q(t)}, '')" for t in PART_NAME_TOKENS)}
             AS base_name
    FROM part""")
def strip_tokens(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", C.strip_tokens("p_name", PART_NAME_TOKENS).alias("base_name"))


@register("split_positional", """
    SELECT p_partkey,
           string_split(p_name, ' ')[1] AS word0, string_split(p_name, ' ')[2] AS word1,
           string_split(p_name, ' ')[3] AS word2, string_split(p_brand, '#')[2] AS brand_no,
           string_split(p_brand, '#')[4] AS brand_missing
    FROM part""")
def split_positional(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey",
                    C.split_at("p_name", " ", 0).alias("word0"), C.split_at("p_name", " ", 1).alias("word1"),
                    C.split_at("p_name", " ", 2).alias("word2"), C.split_at("p_brand", "#", 1).alias("brand_no"),
                    C.split_at("p_brand", "#", 3).alias("brand_missing"))


_ROUTE_SQL = "concat_ws('-', c.c_mktsegment, n.n_name, r.r_name)"


def _duck_segments(sched: str, factor: str = "1.0") -> str:
    return mart_sql.duckdb_segments(sched, factor)


def _customer_routes(spark, sf_dir, null_segment: str | None = None) -> DataFrame:
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    c = J.enrich(c, n, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"}, how="inner")
    c = J.enrich(c, r, {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}, how="inner")
    route = F.concat_ws("-", "c_mktsegment", "n_name", "r_name")
    if null_segment is not None:
        route = F.when(F.col("c_mktsegment") == null_segment, F.lit(None).cast("string")).otherwise(route)
    return c.select("c_custkey", route.alias("route"))


@register("route_segments", f"""
    SELECT c_custkey, route, array_to_string(segs, '|') AS segments, CAST(len(segs) AS INTEGER) AS n_segments FROM (
      SELECT c.c_custkey, {_ROUTE_SQL} AS route, {_duck_segments(_ROUTE_SQL)} AS segs
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey) t""")
def route_segments(spark, sf_dir):
    cr = _customer_routes(spark, sf_dir).withColumn("segs", C.route_segments("route"))
    return cr.select("c_custkey", "route", F.array_join("segs", "|").alias("segments"),
                     F.size("segs").alias("n_segments"))


_NULL_ROUTE_SQL = f"CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE {_ROUTE_SQL} END"


@register("explode_segments", f"""
    SELECT c_custkey, seg AS segment, string_split(seg, '*')[1] AS trans_mode,
           string_split(seg, '*')[2] AS trans_rodes, string_split(seg, '*')[4] AS by_road_num
    FROM (SELECT c_custkey, unnest(segs) AS seg FROM (
      SELECT c.c_custkey, {_duck_segments(_NULL_ROUTE_SQL)} AS segs
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey) t WHERE segs IS NOT NULL) u""")
def explode_segments(spark, sf_dir):
    """One market segment's routes are null, to meet the null test."""
    cr = _customer_routes(spark, sf_dir, null_segment="AUTOMOBILE").withColumn("segs", C.route_segments("route"))
    ex = G.explode_values(cr.where(F.col("segs").isNotNull()), "segs", "segment")
    f = C.segment_fields("segment")
    return ex.select("c_custkey", "segment", f["trans_mode"].alias("trans_mode"),
                     f["trans_rodes"].alias("trans_rodes"), f["by_road_num"].alias("by_road_num"))


@register("flatmap_lines", """
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(0, len(string_split(text, chr(10))))) AS line_no
      FROM documents) t""")
def flatmap_lines(spark, sf_dir):
    d = _texts(spark, sf_dir).select("doc_id", "text")
    return G.flat_map_lines(d, "text", "line", with_position=True).select("doc_id", "line_no", "line")


@register("line_tokens", r"""
    SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
           lower(regexp_replace(translate(line, '`''"', ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) AS clean,
           regexp_split_to_array(regexp_replace(line, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), '\s+')[1] AS first_tok
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(0, len(string_split(text, chr(10))))) AS line_no
          FROM (SELECT doc_id, text FROM documents UNION ALL
                SELECT -doc_id, chr(9) || ' ' || replace(text, ' ', chr(9)) || chr(13) || ' ' FROM documents) d) t""")
def line_tokens(spark, sf_dir):
    """Each text also in a form with tabs and carriage returns."""
    d = _texts(spark, sf_dir).select("doc_id", "text")
    d = d.union(d.select(-F.col("doc_id"), F.concat(
        F.lit("\t "), F.translate("text", " ", "\t"), F.lit("\r "))))
    lines = G.flat_map_lines(d, "text", "line", with_position=True)
    return lines.select("doc_id", "line_no", C.clean_line("line").alias("clean"),
                        C.first_token("line").alias("first_tok"))


def _rewrite_sql(expr: str) -> str:
    for old, new in REWRITE_RULES:
        expr = f"replace({expr}, {_q(old)}, {_q(new)})"
    return expr


@register("rewrite_text_rules", f"""
    SELECT {_rewrite_sql('line')} AS value FROM (
      SELECT unnest(string_split(text, chr(10))) AS line FROM documents) t
    WHERE contains(line, {_q(LINE_FILTER)})""")
def rewrite_text_rules(spark, sf_dir):
    """Documents are written as a text dataset, read back line by line, the
    lines holding a literal are kept and ordered replacement rules applied."""
    path = scratch_path(spark, "text_lines")
    _texts(spark, sf_dir).select("text").write.mode("overwrite").option("lineSep", "\n").text(path)
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.where(F.col("value").contains(LINE_FILTER))
    return lines.select(C.rewrite_text("value", REWRITE_RULES).alias("value"))


# ---------------------------------------------------------------- joins

@register("left_join_single", """
    SELECT o.o_orderkey, c.c_name, c.c_mktsegment
    FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = o.o_custkey""")
def left_join_single(spark, sf_dir):
    """The right side is filtered so that some orders find no match."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return J.enrich(o, c, {"o_custkey": "c_custkey"}, {"c_name": "c_name", "c_mktsegment": "c_mktsegment"}) \
        .select("o_orderkey", "c_name", "c_mktsegment")


@register("left_join_composite", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, k.dup_count
    FROM lineitem l LEFT JOIN (
      SELECT l_orderkey AS k1, l_linenumber AS k2, l_returnflag AS k3, count(*) AS dup_count
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber, l_returnflag) k
    ON k.k1 = l.l_orderkey AND k.k2 = l.l_linenumber AND k.k3 = l.l_returnflag""")
def left_join_composite(spark, sf_dir):
    """Keys of closed lines only, so that some lines find no match."""
    li = _t(spark, sf_dir, "lineitem")
    keys = li.where(F.col("l_linestatus") == "F").groupBy("l_orderkey", "l_linenumber", "l_returnflag") \
        .agg(F.count(F.lit(1)).alias("dup_count"))
    return J.enrich(li.select("l_orderkey", "l_linenumber", "l_returnflag"), keys,
                    {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_returnflag": "l_returnflag"},
                    {"dup_count": "dup_count"})


@register("left_join_residual", """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_type = 'LARGE'""")
def left_join_residual(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = _t(spark, sf_dir, "part")
    return J.enrich(li, p, {"l_partkey": "p_partkey"}, {"p_name": "p_name"}, dim_filter=F.col("p_type") == "LARGE")


@register("role_playing_join", """
    SELECT l.l_orderkey, l.l_linenumber, sn.n_name AS supp_nation, cn.n_name AS cust_nation
    FROM lineitem l
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN nation sn ON cast(sn.n_nationkey AS VARCHAR) = cast(s.s_nationkey AS VARCHAR)
    LEFT JOIN nation cn ON cast(cn.n_nationkey AS VARCHAR) = cast(c.c_nationkey AS VARCHAR)""")
def role_playing_join(spark, sf_dir):
    """The nation dimension joined twice under two roles, keys aligned by a
    cast to string on both sides."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    s = _t(spark, sf_dir, "supplier")
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer")
    nat = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("nkey"), "n_name")
    x = J.enrich(li, s, {"l_suppkey": "s_suppkey"}, {"s_nationkey": "s_nationkey"})
    x = J.enrich(x, o, {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey"})
    x = J.enrich(x, c, {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"})
    x = x.withColumn("s_nk", F.col("s_nationkey").cast("string")).withColumn("c_nk", F.col("c_nationkey").cast("string"))
    x = J.enrich(x, nat, {"s_nk": "nkey"}, {"n_name": "supp_nation"})
    x = J.enrich(x, nat, {"c_nk": "nkey"}, {"n_name": "cust_nation"})
    return x.select("l_orderkey", "l_linenumber", "supp_nation", "cust_nation")


@register("dim_chain", """
    SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def dim_chain(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return J.enrich_chain(o, [
        dict(dim=_t(spark, sf_dir, "customer"), keys={"o_custkey": "c_custkey"},
             columns={"c_name": "c_name", "c_nationkey": "c_nationkey"}),
        dict(dim=_t(spark, sf_dir, "nation"), keys={"c_nationkey": "n_nationkey"},
             columns={"n_name": "n_name", "n_regionkey": "n_regionkey"}),
        dict(dim=_t(spark, sf_dir, "region"), keys={"n_regionkey": "r_regionkey"}, columns={"r_name": "r_name"}),
    ]).select("o_orderkey", "c_name", "n_name", "r_name")


@register("inner_join_chain", """
    SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity, p.p_name
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus
    JOIN part p ON p.p_partkey = l.l_partkey""")
def inner_join_chain(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf_dir, "lineitem")
    p = _t(spark, sf_dir, "part")
    x = J.enrich(o, li, {"o_orderkey": "l_orderkey", "o_orderstatus": "l_linestatus"},
                 {"l_linenumber": "l_linenumber", "l_quantity": "l_quantity", "l_partkey": "l_partkey"}, how="inner")
    x = J.enrich(x, p, {"l_partkey": "p_partkey"}, {"p_name": "p_name"}, how="inner")
    return x.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity", "p_name")


@register("semi_join", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey)""")
def semi_join(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return J.keep_matching(o, _t(spark, sf_dir, "lineitem"), {"o_orderkey": "l_orderkey"})


@register("broadcast_literal_join", f"""
    SELECT o.o_orderkey, o.o_orderpriority, v.capacity, v.squares
    FROM orders o LEFT JOIN ({_vehicle_values_sql(False)}) v ON v.car_type = o.o_orderpriority""")
def broadcast_literal_join(spark, sf_dir):
    from lanekit.plans.standins import STANDIN_VEHICLES
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return J.enrich(o, M.vehicle_dim(spark, STANDIN_VEHICLES), {"o_orderpriority": "car_type"},
                    {"capacity": "capacity", "squares": "squares"}, broadcast=True)


# ---------------------------------------------------------------- aggregates

@register("group_sum", f"""
    SELECT l_returnflag, l_linestatus, l_suppkey,
           {sql_round('sum(coalesce(l_quantity, 0))')} AS sum_qty,
           {sql_round('sum(coalesce(l_extendedprice, 0))')} AS sum_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_suppkey""")
def group_sum(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = li.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(
        A.sum_or_zero("l_quantity").alias("sum_qty"), A.sum_or_zero("l_extendedprice").alias("sum_price"))
    return round_doubles(out)


@register("conditional_count", """
    SELECT o.o_orderkey, cast(sum(CASE WHEN l.l_orderkey IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS line_count
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""")
def conditional_count(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey")
    # lines are counted per order first: a hot order is one row per map task
    per_order = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(A.present_count("l_orderkey").alias("n"))
    j = J.enrich(o, per_order, {"o_orderkey": "l_orderkey"}, {"n": "n"})
    return j.groupBy("o_orderkey").agg(A.sum_or_zero("n").alias("line_count"))


_PRORATE_SQL = "coalesce(p.p_retailprice, 0) / nullif(coalesce(p.p_size - 1, 0), 0) * coalesce(l.l_quantity, 0)"


def _prorate_col() -> F.Column:
    return C.prorated("p_retailprice", F.col("p_size") - 1, "l_quantity")


@register("prorated_sum", f"""
    SELECT l.l_orderkey, {sql_round(f'sum({_PRORATE_SQL})')} AS prorated_weight,
           {sql_round(f"sum({_PRORATE_SQL} * cast('0.5' AS DOUBLE))")} AS prorated_half
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey""")
def prorated_sum(spark, sf_dir):
    """``sum(weight / pieces * qty)`` with a zero divisor (size-1 parts): the
    zero-divisor term is null and skipped; a string factor is cast
    explicitly."""
    li = _t(spark, sf_dir, "lineitem")
    p = _t(spark, sf_dir, "part")
    x = J.enrich(li, p, {"l_partkey": "p_partkey"}, {"p_retailprice": "p_retailprice", "p_size": "p_size"})
    share = _prorate_col()
    out = x.groupBy("l_orderkey").agg(F.sum(share).alias("prorated_weight"),
                                      F.sum(share * F.lit("0.5").cast("double")).alias("prorated_half"))
    return round_doubles(out)


_CATS = {"large_weight": "LARGE", "small_weight": "SMALL", "promo_weight": "PROMO"}


@register("category_pivot_sum", "SELECT l.l_suppkey, " + ", ".join(
    f"{sql_round(f'c_{n}.{n}')} AS {n}" for n in _CATS) + " FROM (SELECT DISTINCT l_suppkey FROM lineitem) l "
    + " ".join(
        f"LEFT JOIN (SELECT l.l_suppkey, sum({_PRORATE_SQL}) AS {n} FROM lineitem l LEFT JOIN part p "
        f"ON p.p_partkey = l.l_partkey AND p.p_type = {_q(v)} GROUP BY l.l_suppkey) c_{n} "
        f"ON c_{n}.l_suppkey = l.l_suppkey" for n, v in _CATS.items()))
def category_pivot_sum(spark, sf_dir):
    """Per-category prorated sums in one pass and one shuffle (the oracle
    runs one left join per category)."""
    li = _t(spark, sf_dir, "lineitem")
    p = _t(spark, sf_dir, "part")
    x = J.enrich(li, p, {"l_partkey": "p_partkey"},
                 {"p_retailprice": "p_retailprice", "p_size": "p_size", "p_type": "p_type"})
    out = A.category_sums(x, ["l_suppkey"], "p_type", {n: (v, _prorate_col()) for n, v in _CATS.items()})
    return round_doubles(out)


@register("distinct_keys", """
    SELECT l_orderkey, l_returnflag FROM lineitem GROUP BY l_orderkey, l_returnflag""")
def distinct_keys(spark, sf_dir):
    return A.distinct_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"])


@register("having_filter", f"""
    SELECT l_suppkey, {sql_round('sum(l_quantity)')} AS total_qty, count(*) AS n_lines
    FROM lineitem GROUP BY l_suppkey HAVING sum(l_quantity) > 15300""")
def having_filter(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    out = A.grouped_having(li, ["l_suppkey"], [F.sum("l_quantity").alias("total_qty"),
                                               F.count(F.lit(1)).alias("n_lines")],
                           F.col("total_qty") > 15300)
    return round_doubles(out)


# ---------------------------------------------------------------- windows / limit

@register("row_number_rank", """
    SELECT o_custkey, o_orderkey, o_orderdate,
           CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST,
                                   o_orderkey ASC NULLS FIRST) AS INTEGER) AS rn
    FROM orders""")
def row_number_rank(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    # groups above the hot threshold are split over many tasks
    return W.rank_rows(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "rn", skew_safe=True)


_SKEWED = "CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END"


@register("row_number_hot", f"""
    SELECT cust, o_orderkey, o_orderdate, o_totalprice, o_orderpriority,
           CAST(row_number() OVER (PARTITION BY cust ORDER BY o_orderdate ASC NULLS FIRST,
                                   o_orderkey ASC NULLS FIRST) AS INTEGER) AS rn
    FROM (SELECT {_SKEWED} AS cust, * FROM orders) t""")
def row_number_hot(spark, sf_dir):
    """A third of all orders under one key, with payload columns: groups of
    over 100 rows go the way of hot groups, the others the ordinary one."""
    o = _t(spark, sf_dir, "orders").select(
        F.expr(_SKEWED).alias("cust"), "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    return W.rank_rows(o, ["cust"], ["o_orderdate", "o_orderkey"], "rn", hot_threshold=100)


@register("first_per_group", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS FIRST,
                                   o_orderkey ASC NULLS FIRST) AS rn FROM orders) t
    WHERE rn = 1""")
def first_per_group(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.first_per_group(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("limit_n", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""")
def limit_n(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice") \
        .orderBy("o_orderkey").limit(100)


# ---------------------------------------------------------------- catalog / export / restore

_ORDERS_TYPES = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))


@register("describe_table", "SELECT col_name, data_type, true AS nullable, ordinal, false AS is_partition, "
          "(SELECT count(*) FROM orders) AS row_count FROM (VALUES " + ", ".join(
              f"({_q(n)}, {_q(t)}, {i + 1})" for i, (n, t) in enumerate(_ORDERS_TYPES))
          + ") v(col_name, data_type, ordinal)")
def describe_table(spark, sf_dir):
    return X.describe_table(spark, _t(spark, sf_dir, "orders"))


@register("profile_preview", """
    SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, n AS row_count
    FROM orders, (SELECT count(*) AS n FROM orders) ORDER BY o_orderdate DESC, orders.o_orderkey LIMIT 20""")
def profile_preview(spark, sf_dir):
    """The latest 20 orders as a profile shows them, beside the row count."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    n = X.describe_table(spark, o).first()["row_count"]
    return X.preview(spark, o, 20, [F.col("o_orderdate").desc(), F.col("o_orderkey")]).withColumn("row_count", F.lit(n).cast("long"))


@register("json_inferred_scan", """
    SELECT c_acctbal, c_custkey, c_mktsegment, c_name, cast(c_nationkey AS BIGINT) AS c_nationkey
    FROM customer""")
def json_inferred_scan(spark, sf_dir):
    out = scratch_path(spark, "json_inferred")
    X.export_table(spark, _t(spark, sf_dir, "customer"), out, name="customer", codec="gzip")
    return X.read_json_inferred(spark, f"{out}/customer/json")


@register("json_roundtrip", "SELECT * FROM orders")
def json_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "json_rt")
    o = _t(spark, sf_dir, "orders")
    # a whole but altered copy, which the next export replaces
    X.export_table(spark, o.withColumn("o_totalprice", -F.col("o_totalprice")), out, name="orders")
    src = X.export_table(spark, o, out, name="orders")
    return X.read_export(spark, src)


@register("json_gzip_roundtrip", "SELECT * FROM lineitem")
def json_gzip_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "json_gz")
    src = X.export_table(spark, _t(spark, sf_dir, "lineitem"), out, name="lineitem", codec="gzip")
    return X.read_export(spark, src)


@register("export_filtered", """
    SELECT * FROM orders WHERE (o_orderstatus = 'O') AND (o_totalprice > 100000)
    ORDER BY o_orderkey LIMIT 100""")
def export_filtered(spark, sf_dir):
    out = scratch_path(spark, "export_filtered")
    src = X.export_table(spark, _t(spark, sf_dir, "orders"), out, name="orders",
                         conditions={"where": ["o_orderstatus = 'O'", "o_totalprice > 100000", " "]},
                         order_by=["o_orderkey"], limit=100)
    return X.read_export(spark, src)


# What each table's rows are compared by, after the round trip: their number
# and the sums of a number and of a text length per table.
EXPORTED = {
    "region": ("r_regionkey", "r_name"), "nation": ("n_regionkey", "n_name"), "customer": ("c_custkey", "c_name"),
    "supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name"), "orders": ("o_custkey", "o_orderpriority"),
    "lineitem": ("l_partkey", "l_returnflag"), "events": ("user_id", "event_type"), "documents": ("n_chars", "text"),
    "embeddings": ("label", None), "pages": ("page_id", "html"), "benchmark": ("item_id", "text"),
    "labels": ("quality", None), "conversations": ("turn", "text"),
}
# Conditions of single tables in the batch; the others are exported whole.
EXPORT_CONDITIONS = {"orders": {"where": ["o_orderstatus = 'O'"]}, "lineitem": {"where": ["l_quantity > 10", "l_tax > 0"]}}


def _table_sums_sql(name: str) -> str:
    number, text = EXPORTED[name]
    where = " AND ".join(EXPORT_CONDITIONS.get(name, {}).get("where", ["true"]))
    return (f"SELECT {_q(name)} AS table_name, count(*) AS row_count, cast(sum({number}) AS BIGINT) AS number_sum, "
            f"cast(sum({f'length({text})' if text else '0'}) AS BIGINT) AS text_length FROM {name} WHERE {where}")


@register("export_all_roundtrip", " UNION ALL ".join(map(_table_sums_sql, EXPORTED)))
def export_all_roundtrip(spark, sf_dir):
    """All tables exported in one batch, two of them with conditions of their
    own, and restored in one batch."""
    out = scratch_path(spark, "export_all")
    db = X.scratch_database(spark, "lk_all")
    dirs = X.export_all(spark, [(t, _t(spark, sf_dir, t)) for t in EXPORTED], out, conditions=EXPORT_CONDITIONS)
    tables = X.restore_all(spark, dirs, targets={t: f"{db}.{t}" for t in EXPORTED})
    sums = []
    for name, table in tables.items():
        number, text = EXPORTED[name]
        length = F.length(text) if text else F.lit(0)
        sums.append(spark.table(table).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(number).cast("long").alias("number_sum"),
            F.sum(length).cast("long").alias("text_length"))
            .select(F.lit(name).alias("table_name"), "row_count", "number_sum", "text_length"))
    return reduce(DataFrame.unionByName, sums)


@register("export_all_values", "SELECT event_type, user_id, ts, value, props FROM events")
def export_all_values(spark, sf_dir):
    """Values of the restored events, timestamps to the microsecond."""
    out, db = scratch_path(spark, "export_values"), X.scratch_database(spark, "lk_val")
    dirs = X.export_all(spark, [("events", _t(spark, sf_dir, "events").select(
        "event_type", "user_id", "ts", "value", "props"))], out, codec="gzip")
    return spark.table(X.restore_all(spark, dirs, targets={"events": f"{db}.events"})["events"])


@register("restore_renamed", "SELECT * FROM customer")
def restore_renamed(spark, sf_dir):
    out = scratch_path(spark, "restore_renamed")
    src_db, dst_db = X.scratch_database(spark, "lk_src"), X.scratch_database(spark, "lk_dst")
    X.save_table(_t(spark, sf_dir, "customer"), f"{src_db}.customer")
    src = X.export_table(spark, f"{src_db}.customer", out)
    table = X.restore_table(spark, src, rename_rules=[(src_db, dst_db), (".customer", ".client")])
    assert table == f"{dst_db}.client", table
    return spark.table(table)


@register("clone_definition", "SELECT * FROM part")
def clone_definition(spark, sf_dir):
    """A table created empty from an export's saved definition (its name and
    location rewritten by rules, its format kept) and filled by name."""
    db, out = X.scratch_database(spark, "lk_clone"), scratch_path(spark, "clone_export")
    p = _t(spark, sf_dir, "part")
    X.save_table(p, f"{db}.part", fmt="orc", location=scratch_path(spark, "clone_part"))
    src = X.export_table(spark, f"{db}.part", out, name=f"{db}.part")
    rules = [(".part", ".part_copy"), ("clone_part", "clone_copy")]
    target, created = X.create_from_export(spark, src, rename_rules=rules, keep_location=True)
    again = X.create_from_export(spark, src, rename_rules=rules, keep_location=True)
    about = X.table_properties(spark, target)
    if (created, again) != (True, (target, False)) or about["Provider"] != "orc" or "clone_copy" not in about["Location"]:
        raise AssertionError((created, again, about))
    X.insert_rows(spark, p.select(*reversed(p.columns)), target)
    return spark.table(target)


@register("catalog_listing", """
    SELECT t.name, 'MANAGED' AS table_type, false AS is_temporary, t.name = 'orders' AS in_use, n.row_count
    FROM (VALUES ('customer'), ('orders')) t(name)
    JOIN (SELECT 'customer' AS name, count(*) AS row_count FROM customer
          UNION ALL SELECT 'orders', count(*) FROM orders) n ON n.name = t.name""")
def catalog_listing(spark, sf_dir):
    """Tables of the current database after switching to it, with row counts
    of tables reached by their bare names."""
    db = X.scratch_database(spark, "lk_use")
    for t in ("customer", "orders"):
        X.save_table(_t(spark, sf_dir, t), f"{db}.{t}")
    before = X.use_database(spark, db)
    try:
        listed = X.list_tables(spark).where(~F.col("is_temporary"))
        counts = reduce(DataFrame.unionByName, [
            spark.table(t).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("counted"), "row_count")
            for t in ("customer", "orders")])
    finally:
        X.use_database(spark, before)
    return J.enrich(listed, counts, {"name": "counted"}, {"row_count": "row_count"}).select(
        "name", "table_type", "is_temporary", (F.col("name") == "orders").alias("in_use"), "row_count")


@register("table_overwrite_roundtrip", "SELECT * FROM supplier")
def table_overwrite_roundtrip(spark, sf_dir):
    db = X.scratch_database(spark, "lk_ow")
    s = _t(spark, sf_dir, "supplier")
    X.save_table(s.withColumn("s_suppkey", -F.col("s_suppkey")), f"{db}.supplier")
    X.save_table(s, f"{db}.supplier")                # overwrite replaces all rows
    return spark.table(f"{db}.supplier")


@register("partitioned_overwrite_roundtrip", """
    SELECT *, strftime(o_orderdate, '%Y%m') AS month FROM orders""")
def partitioned_overwrite_roundtrip(spark, sf_dir):
    db = X.scratch_database(spark, "lk_part")
    out = scratch_path(spark, "part_export")
    o = _t(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
    X.save_table(o, f"{db}.orders", partition_cols=["o_orderstatus", "month"])
    src = X.export_table(spark, f"{db}.orders", out, name="orders")
    table = X.restore_table(spark, src, target=f"{db}.orders_restored")
    return spark.table(table)


@register("dynamic_overwrite_roundtrip", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus
    FROM orders""")
def dynamic_overwrite_roundtrip(spark, sf_dir):
    """Partitioned table by status; a dynamic overwrite replaces only the
    partitions present in the new rows ('P'), the others stay."""
    db = X.scratch_database(spark, "lk_dyn")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    X.save_table(o, f"{db}.orders", partition_cols=["o_orderstatus"])
    changed = o.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    X.save_table(changed, f"{db}.orders", partition_cols=["o_orderstatus"], dynamic=True)
    return spark.table(f"{db}.orders")


@register("orc_append_roundtrip", """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN 20220123 ELSE 20220124 END AS dt
    FROM orders""")
def orc_append_roundtrip(spark, sf_dir):
    db = X.scratch_database(spark, "lk_orc")
    o = _t(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    X.publish(o.where(F.col("o_orderstatus") == "F").select(*cols, F.lit(20220123).alias("dt")), f"{db}.mart")
    X.publish(o.where(F.col("o_orderstatus") != "F").select(*cols, F.lit(20220124).alias("dt")), f"{db}.mart")
    return spark.table(f"{db}.mart")


# ---------------------------------------------------------------- user functions in SQL steps

PROP_K_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION prop_k(props STRING) RETURNS INT
RETURN CAST(get_json_object(props, '$.k') AS INT)
"""


@register("udf_in_sql_step", """
    SELECT event_type, cast(sum(cast(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
           count(*) AS n_events
    FROM events GROUP BY event_type""")
def udf_in_sql_step(spark, sf_dir):
    from lanekit.plans.views import Step
    _t(spark, sf_dir, "events").createOrReplaceTempView("events")
    views = run_views(spark, [
        Step("event_k", "SELECT event_type, prop_k(props) AS k FROM events"),
        Step("event_k_sum", "SELECT event_type, sum(k) AS k_sum, count(*) AS n_events FROM event_k "
                            "GROUP BY event_type"),
    ], udfs={"prop_k": PROP_K_FUNCTION})
    return last_view(views)


# ---------------------------------------------------------------- ordered and ranged data

from lanekit.plans import catalog_ranges  # noqa: E402

QUERIES.update(catalog_ranges.QUERIES)
ORACLE.update(catalog_ranges.ORACLE)
