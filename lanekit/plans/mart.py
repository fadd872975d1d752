"""Route-segment load-rate mart.

Input: the twelve warehouse tables (shipment fact, stops, locations, hand-over
list header and detail, sites, org hierarchy, code dictionary, waybill and
waybill product, vehicle type and overtime-reason dims) as DataFrames keyed by
their table names. Output: one row per route segment of every shipment in the
statistics window, with segment capacity, departure times, origin/destination
organisation and the per-segment piece, waybill, weight and volume measures.

Plan shape (what Catalyst receives):

* every dimension is filtered to its current rows and projected before any
  join, so both predicates and column lists reach the scans;
* small dimensions are broadcast by the planner's size check (and adaptive
  execution's); only the 4-row vehicle table, bounded by construction, carries
  a hint;
* measures of all waybills and of the product categories come out of one
  pass, reduced step by step before anything wide is touched: detail lines per
  (list, waybill) - the measures are linear in the pieces -, then per list,
  then per leg (task, origin, destination). A key with a large share of the
  detail rows never reaches a join as more than one row per map task;
* a leg's totals and the organisations of its first lists arrive at the
  segments in one join. All segments of one (order, ordinal, route) lie on the
  same leg, so a segment's measure is the leg's total times the number of such
  rows: no second copy of the segments is aggregated and joined back;
* lists with their sums, whole shipments and the few departures that segments
  ask for are dealt by order, once each. Names, organisations and segments are
  made behind that shuffle, and the wide rows do not move again;
* the whole mart is one lazy plan without intermediate tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanekit.functions.columns import (
    SITE_SUFFIX_TOKENS, STOP_SEP, literal_split, prorated, safe_ratio, segment_fields, split_at,
    stop_pattern, strip_tokens)
from lanekit.operators.aggregates import sum_or_zero
from lanekit.operators.filters import OPEN_END, current_rows, half_open, has_prefix, in_list
from lanekit.operators.generators import explode_values
from lanekit.operators.joins import enrich

# Vehicle type -> rated capacity (tonnes) and load volume
# (cubic metres).
VEHICLE_ROWS = (
    ("9.6米", 12, 60),
    ("12.5米", 17, 80),
    ("13.7米", 19, 87),
    ("17.5米", 28, 125),
)

# Transport states kept by the mart, and the one among them
# that means "plan cancelled" (rated capacity and volume count as 0).
KEPT_STATUSES = ("已调度", "计划取消", "在途", "运输完成", "运输完成（手工）", "运输完成（补录）")
CANCELLED_STATUS = "计划取消"

# Shipment id prefix, organisation levels that carry the
# distribution-centre / province names, dictionary type of product codes,
# and the excluded round-trip segment mode.
SHIPMENT_PREFIX = "PD/ANE"
ORG_LEVELS = (5, 7)
PRODUCT_TYPE_CODE = "services_type"
ROUND_TRIP_MODE = "A-B-A-B"

# Product categories with a dedicated settled-weight column.
DEFAULT_CATEGORIES = {
    "mini_big_clac_weight": ("MiNi电商大件", "calc_weight"),
    "mini_small_clac_weight": ("MiNi电商小件", "calc_weight"),
}

# Published mart columns, in order.
MART_COLUMNS = (
    "dt", "stat_date", "shipment_gid", "order_id", "shipment_schedule_id", "car_id",
    "actual_cost", "order_type", "line_type", "please_car_nature", "load_mode", "car_type",
    "rated_capacity_total", "rated_vol_total", "transport_status", "overtime_reason",
    "overtime_son_reason", "plan_start_time", "planned_schedule", "actual_schedule",
    "trans_rodes", "by_road_method", "road_rated_capacity", "road_rated_vol",
    "road_planned_schedule", "road_actual_schedule", "first_rodes", "first_distribute_nm",
    "first_prov_nm", "next_rodes", "next_distribute_nm", "next_prov_nm",
    "road_out_piece_num", "road_ewb_num", "road_calc_weight", "road_operate_weight", "road_vol",
    "mini_big_clac_weight", "mini_small_clac_weight", "dsd_calc_weight", "jzld_piece_num",
    "jzld_calc_weight", "phd_piece_num", "phd_calc_weight", "load_rate",
)

# The warehouse tables the mart reads.
TABLES = (
    "dwd_fact_tms_shipment", "dwd_fact_tms_shipment_stop", "dwd_fact_tms_location",
    "dim_tms_ane_lw_type", "dim_tms_equipment_group", "dwd_fact_lb_hs_ewbs_list_no",
    "dwd_fact_lb_hs_ewbs_list_detail", "dim_hs_basic_site", "dim_dm_pb_bizop_org_brnch",
    "dim_hs_basic_dict", "dwd_fact_hs_opt_ewb", "dwd_fact_hs_opt_ewb_detail",
)


def _one(_load_mode: Column) -> Column:
    return F.lit(1.0)


@dataclass
class MartParams:
    """Everything the original job hard-coded, as parameters. The partition
    date, the statistics date and the window have no defaults: a caller who
    forgets them must not publish all history into one partition."""

    dt: int | str
    stat_date: str
    window_start: str | None                  # plan start >= window_start; None: open
    window_end: str | None                    # plan start <  window_end; None: open
    shipment_prefix: str | None = SHIPMENT_PREFIX
    statuses: tuple | None = KEPT_STATUSES
    cancelled_status: str = CANCELLED_STATUS
    org_levels: tuple = ORG_LEVELS
    product_type_code: str = PRODUCT_TYPE_CODE
    excluded_mode: str | None = ROUND_TRIP_MODE
    open_end: str = OPEN_END
    tokens: tuple = SITE_SUFFIX_TOKENS
    vehicles: tuple = VEHICLE_ROWS
    # output column -> (product name, "calc_weight" | "piece"); columns of
    # MART_COLUMNS that are not configured are published as null.
    categories: Mapping[str, tuple] = field(default_factory=lambda: dict(DEFAULT_CATEGORIES))
    # capacity share of the vehicle used on one segment, from the load mode
    segment_factor: Callable[[Column], Column] = _one
    # optional custom segment rule (load_mode, schedule) -> array<string> of
    # ``mode*from-to*factor*ordinal`` values; None uses the built-in rule
    # without a string round trip
    segment_rule: Callable[[Column, Column], Column] | None = None
    stop_base: int = 1                        # ordinal of the first segment
    load_rate_scale: float = 1.0              # weight unit / capacity unit


# --------------------------------------------------------------------------- dims

def vehicle_dim(spark: SparkSession, rows=VEHICLE_ROWS) -> DataFrame:
    """Literal vehicle table (union of distinct literal rows)."""
    schema = T.StructType([T.StructField("car_type", T.StringType()),
                           T.StructField("capacity", T.IntegerType()),
                           T.StructField("squares", T.IntegerType())])
    return spark.createDataFrame(list(rows), schema).distinct()


def stops(t: Mapping[str, DataFrame], p: MartParams) -> DataFrame:
    loc = current_rows(t["dwd_fact_tms_location"], "end_time", p.open_end) \
        .select("location_gid", strip_tokens("location_name", p.tokens).alias("location_name"))
    st = current_rows(t["dwd_fact_tms_shipment_stop"], "end_time", p.open_end) \
        .select("shipment_gid", "stop_num", "location_gid", "planned_departure", "actual_departure")
    return enrich(st, loc, {"location_gid": "location_gid"}, {"location_name": "location_name"}) \
        .select("shipment_gid", "stop_num", "location_gid", "location_name",
                "planned_departure", "actual_departure")


def list_details(t: Mapping[str, DataFrame], p: MartParams) -> DataFrame:
    return current_rows(t["dwd_fact_lb_hs_ewbs_list_detail"], "end_time", p.open_end) \
        .where(F.col("out_piece") > 0).select("ewbs_list_no", "ewb_no", "out_piece")


def lists(t: Mapping[str, DataFrame], p: MartParams, per_list: DataFrame) -> DataFrame:
    """Hand-over lists with origin/destination site code, cleaned name,
    distribution centre and province, and the list's own measures.

    Joining the per-list measures (one row per list that has detail lines)
    both keeps only lists with detail lines (the original ``IN (select ...)``
    test) and carries the measures, so the detail rows are read once."""
    head = current_rows(t["dwd_fact_lb_hs_ewbs_list_no"], "end_time", p.open_end) \
        .where(F.col("rd_status") == 1) \
        .select("task_no", "ewbs_list_no", "created_time",
                F.col("site_id").cast("string").alias("first_site_id"),
                F.col("next_site_id").cast("string").alias("next_site_id"))
    sites = current_rows(t["dim_hs_basic_site"], "end_time", p.open_end) \
        .select(F.col("site_id").cast("string").alias("site_id"), "site_code",
                strip_tokens("site_name", p.tokens).alias("site_name"))
    org = t["dim_dm_pb_bizop_org_brnch"].select(
        "svth_lvl_org_brnch_id", "fith_lvl_org_brnch_nm", "thrd_lvl_org_brnch_nm", "org_brnch_lvl")
    level_ok = F.col("org_brnch_lvl").isin(list(p.org_levels))
    out = head.join(per_list, "ewbs_list_no", "inner").repartition("task_no")
    for role in ("first", "next"):
        out = enrich(out, sites, {f"{role}_site_id": "site_id"},
                     {"site_code": f"{role}_site_code", "site_name": f"{role}_site_name"})
    for role in ("first", "next"):
        out = enrich(out, org, {f"{role}_site_id": "svth_lvl_org_brnch_id"},
                     {"fith_lvl_org_brnch_nm": f"{role}_distribute_nm",
                      "thrd_lvl_org_brnch_nm": f"{role}_prov_nm"},
                     dim_filter=level_ok)
    return out


def waybills(t: Mapping[str, DataFrame], p: MartParams) -> DataFrame:
    """Waybills with their product name (one row per product row)."""
    dic = current_rows(t["dim_hs_basic_dict"], "end_time", p.open_end) \
        .where(F.col("type_code") == p.product_type_code).select("dict_id", "dict_name")
    ewb = current_rows(t["dwd_fact_hs_opt_ewb"], "end_time", p.open_end) \
        .where(F.col("rd_status") == 1) \
        .select("ewb_no", "calc_weight", "operate_weight", "vol", "piece")
    prod = current_rows(t["dwd_fact_hs_opt_ewb_detail"], "end_time", p.open_end) \
        .select("ewb_no", "services_type_id")
    out = enrich(ewb, prod, {"ewb_no": "ewb_no"}, {"services_type_id": "services_type_id"})
    out = enrich(out, dic, {"services_type_id": "dict_id"}, {"dict_name": "product_name"})
    return out.drop("services_type_id")


# ------------------------------------------------------------------- segments

# Where a shipment lies: by its order, one without an order by its own id.
ORDER_KEY = "__order"


def _shipped(t: Mapping[str, DataFrame], p: MartParams) -> DataFrame:
    s = t["dwd_fact_tms_shipment"].where(F.col("end_point") == p.open_end)
    s = half_open(s, "attribute_date1", p.window_start, p.window_end)
    if p.shipment_prefix:
        s = has_prefix(s, "shipment_gid", p.shipment_prefix)
    if p.statuses is not None:
        s = in_list(s, "attribute13", p.statuses)
    return s.withColumn(ORDER_KEY, F.coalesce("attribute1", "shipment_gid"))


def shipments(spark: SparkSession, t: Mapping[str, DataFrame], p: MartParams) -> DataFrame:
    s = _shipped(t, p).repartition(ORDER_KEY)
    equip = t["dim_tms_equipment_group"].select("equipment_group_gid", "equipment_group_name")
    reason = t["dim_tms_ane_lw_type"].select("code_gid", "category")
    s = enrich(s, equip, {"attribute8": "equipment_group_gid"}, {"equipment_group_name": "car_type"})
    s = enrich(s, vehicle_dim(spark, p.vehicles), {"car_type": "car_type"},
               {"capacity": "__capacity", "squares": "__squares"}, broadcast=True)
    s = enrich(s, reason, {"attribute29": "code_gid"}, {"category": "overtime_reason"})
    s = enrich(s, reason, {"reason_overtime": "code_gid"}, {"category": "overtime_son_reason"})
    cancelled = F.col("attribute13") == p.cancelled_status
    return s.select(
        F.lit(p.stat_date).cast("string").alias("stat_date"),
        "shipment_gid",
        F.col("attribute1").alias("order_id"),
        F.col("attribute4").alias("shipment_schedule_id"),
        F.col("attribute7").alias("car_id"),
        F.col("attribute_number10").alias("actual_cost"),
        F.col("attribute2").alias("order_type"),
        F.col("attribute19").alias("line_type"),
        F.col("attribute14").alias("please_car_nature"),
        F.col("attribute15").alias("load_mode"),
        "car_type",
        F.when(cancelled, F.lit(0)).otherwise(F.col("__capacity")).alias("rated_capacity_total"),
        F.when(cancelled, F.lit(0)).otherwise(F.col("__squares")).alias("rated_vol_total"),
        F.col("attribute13").alias("transport_status"),
        "overtime_reason", "overtime_son_reason",
        F.col("attribute_date1").alias("plan_start_time"),
        F.col("schedule_note").alias("planned_schedule"),
        F.col("attribute5").alias("actual_schedule"),
        F.col("attribute15").alias("__load_mode"),
        ORDER_KEY,
    )


_SHIP_COLS = ("stat_date", "shipment_gid", "order_id", "shipment_schedule_id", "car_id", "actual_cost",
              "order_type", "line_type", "please_car_nature", "load_mode", "car_type",
              "rated_capacity_total", "rated_vol_total", "transport_status", "overtime_reason",
              "overtime_son_reason", "plan_start_time", "planned_schedule", "actual_schedule")


def _ship_cols(ship: DataFrame) -> list[str]:
    return [c for c in (*_SHIP_COLS, ORDER_KEY) if c in ship.columns]


def _segments_by_rule(ship: DataFrame, p: MartParams) -> DataFrame:
    """Custom rule: explode its ``mode*from-to*factor*ordinal`` strings and
    parse them (an index past the end gives null)."""
    arr = ship.select(*_ship_cols(ship), p.segment_rule(F.col("__load_mode"), F.col("actual_schedule"))
                      .alias("__segs"))
    seg = explode_values(arr.where(F.col("__segs").isNotNull()), "__segs", "__segment")
    fields = segment_fields("__segment")
    return seg.select(*_ship_cols(ship), *[v.alias(k) for k, v in fields.items()])


def _segments_builtin(ship: DataFrame, p: MartParams) -> DataFrame:
    """Built-in rule, same values as exploding :func:`route_segments`: the
    stop pattern is computed once per shipment and the segments come from a
    ``posexplode`` of the stop list, so no segment string is built and parsed
    again. Null schedules and schedules with fewer than two stops give no
    segment."""
    stops = literal_split(F.col("actual_schedule"), STOP_SEP)
    base = ship.select(*_ship_cols(ship), stops.alias("__stops"),
                       p.segment_factor(F.col("__load_mode")).cast("double").cast("string")
                       .alias("by_road_method"))
    base = base.select("*", stop_pattern(F.col("__stops")).alias("trans_mode"))
    n = F.size("__stops")
    legs = base.select("*", F.posexplode(F.slice("__stops", 1, F.greatest(n - 1, F.lit(0))))
                       .alias("__pos", "__from"))
    return legs.select(
        *_ship_cols(ship), "trans_mode",
        F.concat(F.col("__from"), F.lit(STOP_SEP), F.get(F.col("__stops"), F.col("__pos") + 1))
        .alias("trans_rodes"),
        "by_road_method",
        (F.col("__pos") + F.lit(p.stop_base)).cast("string").alias("by_road_num"))


def _named_segments(ship: DataFrame, p: MartParams) -> DataFrame:
    seg = _segments_by_rule(ship, p) if p.segment_rule is not None else _segments_builtin(ship, p)
    return seg.select("*", strip_tokens(split_at("trans_rodes", "-", 0), p.tokens).alias("first_rodes"),
                      strip_tokens(split_at("trans_rodes", "-", 1), p.tokens).alias("next_rodes"))


def segments(ship: DataFrame, p: MartParams) -> DataFrame:
    """One row per route segment with its fields, segment capacity and
    cleaned origin/destination names."""
    factor = F.col("by_road_method").try_cast("double")
    return _named_segments(ship, p).select(
        "*",
        (F.col("rated_capacity_total") * factor).alias("road_rated_capacity"),
        (F.col("rated_vol_total") * factor).alias("road_rated_vol"),
    )


def order_departures(t: Mapping[str, DataFrame], stop: DataFrame, p: MartParams) -> DataFrame:
    """The stops at which some segment departs, dealt by order: few narrow
    rows move, the wide segments stay."""
    at = ["shipment_gid", "stop_num", "location_name"]
    ship = _shipped(t, p).select(ORDER_KEY, "shipment_gid", F.col("attribute5").alias("actual_schedule"),
                                 F.col("attribute15").alias("__load_mode"))
    asked = _named_segments(ship, p).select(ORDER_KEY, "shipment_gid", F.col("by_road_num").try_cast("int").alias("stop_num"),
                                            F.col("first_rodes").alias("location_name"))
    # whole stops are compared here, whatever number they have of one shipment
    return stop.select(*at, "planned_departure", "actual_departure") \
        .join(asked.repartition(*at).distinct(), at, "inner").repartition(ORDER_KEY)


def same(a: str, b: str) -> Column:
    """Equal, but not a key to deal rows by: rows that lie by order already
    would be shuffled again for each further key of a join."""
    return F.col(a).between(F.col(b), F.col(b))


def segments_timed(seg: DataFrame, departures: DataFrame, p: MartParams) -> DataFrame:
    """Segments of kept modes with the planned and actual departure of their
    origin stop (a stop recorded several times gives several rows)."""
    if p.excluded_mode is not None:
        # standard SQL: a null mode is dropped as well
        seg = seg.where(F.col("trans_mode") != p.excluded_mode)
    seg = seg.withColumn("__road_no", F.col("by_road_num").try_cast("int"))
    d = departures.select(F.col(ORDER_KEY).alias("__at_order"), F.col("shipment_gid").alias("__gid"), "stop_num", "location_name",
                          F.col("planned_departure").alias("road_planned_schedule"),
                          F.col("actual_departure").alias("road_actual_schedule"))
    return seg.join(d, (F.col(ORDER_KEY) == F.col("__at_order")) & same("__gid", "shipment_gid")
                    & same("stop_num", "__road_no") & same("location_name", "first_rodes"), "left") \
        .drop("__road_no", "__at_order", "__gid", "stop_num", "location_name")


# ------------------------------------------------------------------- measures

MEASURES = ("road_out_piece_num", "ewb_num", "road_calc_weight", "road_operate_weight", "road_vol")


def _category_value(kind: str) -> Column:
    if kind == "piece":
        return F.col("pieces")
    if kind in ("calc_weight", "operate_weight", "vol"):
        return prorated(kind, "piece", "pieces")
    raise ValueError(f"unknown category measure kind {kind!r}")


def measures_per_list(details: DataFrame, ewb: DataFrame, p: MartParams) -> DataFrame:
    """Measures per hand-over list. Detail lines are summed per (list,
    waybill) first, so a hot waybill or list meets the waybill join as one row
    per list. A waybill that is missing still counts its pieces and lines and
    adds null to the weights; one with several products counts once for each."""
    loads = details.groupBy("ewbs_list_no", "ewb_no").agg(
        F.sum("out_piece").alias("pieces"), F.count(F.lit(1)).alias("lines"))
    loads = enrich(loads, ewb, {"ewb_no": "ewb_no"},
                   {"calc_weight": "calc_weight", "operate_weight": "operate_weight",
                    "vol": "vol", "piece": "piece", "product_name": "product_name"})
    return loads.groupBy("ewbs_list_no").agg(
        sum_or_zero("pieces").alias("road_out_piece_num"),
        F.sum(F.when(F.col("ewb_no").isNull(), 0).otherwise(F.col("lines"))).alias("ewb_num"),
        *[F.sum(prorated(w, "piece", "pieces")).alias(out) for w, out in (
            ("calc_weight", "road_calc_weight"), ("operate_weight", "road_operate_weight"), ("vol", "road_vol"))],
        *[F.sum(F.when(F.col("product_name") == F.lit(prod), _category_value(kind))).alias(name)
          for name, (prod, kind) in dict(p.categories).items()],
    )


# What a leg takes from its first list.
FIRST_LIST = ("first_distribute_nm", "first_prov_nm", "next_distribute_nm", "next_prov_nm")


def legs(all_lists: DataFrame, p: MartParams) -> DataFrame:
    """One row per (task, origin name, destination name): the sums of the
    lists' measures, and in ``firsts`` the organisations of the earliest list
    of every (task, origin id, destination id) under these names. The earliest
    list is a minimum over (time, list), so it is found by the same partial
    aggregation as the sums."""
    names = list(MEASURES) + list(p.categories)
    ids, by_name = ["task_no", "first_site_id", "next_site_id"], ["task_no", "first_site_name", "next_site_name"]
    pairs = all_lists.groupBy(*ids, *by_name[1:]).agg(
        *[F.sum(n).alias(n) for n in names],
        F.min(F.struct("created_time", "ewbs_list_no", *FIRST_LIST, *by_name[1:])).alias("first"))
    # an id with several names keeps one first list
    earliest = F.min("first").over(Window.partitionBy(*ids))
    pairs = pairs.withColumn("first", F.when(F.col("first") == earliest, F.col("first")))
    return pairs.groupBy(*by_name).agg(*[F.sum(n).alias(n) for n in names], F.collect_list("first").alias("firsts"))


def with_leg_measures(seg: DataFrame, leg: DataFrame, p: MartParams) -> DataFrame:
    """Segments with their leg's organisations (a row per first list) and
    measures: the leg's totals, once for each row of the same order, ordinal
    and route."""
    names = list(MEASURES) + list(p.categories)
    out = seg.join(leg, (F.col(ORDER_KEY) == F.col("task_no")) & F.col("order_id").isNotNull()
                   & same("first_site_name", "first_rodes") & same("next_site_name", "next_rodes"), "left") \
        .drop("task_no", "first_site_name", "next_site_name")
    out = out.select("*", F.explode_outer("firsts").alias("__first")).drop("firsts")
    # with the order's key the count finds the rows where they lie
    alike = Window.partitionBy(ORDER_KEY, "order_id", "first_rodes", "next_rodes", "by_road_num", "trans_rodes")
    out = out.withColumn("__n", F.count(F.lit(1)).over(alike))
    return out.withColumns({**{c: F.col("__first")[c] for c in FIRST_LIST},
                            **{n: F.col(n) * F.col("__n") for n in names}}).drop("__first", "__n")


# ---------------------------------------------------------------------- mart

def build(spark: SparkSession, tables: Mapping[str, DataFrame], params: MartParams,
          stages: dict | None = None) -> DataFrame:
    """The published mart (``MART_COLUMNS``). ``stages``, when given, receives
    the intermediate DataFrames by name (for inspection and tests)."""
    p, t = params, tables
    per_list = measures_per_list(list_details(t, p), waybills(t, p), p)
    all_lists = lists(t, p, per_list)
    leg = legs(all_lists, p)
    seg = segments_timed(segments(shipments(spark, t, p), p), order_departures(t, stops(t, p), p), p)
    total = with_leg_measures(seg, leg, p)
    if stages is not None:
        stages.update(stops=stops(t, p), per_list=per_list, lists=all_lists, legs=leg, segments=seg,
                      shipments=shipments(spark, t, p), details=list_details(t, p), waybills=waybills(t, p))

    out_cols = []
    for c in MART_COLUMNS:
        if c == "dt":
            out_cols.append(F.lit(p.dt).alias("dt"))
        elif c == "road_ewb_num":
            out_cols.append(F.col("ewb_num").alias("road_ewb_num"))
        elif c == "load_rate":
            out_cols.append((safe_ratio("road_calc_weight", "road_rated_capacity")
                             * F.lit(float(p.load_rate_scale))).alias("load_rate"))
        elif c in total.columns:
            out_cols.append(F.col(c))
        else:
            out_cols.append(F.lit(None).cast("double").alias(c))
    return total.select(*out_cols)
