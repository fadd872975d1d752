"""Stand-in mart inputs derived from the TPC-H-style tables.

The twelve warehouse tables of the load-rate mart are not available as test
data, so they are derived, by Spark, from the driver's tables. Every stand-in
grows with its source table:

==============================  ===============================================
mart table                      derived from
==============================  ===============================================
dwd_fact_tms_shipment           orders x customer x nation (+ hub nation of the
                                customer's region). Route ``hub-nation-hub``;
                                status = o_orderstatus ('P' = cancelled)
dwd_fact_tms_shipment_stop      lineitem x supplier: stop ``l_linenumber`` at
                                the supplier's nation
dwd_fact_tms_location           nation (current row + one closed older version)
dim_tms_equipment_group         distinct order priorities (vehicle types)
dim_tms_ane_lw_type             region (overtime reason codes)
dwd_fact_lb_hs_ewbs_list_no     one hand-over list per (order, return flag):
                                flags A/N travel hub -> nation, R travels back
dwd_fact_lb_hs_ewbs_list_detail lineitem (waybill = part, pieces = quantity)
dim_hs_basic_site               nation
dim_dm_pb_bizop_org_brnch       nation x region at level 7, plus region rows at
                                level 3 whose ids collide with nation ids
dim_hs_basic_dict               distinct part types
dwd_fact_hs_opt_ewb             part: weight = retail price, pieces = size - 1
                                (size 1 gives a zero divisor)
dwd_fact_hs_opt_ewb_detail      part: product = p_type
==============================  ===============================================

Names carry one of the site suffix tokens chosen by region (region 4: none),
so names only match after :func:`strip_tokens`.

Every predicate of the mart meets rows it drops. By the remainder of a key:
closed versions in each versioned table (with other names or values, so that
keeping one would show), lists and waybills of status 0, lines of 0 pieces,
shipments of another status or id prefix or dated exactly at either end of the
window, ``A-B-A-B`` routes, waybills with two products, and lines whose waybill
is null or missing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanekit.functions.columns import SITE_SUFFIX_TOKENS
from lanekit.operators.filters import OPEN_END
from lanekit.plans.mart import MartParams
from lanekit.sources.scratch import is_kept, kept
from lanekit.sources.tables import Tables, spread

# Vehicle types of the stand-in data are order priorities; '5-LOW' is
# deliberately missing from the vehicle table.
STANDIN_VEHICLES = (
    ("1-URGENT", 12, 60),
    ("2-HIGH", 17, 80),
    ("3-MEDIUM", 19, 87),
    ("4-NOT SPECIFIED", 28, 125),
)

STANDIN_CATEGORIES = {
    "mini_big_clac_weight": ("LARGE", "calc_weight"),
    "mini_small_clac_weight": ("SMALL", "calc_weight"),
    "dsd_calc_weight": ("ECONOMY", "calc_weight"),
    "jzld_piece_num": ("PROMO", "piece"),
    "jzld_calc_weight": ("PROMO", "calc_weight"),
    "phd_piece_num": ("STANDARD", "piece"),
    "phd_calc_weight": ("STANDARD", "calc_weight"),
}


# Statistics window of the stand-ins: some orders lie before, some after it.
WINDOW = ("1996-01-01 00:00:00", "2001-01-01 00:00:00")
CLOSED = "2021-06-30"


def every(column: str, n: int, rest: int = 0) -> Column:
    """Rows whose key leaves ``rest`` when divided by ``n``."""
    return F.col(column) % n == rest


def standin_factor(load_mode: Column) -> Column:
    """Half the vehicle is booked on BUILDING-segment shipments."""
    return F.when(load_mode == F.lit("BUILDING"), F.lit(0.5)).otherwise(F.lit(1.0))


def standin_params(**overrides) -> MartParams:
    kw = dict(dt=20220123, stat_date="2022-01-23 12:00:00",
              window_start=WINDOW[0], window_end=WINDOW[1],
              shipment_prefix="PD/ANE", statuses=("F", "O", "P"), cancelled_status="P",
              vehicles=STANDIN_VEHICLES, categories=dict(STANDIN_CATEGORIES),
              segment_factor=standin_factor)
    kw.update(overrides)
    return MartParams(**kw)


def suffix_for(region_key: Column) -> Column:
    expr = F.lit("")
    for i in reversed(range(len(SITE_SUFFIX_TOKENS))):
        expr = F.when(region_key == F.lit(i), F.lit(SITE_SUFFIX_TOKENS[i])).otherwise(expr)
    return expr


def standin_tables(spark: SparkSession, sf_dir: str,
                   overrides: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    t = Tables(spark, sf_dir, overrides)
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    region = t.region.select("r_regionkey", "r_name")
    open_end = F.lit(OPEN_END)

    named_nation = nation.select("n_nationkey", "n_regionkey",
                                 F.concat(F.col("n_name"), suffix_for(F.col("n_regionkey"))).alias("full_name"))

    location = nation.select(
        F.col("n_nationkey").cast("string").alias("location_gid"),
        F.concat(F.col("n_name"), suffix_for(F.col("n_regionkey"))).alias("location_name"),
        open_end.alias("end_time"),
    ).unionByName(nation.select(
        F.col("n_nationkey").cast("string").alias("location_gid"),
        F.concat(F.col("n_name"), F.lit("_OLD")).alias("location_name"),
        F.lit("2021-06-30").alias("end_time")))

    supp = t.supplier.select("s_suppkey", "s_nationkey")
    # fact inputs get at least default-parallelism tasks (a no-op for inputs
    # that already have that many splits)
    li = spread(t.lineitem)
    stops = li.join(supp, li.l_suppkey == supp.s_suppkey, "inner").select(
        F.concat(F.lit("PD/ANE"), F.col("l_orderkey").cast("string")).alias("shipment_gid"),
        F.col("l_linenumber").alias("stop_num"),
        F.col("s_nationkey").cast("string").alias("location_gid"),
        F.col("l_shipdate").cast("string").alias("planned_departure"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).cast("string").alias("actual_departure"),
        F.when(every("l_orderkey", 5) & (F.col("l_linenumber") == 2), F.lit(CLOSED)).otherwise(open_end)
        .alias("end_time"))

    reason = region.select(F.col("r_regionkey").cast("string").alias("code_gid"),
                           F.col("r_name").alias("category"))
    orders = spread(t.orders)
    equipment = orders.select(F.substring("o_orderpriority", 1, 1).alias("equipment_group_gid"),
                              F.col("o_orderpriority").alias("equipment_group_name")).distinct()

    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    cn = named_nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_regionkey").alias("cn_region"),
                             F.col("full_name").alias("cn_name"))
    hub = named_nation.select(F.col("n_nationkey").alias("hub_key"), F.col("full_name").alias("hub_name"))

    def with_route(facts: DataFrame, cust_cols: list[str]) -> DataFrame:
        """Fact rows (keyed by o_custkey) -> customer -> nation -> hub."""
        x = facts.join(cust.select("c_custkey", *cust_cols),
                       F.col("o_custkey") == F.col("c_custkey"), "inner")
        x = x.join(cn, F.col("c_nationkey") == F.col("cn_key"), "inner")
        return x.join(hub, F.col("cn_region") == F.col("hub_key"), "inner") \
            .withColumn("route", F.when(every("o_orderkey", 7), F.concat_ws("-", "hub_name", "cn_name", "hub_name", "cn_name"))
                        .otherwise(F.concat_ws("-", "hub_name", "cn_name", "hub_name")))

    ship = with_route(orders, ["c_name", "c_nationkey", "c_mktsegment"])
    status = F.when(every("o_orderkey", 11), F.lit("X")).otherwise(F.col("o_orderstatus"))
    planned = (F.when(every("o_orderkey", 19), F.lit(WINDOW[0])).when(every("o_orderkey", 23), F.lit(WINDOW[1]))
               .otherwise(F.col("o_orderdate").cast("string")))
    shipment = ship.select(
        F.concat(F.when(every("o_orderkey", 13), F.lit("XX/ANE")).otherwise(F.lit("PD/ANE")),
                 F.col("o_orderkey").cast("string")).alias("shipment_gid"),
        F.col("o_orderkey").cast("string").alias("attribute1"),
        F.col("o_orderstatus").alias("attribute2"),
        F.col("o_custkey").cast("string").alias("attribute4"),
        F.col("route").alias("attribute5"),
        F.col("c_name").alias("attribute7"),
        F.substring("o_orderpriority", 1, 1).alias("attribute8"),
        status.alias("attribute13"),
        F.col("c_mktsegment").alias("attribute14"),
        F.col("c_mktsegment").alias("attribute15"),
        F.col("o_orderpriority").alias("attribute19"),
        F.col("cn_region").cast("string").alias("attribute29"),
        F.col("o_totalprice").alias("attribute_number10"),
        planned.alias("attribute_date1"),
        F.col("route").alias("schedule_note"),
        F.substring("o_orderpriority", 1, 1).alias("reason_overtime"),
        open_end.alias("end_point"))
    shipment = shipment.unionByName(
        shipment.where(F.col("attribute1").cast("bigint") % 17 == 0).withColumn("end_point", F.lit(CLOSED)))

    list_no = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_returnflag"))
    # list header: one per (order, return flag), pre-aggregated from lineitem
    heads = li.groupBy("l_orderkey", "l_returnflag").agg(F.min("l_shipdate").alias("created"))
    order_route = with_route(orders.select("o_orderkey", "o_custkey"), ["c_nationkey"]) \
        .select("o_orderkey", "cn_key", "hub_key")
    heads = heads.join(order_route, heads.l_orderkey == order_route.o_orderkey, "inner")
    outbound = F.col("l_returnflag") != F.lit("R")
    list_no_df = heads.select(
        F.col("l_orderkey").cast("string").alias("task_no"),
        list_no.alias("ewbs_list_no"),
        F.col("created").cast("string").alias("created_time"),
        F.when(outbound, F.col("hub_key")).otherwise(F.col("cn_key")).cast("bigint").alias("site_id"),
        F.when(outbound, F.col("cn_key")).otherwise(F.col("hub_key")).cast("bigint").alias("next_site_id"),
        F.when(every("l_orderkey", 9, 4), 0).otherwise(1).alias("rd_status"),
        F.when(every("l_orderkey", 10, 3), F.lit(CLOSED)).otherwise(open_end).alias("end_time"))
    waybill = (F.when(every("l_partkey", 29), F.lit(None).cast("string"))
               .when(every("l_partkey", 31), F.concat(F.lit("none"), F.col("l_partkey").cast("string")))
               .otherwise(F.col("l_partkey").cast("string")))
    detail = li.select(list_no.alias("ewbs_list_no"), waybill.alias("ewb_no"),
                       F.when(F.col("l_quantity").cast("int") % 10 == 0, 0).otherwise(F.col("l_quantity").cast("int"))
                       .alias("out_piece"),
                       F.when(F.col("l_linenumber") == 7, F.lit(CLOSED)).otherwise(open_end).alias("end_time"))

    site = named_nation.select(F.col("n_nationkey").cast("bigint").alias("site_id"),
                               F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("site_code"),
                               F.col("full_name").alias("site_name"),
                               open_end.alias("end_time"))
    site = site.unionByName(site.select("site_id", "site_code", F.lit("OLD").alias("site_name"),
                                        F.lit(CLOSED).alias("end_time")))
    org = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("string").alias("svth_lvl_org_brnch_id"),
        F.col("r_name").alias("fith_lvl_org_brnch_nm"),
        F.col("n_name").alias("thrd_lvl_org_brnch_nm"),
        F.lit(7).alias("org_brnch_lvl"),
    ).unionByName(region.select(
        F.col("r_regionkey").cast("string").alias("svth_lvl_org_brnch_id"),
        F.col("r_name").alias("fith_lvl_org_brnch_nm"),
        F.col("r_name").alias("thrd_lvl_org_brnch_nm"),
        F.lit(3).alias("org_brnch_lvl")))

    part = t.part
    dic = part.select(F.col("p_type").alias("dict_id"), F.col("p_type").alias("dict_name")).distinct() \
        .select("dict_id", "dict_name", F.lit("services_type").alias("type_code"), open_end.alias("end_time"))
    dic = dic.unionByName(dic.withColumn("type_code", F.lit("other"))).unionByName(dic.withColumn("end_time", F.lit(CLOSED)))
    ewb = part.select(F.col("p_partkey").cast("string").alias("ewb_no"),
                      F.col("p_retailprice").alias("calc_weight"),
                      (F.col("p_retailprice") * F.lit(0.5)).alias("operate_weight"),
                      F.col("p_size").cast("double").alias("vol"),
                      (F.col("p_size") - F.lit(1)).alias("piece"),
                      F.when(every("p_partkey", 41), F.lit(CLOSED)).otherwise(open_end).alias("end_time"),
                      F.when(every("p_partkey", 37), 0).otherwise(1).alias("rd_status"))
    ewb_detail = part.select(F.col("p_partkey").cast("string").alias("ewb_no"),
                             F.col("p_type").alias("services_type_id"),
                             open_end.alias("end_time"))
    # a second product, or the same one in a closed version
    second = part.where(every("p_partkey", 6) | every("p_partkey", 6, 1)).select(
        F.col("p_partkey").cast("string").alias("ewb_no"), F.lit("PROMO").alias("services_type_id"),
        F.when(every("p_partkey", 6), open_end).otherwise(F.lit(CLOSED)).alias("end_time"))
    ewb_detail = ewb_detail.unionByName(second)
    return {
        "dwd_fact_tms_shipment": shipment,
        "dwd_fact_tms_shipment_stop": stops,
        "dwd_fact_tms_location": location,
        "dim_tms_ane_lw_type": reason,
        "dim_tms_equipment_group": equipment,
        "dwd_fact_lb_hs_ewbs_list_no": list_no_df,
        "dwd_fact_lb_hs_ewbs_list_detail": detail,
        "dim_hs_basic_site": site,
        "dim_dm_pb_bizop_org_brnch": org,
        "dim_hs_basic_dict": dic,
        "dwd_fact_hs_opt_ewb": ewb,
        "dwd_fact_hs_opt_ewb_detail": ewb_detail,
    }


NAMES = ("dwd_fact_tms_shipment", "dwd_fact_tms_shipment_stop", "dwd_fact_tms_location", "dim_tms_ane_lw_type", "dim_tms_equipment_group",
         "dwd_fact_lb_hs_ewbs_list_no", "dwd_fact_lb_hs_ewbs_list_detail", "dim_hs_basic_site", "dim_dm_pb_bizop_org_brnch",
         "dim_hs_basic_dict", "dwd_fact_hs_opt_ewb", "dwd_fact_hs_opt_ewb_detail")


def standin_warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stand-in tables as a mart meets its inputs: written tables. The
    first query of an application that asks for them derives and writes them,
    side by side; later ones scan them."""
    keys = {n: f"{sf_dir.rstrip('/')}:{n}" for n in NAMES}
    derived = standin_tables(spark, sf_dir) if not is_kept(spark, keys.values()) else {}
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(NAMES, pool.map(lambda n: kept(spark, keys[n], lambda: derived[n]), NAMES)))
