"""The load-rate mart in SQL, twice and in two shapes.

* :func:`spark_steps`: steps for :func:`lanekit.plans.views.run_views` over the
  mart's input tables (temp views under their warehouse names). Cargo is
  reduced before it meets anything: lines per list and waybill, lists, legs;
  one measure step computes all categories with filtered sums.
* :func:`duckdb_oracle`: one query for DuckDB that derives the stand-in inputs
  itself and computes the measures row by row: every segment row meets every
  cargo line of its leg before anything is summed. The two texts share no
  expression, so the oracle checks the logic of the other two mart plans.
"""

from __future__ import annotations

from lanekit.functions.columns import SITE_SUFFIX_TOKENS
from lanekit.plans.mart import MART_COLUMNS, ORG_LEVELS, PRODUCT_TYPE_CODE, ROUND_TRIP_MODE, SHIPMENT_PREFIX
from lanekit.plans.standins import CLOSED, STANDIN_CATEGORIES, STANDIN_VEHICLES, WINDOW

OPEN = "9999-12-31"

_ROUNDED = {"actual_cost", "road_rated_capacity", "road_rated_vol", "road_calc_weight",
            "road_operate_weight", "road_vol", "mini_big_clac_weight", "mini_small_clac_weight",
            "dsd_calc_weight", "jzld_calc_weight", "phd_calc_weight", "load_rate"}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _bare(name: str) -> str:
    for token in SITE_SUFFIX_TOKENS:
        name = f"replace({name}, {_q(token)}, '')"
    return name


def _published(source: str, named: dict[str, str], ratio: str, dt: int = 20220123, digits: int = 2) -> str:
    """The published columns; ``named`` has those that are expressions."""
    out = []
    for c in MART_COLUMNS:
        e = str(dt) if c == "dt" else ratio if c == "load_rate" else named.get(c, c)
        out.append(f"round(({e}) + 1e-7, {digits}) AS {c}" if c in _ROUNDED else f"{e} AS {c}")
    return f"SELECT {', '.join(out)} FROM {source}"


# ------------------------------------------------------------------ Spark steps

def spark_steps() -> list[tuple[str, str]]:
    vehicles = ", ".join(f"({_q(n)}, {tonnes}, {volume})" for n, tonnes, volume in STANDIN_VEHICLES)
    totals = ["pieces", "waybill_lines", "calc", "operate", "vol", *STANDIN_CATEGORIES]
    kinds = {"piece": "c.pieces", "calc_weight": "c.pieces * u.calc"}
    by_category = ",\n            ".join(
        f"sum({kinds[kind]}) FILTER (WHERE u.product = {_q(product)}) AS {name}"
        for name, (product, kind) in STANDIN_CATEGORIES.items())
    n_rows = "count(*) OVER (PARTITION BY order_key, order_id, first_rodes, next_rodes, by_road_num, trans_rodes)"
    shipped = (f"shipment_gid LIKE '{SHIPMENT_PREFIX}%' AND attribute13 IN ('F', 'O', 'P') "
               f"AND attribute_date1 >= '{WINDOW[0]}' AND attribute_date1 < '{WINDOW[1]}' AND end_point = '{OPEN}'")
    # orders without a number meet no leg; their gid spreads them
    order_key = "coalesce(attribute1, shipment_gid) AS order_key"
    named = {"road_out_piece_num": "pieces * n_rows", "road_ewb_num": "waybill_lines * n_rows",
             "road_calc_weight": "calc * n_rows", "road_operate_weight": "operate * n_rows", "road_vol": "vol * n_rows",
             **{c: f"{c} * n_rows" for c in STANDIN_CATEGORIES}}
    return [
        ("unit_weight", f"""
          SELECT w.ewb_no, product.dict_name AS product,
                 try_divide(coalesce(w.calc_weight, 0), nullif(w.piece, 0)) AS calc,
                 try_divide(coalesce(w.operate_weight, 0), nullif(w.piece, 0)) AS operate,
                 try_divide(coalesce(w.vol, 0), nullif(w.piece, 0)) AS vol
          FROM dwd_fact_hs_opt_ewb w
          LEFT JOIN (SELECT i.ewb_no AS no, k.dict_name
                     FROM dwd_fact_hs_opt_ewb_detail i
                     LEFT JOIN dim_hs_basic_dict k ON k.dict_id = i.services_type_id
                          AND k.type_code = {_q(PRODUCT_TYPE_CODE)} AND k.end_time = '{OPEN}'
                     WHERE i.end_time = '{OPEN}') product ON product.no = w.ewb_no
          WHERE w.rd_status = 1 AND w.end_time = '{OPEN}'"""),
        ("cargo", f"""
          SELECT ewbs_list_no, ewb_no, sum(out_piece) AS pieces, count(*) AS lines
          FROM dwd_fact_lb_hs_ewbs_list_detail
          WHERE out_piece > 0 AND end_time = '{OPEN}'
          GROUP BY ewbs_list_no, ewb_no"""),
        ("list_load", f"""
          SELECT c.ewbs_list_no, sum(c.pieces) AS pieces,
            sum(if(c.ewb_no IS NULL, 0, c.lines)) AS waybill_lines,
            sum(c.pieces * u.calc) AS calc, sum(c.pieces * u.operate) AS operate, sum(c.pieces * u.vol) AS vol,
            {by_category}
          FROM cargo c LEFT JOIN unit_weight u ON u.ewb_no = c.ewb_no
          GROUP BY c.ewbs_list_no"""),
        ("place", f"""
          SELECT coalesce(s.id, o.id) AS id, s.name, o.hub, o.province
          FROM (SELECT CAST(site_id AS STRING) AS id, {_bare('site_name')} AS name
                FROM dim_hs_basic_site WHERE end_time = '{OPEN}') s
          FULL JOIN (SELECT svth_lvl_org_brnch_id AS id, fith_lvl_org_brnch_nm AS hub, thrd_lvl_org_brnch_nm AS province
                     FROM dim_dm_pb_bizop_org_brnch WHERE org_brnch_lvl IN {ORG_LEVELS}) o ON o.id = s.id"""),
        # everything from here on lies by task, so one shuffle of the lists
        # serves the first list of each site pair, the totals and their join
        ("leg_list", f"""
          SELECT h.*, a.name AS from_name, a.hub AS from_hub, a.province AS from_province,
                 b.name AS to_name, b.hub AS to_hub, b.province AS to_province
          FROM (SELECT /*+ REPARTITION(task_no) */ h.task_no, h.site_id, h.next_site_id, h.created_time, h.ewbs_list_no,
                       {', '.join(f'l.{t}' for t in totals)}
                FROM dwd_fact_lb_hs_ewbs_list_no h JOIN list_load l ON l.ewbs_list_no = h.ewbs_list_no
                WHERE h.rd_status = 1 AND h.end_time = '{OPEN}') h
          LEFT JOIN place a ON a.id = CAST(h.site_id AS STRING)
          LEFT JOIN place b ON b.id = CAST(h.next_site_id AS STRING)"""),
        ("leg_load", f"""
          SELECT task_no, from_name, to_name, {', '.join(f'sum({t}) AS {t}' for t in totals)},
                 collect_list(CASE WHEN turn = 1 THEN struct(from_hub, from_province, to_hub, to_province) END) AS firsts
          FROM (SELECT *, row_number() OVER (PARTITION BY task_no, site_id, next_site_id
                                             ORDER BY created_time, ewbs_list_no) AS turn FROM leg_list)
          GROUP BY task_no, from_name, to_name"""),
        ("leg_opening", f"""
          SELECT task_no, from_name, to_name, {', '.join(totals)}, first.*
          FROM leg_load LATERAL VIEW OUTER explode(firsts) f AS first"""),
        ("departure", f"""
          SELECT s.shipment_gid AS gid, s.stop_num, {_bare('p.location_name')} AS stop_name,
                 s.planned_departure, s.actual_departure
          FROM dwd_fact_tms_shipment_stop s
          JOIN dwd_fact_tms_location p ON p.location_gid = s.location_gid AND p.end_time = '{OPEN}'
          WHERE s.end_time = '{OPEN}'"""),
        # the departures that some segment asks for, brought to its order: few
        # narrow rows move, the wide segments stay where their order lies
        ("order_departure", f"""
          SELECT /*+ REPARTITION(order_key) */ n.order_key, d.*
          FROM (SELECT DISTINCT * FROM (
                  SELECT /*+ REPARTITION(shipment_gid, stop_num, stop_name) */ {order_key}, shipment_gid, at + 1 AS stop_num, stop_name
                  FROM dwd_fact_tms_shipment LATERAL VIEW posexplode(split({_bare('attribute5')}, '-')) e AS at, stop_name
                  WHERE {shipped})) n
          JOIN departure d ON d.gid = n.shipment_gid AND d.stop_num = n.stop_num AND d.stop_name = n.stop_name"""),
        ("voyage", f"""
          SELECT '2022-01-23 12:00:00' AS stat_date, s.shipment_gid, s.attribute1 AS order_id, s.order_key,
                 s.attribute4 AS shipment_schedule_id, s.attribute7 AS car_id, s.attribute_number10 AS actual_cost,
                 s.attribute2 AS order_type, s.attribute19 AS line_type, s.attribute14 AS please_car_nature,
                 s.attribute15 AS load_mode, g.equipment_group_name AS car_type,
                 if(s.attribute13 = 'P', 0, v.tonnes) AS rated_capacity_total,
                 if(s.attribute13 = 'P', 0, v.volume) AS rated_vol_total,
                 s.attribute13 AS transport_status, late.category AS overtime_reason,
                 later.category AS overtime_son_reason, s.attribute_date1 AS plan_start_time,
                 s.schedule_note AS planned_schedule, s.attribute5 AS actual_schedule,
                 route_segments(s.attribute5, if(s.attribute15 = 'BUILDING', 0.5D, 1.0D)) AS pieces_of_route
          FROM (SELECT /*+ REPARTITION(order_key) */ *, {order_key} FROM dwd_fact_tms_shipment WHERE {shipped}) s
          LEFT JOIN dim_tms_equipment_group g ON g.equipment_group_gid = s.attribute8
          LEFT JOIN VALUES {vehicles} AS v(kind, tonnes, volume) ON v.kind = g.equipment_group_name
          LEFT JOIN dim_tms_ane_lw_type late ON late.code_gid = s.attribute29
          LEFT JOIN dim_tms_ane_lw_type later ON later.code_gid = s.reason_overtime"""),
        ("segment", f"""
          SELECT *, part[0] AS trans_mode, part[1] AS trans_rodes, part[2] AS by_road_method, part[3] AS by_road_num,
                 {_bare("split_part(part[1], '-', 1)")} AS first_rodes,
                 {_bare("split_part(part[1], '-', 2)")} AS next_rodes
          FROM (SELECT v.*, split(value, '\\\\*') AS part FROM voyage v LATERAL VIEW explode(pieces_of_route) e AS value)"""),
        # an order's few legs and departures meet its segments in one merge where
        # the order lies; an equality besides the order's would shuffle them again
        ("segment_row", f"""
          SELECT g.*, g.rated_capacity_total * CAST(g.by_road_method AS DOUBLE) AS road_rated_capacity,
                 g.rated_vol_total * CAST(g.by_road_method AS DOUBLE) AS road_rated_vol,
                 d.planned_departure AS road_planned_schedule, d.actual_departure AS road_actual_schedule,
                 o.from_hub AS first_distribute_nm, o.from_province AS first_prov_nm,
                 o.to_hub AS next_distribute_nm, o.to_province AS next_prov_nm, {', '.join(f'o.{t}' for t in totals)}
          FROM segment g
          LEFT JOIN order_departure d ON d.order_key = g.order_key AND d.gid BETWEEN g.shipment_gid AND g.shipment_gid
               AND d.stop_num BETWEEN CAST(g.by_road_num AS INT) AND CAST(g.by_road_num AS INT)
               AND d.stop_name BETWEEN g.first_rodes AND g.first_rodes
          LEFT JOIN leg_opening o ON o.task_no = g.order_key AND g.order_id IS NOT NULL
               AND o.from_name BETWEEN g.first_rodes AND g.first_rodes AND o.to_name BETWEEN g.next_rodes AND g.next_rodes
          WHERE g.trans_mode <> '{ROUND_TRIP_MODE}'"""),
        ("segment_load", f"SELECT r.*, {n_rows} AS n_rows FROM segment_row r"),
        ("mart_result", _published("segment_load", named, "try_divide(calc * n_rows, road_rated_capacity)")),
    ]


# ---------------------------------------------------------------- DuckDB oracle

def duckdb_segments(schedule: str, factor: str = "1.0") -> str:
    """``mode*from-to*factor*ordinal`` values of a schedule."""
    stops = f"string_split({schedule}, '-')"
    number = f"(len(list_distinct({stops}[1:list_position({stops}, x)])) - 1)"
    letters = f"list_transform({stops}, lambda x: chr((65 + {number} % 26)::INTEGER) || CASE WHEN {number} < 26 THEN '' ELSE ({number} // 26)::VARCHAR END)"
    value = (f"concat_ws('*', array_to_string({letters}, '-'), {stops}[k] || '-' || {stops}[k + 1], "
             f"({factor})::DOUBLE::VARCHAR, k::VARCHAR)")
    return (f"CASE WHEN {schedule} IS NULL THEN NULL WHEN len({stops}) < 2 THEN []::VARCHAR[] "
            f"ELSE list_transform(range(1, len({stops})), lambda k: {value}) END")


def _standins() -> str:
    """The stand-in inputs of :mod:`lanekit.plans.standins`, as CTEs."""
    suffix = " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(SITE_SUFFIX_TOKENS))
    return f"""
    town AS MATERIALIZED (SELECT n_nationkey AS id, n_regionkey AS region, n_name AS plain,
                    n_name || CASE n_regionkey {suffix} ELSE '' END AS name FROM nation),
    trip AS MATERIALIZED (SELECT o.*, c_name, c_mktsegment, c.id AS town_id, c.region, h.id AS hub_id,
                    CASE WHEN o_orderkey % 7 = 0 THEN concat_ws('-', h.name, c.name, h.name, c.name)
                         ELSE concat_ws('-', h.name, c.name, h.name) END AS route
             FROM orders o JOIN customer ON c_custkey = o_custkey
             JOIN town c ON c.id = c_nationkey JOIN town h ON h.id = c.region),
    s_shipment AS MATERIALIZED (
      SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'XX/ANE' ELSE 'PD/ANE' END || o_orderkey AS gid, t.*,
             CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS status,
             CASE WHEN o_orderkey % 19 = 0 THEN '{WINDOW[0]}' WHEN o_orderkey % 23 = 0 THEN '{WINDOW[1]}'
                  ELSE o_orderdate::VARCHAR END AS planned, v.valid_to
      FROM trip t JOIN (VALUES ('{OPEN}'), ('{CLOSED}')) v(valid_to)
        ON v.valid_to = '{OPEN}' OR o_orderkey % 17 = 0),
    s_stop AS MATERIALIZED (
      SELECT 'PD/ANE' || l_orderkey AS gid, l_linenumber AS num, t.name, l_shipdate::VARCHAR AS planned,
             (l_shipdate + INTERVAL 1 DAY)::VARCHAR AS actual
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN town t ON t.id = s_nationkey
      WHERE NOT (l_orderkey % 5 = 0 AND l_linenumber = 2)),
    s_list AS MATERIALIZED (
      SELECT l_orderkey, l_orderkey::VARCHAR AS task, l_orderkey || '-' || l_returnflag AS list, min(l_shipdate)::VARCHAR AS created,
             l_returnflag = 'R' AS back
      FROM lineitem GROUP BY l_orderkey, l_returnflag),
    s_line AS MATERIALIZED (
      SELECT l_orderkey || '-' || l_returnflag AS list,
             CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN 'none' || l_partkey
                  ELSE l_partkey::VARCHAR END AS waybill,
             l_quantity::INTEGER AS out_piece
      FROM lineitem WHERE l_linenumber <> 7 AND l_quantity::INTEGER % 10 <> 0),
    s_waybill AS MATERIALIZED (
      SELECT p_partkey::VARCHAR AS waybill, p_retailprice AS calc, p_retailprice * 0.5 AS operate,
             p_size::DOUBLE AS vol, p_size - 1 AS piece, product
      FROM part, LATERAL (SELECT p_type AS product UNION ALL SELECT 'PROMO' WHERE p_partkey % 6 = 0)
      WHERE p_partkey % 37 <> 0 AND p_partkey % 41 <> 0),
    known AS (SELECT DISTINCT p_type FROM part)"""


def duckdb_oracle(digits: int = 2) -> str:
    vehicles = ", ".join(f"({_q(n)}, {tonnes}, {volume})" for n, tonnes, volume in STANDIN_VEHICLES)
    share = {w: f"w.{w} / nullif(w.piece, 0) * d.out_piece" for w in ("calc", "operate", "vol")}
    by_category = ",\n             ".join(
        (f"sum(d.out_piece) FILTER (w.product = {_q(product)})::BIGINT AS {name}" if kind == "piece"
         else f"sum({share['calc']}) FILTER (w.product = {_q(product)}) AS {name}")
        for name, (product, kind) in STANDIN_CATEGORIES.items())
    named = {"road_ewb_num": "lines", "road_out_piece_num": "pieces", "road_calc_weight": "calc",
             "road_operate_weight": "operate", "road_vol": "vol"}
    return f"""
    WITH {_standins()},
    handed AS MATERIALIZED (
      SELECT s.*, {_bare('a.name')} AS a, {_bare('b.name')} AS b, ra.r_name AS a_hub, a.plain AS a_province,
             rb.r_name AS b_hub, b.plain AS b_province
      FROM s_list s JOIN trip t ON t.o_orderkey = s.l_orderkey
      JOIN town a ON a.id = CASE WHEN s.back THEN t.town_id ELSE t.hub_id END
      JOIN town b ON b.id = CASE WHEN s.back THEN t.hub_id ELSE t.town_id END
      JOIN region ra ON ra.r_regionkey = a.region JOIN region rb ON rb.r_regionkey = b.region
      WHERE s.l_orderkey % 9 <> 4 AND s.l_orderkey % 10 <> 3 AND s.list IN (SELECT list FROM s_line)),
    leg AS MATERIALIZED (
      SELECT gid, o_orderkey, o_custkey, c_name, o_totalprice, o_orderstatus, o_orderpriority, c_mktsegment, region,
             status, planned, route, string_split(unnest({duckdb_segments(
                 'route', "CASE WHEN c_mktsegment = 'BUILDING' THEN 0.5 ELSE 1.0 END")}), '*') AS part
      FROM s_shipment
      WHERE starts_with(gid, '{SHIPMENT_PREFIX}') AND status IN ('F', 'O', 'P') AND valid_to = '{OPEN}'
        AND planned >= '{WINDOW[0]}' AND planned < '{WINDOW[1]}'),
    run AS MATERIALIZED (
      SELECT '2022-01-23 12:00:00' AS stat_date, l.gid AS shipment_gid, l.o_orderkey::VARCHAR AS order_id,
             l.o_custkey::VARCHAR AS shipment_schedule_id, l.c_name AS car_id, l.o_totalprice AS actual_cost,
             l.o_orderstatus AS order_type, l.o_orderpriority AS line_type, l.c_mktsegment AS please_car_nature,
             l.c_mktsegment AS load_mode, l.o_orderpriority AS car_type,
             CASE WHEN l.status = 'P' THEN 0 ELSE v.tonnes END AS rated_capacity_total,
             CASE WHEN l.status = 'P' THEN 0 ELSE v.volume END AS rated_vol_total,
             l.status AS transport_status, r.r_name AS overtime_reason, rr.r_name AS overtime_son_reason,
             l.planned AS plan_start_time, l.route AS planned_schedule, l.route AS actual_schedule,
             l.part[2] AS trans_rodes, l.part[3] AS by_road_method, l.part[4] AS by_road_num,
             {_bare("string_split(l.part[2], '-')[1]")} AS first_rodes,
             {_bare("string_split(l.part[2], '-')[2]")} AS next_rodes
      FROM leg l LEFT JOIN (VALUES {vehicles}) v(kind, tonnes, volume) ON v.kind = l.o_orderpriority
      LEFT JOIN region r ON r.r_regionkey = l.region
      LEFT JOIN region rr ON rr.r_regionkey::VARCHAR = left(l.o_orderpriority, 1)
      WHERE l.part[1] <> '{ROUND_TRIP_MODE}'),
    opening AS (
      SELECT DISTINCT ON (task, a, b) task, a, b, a_hub, a_province, b_hub, b_province
      FROM handed ORDER BY task, a, b, created NULLS FIRST, list),
    timed AS MATERIALIZED (
      SELECT run.*, rated_capacity_total * by_road_method::DOUBLE AS road_rated_capacity,
             rated_vol_total * by_road_method::DOUBLE AS road_rated_vol,
             s.planned AS road_planned_schedule, s.actual AS road_actual_schedule,
             f.a_hub AS first_distribute_nm, f.a_province AS first_prov_nm,
             f.b_hub AS next_distribute_nm, f.b_province AS next_prov_nm
      FROM run LEFT JOIN s_stop s ON s.gid = shipment_gid AND s.num = by_road_num::INTEGER AND {_bare('s.name')} = first_rodes
      LEFT JOIN opening f ON f.task = order_id AND f.a = first_rodes AND f.b = next_rodes),
    load AS MATERIALIZED (
      SELECT t.order_id, t.by_road_num, t.trans_rodes, sum(d.out_piece)::BIGINT AS pieces,
             count(d.waybill)::BIGINT AS lines, sum({share['calc']}) AS calc, sum({share['operate']}) AS operate,
             sum({share['vol']}) AS vol,
             {by_category}
      FROM timed t JOIN handed h ON h.task = t.order_id AND h.a = t.first_rodes AND h.b = t.next_rodes
      JOIN s_line d ON d.list = h.list LEFT JOIN s_waybill w ON w.waybill = d.waybill
      GROUP BY ALL),
    total AS (SELECT t.*, l.* EXCLUDE (order_id, by_road_num, trans_rodes)
              FROM timed t LEFT JOIN load l USING (order_id, by_road_num, trans_rodes))
    {_published('total', named, 'calc / nullif(road_rated_capacity, 0)', digits=digits)}"""
