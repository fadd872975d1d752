"""The mart's wide rows move once, and its rows stay what they were when
orders repeat, lack a number or share a shipment's stops."""

import re

import pytest

from conftest import SF_SMALL, plan_text
from lanekit.plans import mart as M
from lanekit.plans.catalog import QUERIES
from lanekit.plans.views import register_sql_functions
from test_mart import params, tables


@pytest.mark.parametrize("query", ["view_steps", "route_load_mart"])
def test_segments_stay_where_their_order_lies(spark, query):
    text = plan_text(QUERIES[query](spark, SF_SMALL))
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any("order" in keys for keys in dealt)
    assert not [keys for keys in dealt if "first_rodes" in keys or "trans_rodes" in keys]


def test_a_schedule_is_split_once(spark):
    register_sql_functions(spark)
    df = spark.range(3).selectExpr("concat('A-B-', id) AS s").selectExpr("route_segments(s, 0.5) AS r")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_repeated_shipments_and_stops_of_an_order(spark):
    t = tables(spark)
    ship = t["dwd_fact_tms_shipment"].where("shipment_gid = 'PD/ANE001' AND end_point = '9999-12-31'")
    other = ship.selectExpr(*[f"{e} AS {c}" for c in ship.columns
                              for e in ("'PD/ANE009'" if c == "shipment_gid" else "NULL" if c == "attribute1" else c,)])
    t["dwd_fact_tms_shipment"] = ship.unionByName(ship).unionByName(other).unionByName(other)
    stop = t["dwd_fact_tms_shipment_stop"].where("end_time = '9999-12-31'")
    first = stop.where("stop_num = 1").selectExpr("'PD/ANE009' AS shipment_gid", *stop.columns[1:])
    t["dwd_fact_tms_shipment_stop"] = stop.unionByName(stop.where("stop_num = 1")).unionByName(first)
    rows = M.build(spark, t, params()).where("first_rodes = 'HZ'").collect()
    numbered = [r for r in rows if r.order_id == "T1"]
    # two shipment rows, a stop recorded twice: each row counts the leg four times
    assert len(numbered) == 4 and {r.road_out_piece_num for r in numbered} == {4 * 13}
    assert {r.road_actual_schedule for r in rows} == {"08:10"}
    bare = [r for r in rows if r.order_id is None]
    assert len(bare) == 2 and {(r.road_out_piece_num, r.first_distribute_nm) for r in bare} == {(None, None)}


def test_rows_of_one_partition_are_published_where_they_are(spark):
    from lanekit.sources import transfer as X
    db = X.scratch_database(spark, "t_publish")
    df = spark.range(90, numPartitions=3).selectExpr("id", "20220123 AS dt")
    X.publish(df, f"{db}.mart", cluster=False)
    table = spark.table(f"{db}.mart")
    assert table.where("dt = 20220123").count() == 90
    assert len(table.inputFiles()) == 3                      # no shuffle gathered them
