"""The load-rate mart on a hand-built fixture of its twelve input tables, with
expected values worked out by hand (edge cases of FIXTURES.md §2)."""

import pytest

from conftest import plan_text
from lanekit.plans import mart as M

OPEN = "9999-12-31"
BIG, SMALL = M.DEFAULT_CATEGORIES["mini_big_clac_weight"][0], M.DEFAULT_CATEGORIES["mini_small_clac_weight"][0]
T0 = M.SITE_SUFFIX_TOKENS


def tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    ship_schema = ("shipment_gid string, attribute1 string, attribute2 string, attribute4 string, "
                   "attribute5 string, attribute7 string, attribute8 string, attribute13 string, "
                   "attribute14 string, attribute15 string, attribute19 string, attribute29 string, "
                   "attribute_number10 double, attribute_date1 string, schedule_note string, "
                   "reason_overtime string, end_point string")
    lo, hi = "2022-01-23 12:00:00", "2022-01-24 12:00:00"

    def ship(gid, order, sched, vehicle="E1", status="在途", date=lo, end=OPEN):
        return (gid, order, "ord", "sch", sched, "car", vehicle, status, "nature", "FTL", "line", "R1", 100.0,
                date, sched, "R2", end)

    shipments = df([
        ship("PD/ANE001", "T1", f"HZ{T0[0]}-SH{T0[2]}-BJ"),        # 3 stops, two segments
        ship("PD/ANE001", "T1", "OLD-ROUTE", end="2021-01-01"),       # closed version
        ship("PD/ANE002", "T2", "HZ-SH-HZ-SH", status="已调度"),      # round trip: excluded
        ship("PD/ANE003", "T3", "HZ"),                                # one stop: no segment
        ship("PD/ANE004", "T4", None),                                # no schedule
        ship("PD/ANE005", "T5", "HZ-SH", vehicle="E9", status="计划取消"),  # cancelled, unknown vehicle
        ship("XX/006", "T6", "HZ-SH"),                                # no prefix
        ship("PD/ANE007", "T7", "HZ-SH", status="其他"),               # status not kept
        ship("PD/ANE008", "T8", "HZ-SH", date=hi),                    # upper bound excluded
    ], ship_schema)
    stops = df([("PD/ANE001", 1, "L1", "08:00", "08:10", OPEN), ("PD/ANE001", 2, "L2", "12:00", "12:30", OPEN),
                ("PD/ANE001", 1, "L1", "07:00", "07:00", "2021-01-01")],
               "shipment_gid string, stop_num int, location_gid string, planned_departure string, "
               "actual_departure string, end_time string")
    locations = df([("L1", f"HZ{T0[0]}", OPEN), ("L1", "OLDNAME", "2021-01-01"), ("L2", f"SH{T0[3]}", OPEN)],
                   "location_gid string, location_name string, end_time string")
    reasons = df([("R1", "天气")], "code_gid string, category string")
    equipment = df([("E1", "9.6米"), ("E9", "99米")], "equipment_group_gid string, equipment_group_name string")
    heads = df([
        ("T1", "A1", "2022-01-23 13:00", 101, 102, 1, OPEN),
        ("T1", "A2", "2022-01-23 14:00", 101, 102, 1, OPEN),
        ("T1", "A3", "2022-01-23 15:00", 101, 102, 1, OPEN),
        ("T1", "A4", "2022-01-23 10:00", 101, 102, 1, OPEN),          # no detail lines
        ("T1", "A5", "2022-01-23 09:00", 101, 102, 0, OPEN),          # rd_status 0
        ("T1", "B1", "2022-01-23 16:00", 102, 103, 1, OPEN),
        ("T1", "B2", "2022-01-23 17:00", 105, 103, 1, OPEN),          # 105 cleans to the same name as 102
    ], "task_no string, ewbs_list_no string, created_time string, site_id bigint, next_site_id bigint, "
       "rd_status int, end_time string")
    details = df([
        ("A1", "W1", 2, OPEN), ("A1", "W2", 1, OPEN), ("A1", "W9", 3, OPEN),
        ("A2", "W3", 4, OPEN), ("A2", "W4", 0, OPEN), ("A3", "W5", 1, OPEN),
        ("B1", "W1", 1, OPEN), ("B2", "W6", 2, OPEN), ("A1", "W1", 5, "2021-01-01"),
    ], "ewbs_list_no string, ewb_no string, out_piece int, end_time string")
    sites = df([(101, "S101", f"HZ{T0[0]}", OPEN), (101, "S101", "OLD", "2021-01-01"),
                (102, "S102", f"SH{T0[1]}", OPEN), (103, "S103", "BJ", OPEN), (105, "S105", f"SH{T0[3]}", OPEN)],
               "site_id bigint, site_code string, site_name string, end_time string")
    org = df([("101", "HZ分拨", "浙江", 7), ("101", "X", "Y", 3), ("102", "SH分拨", "上海", 5),
              ("103", "BJ分拨", "北京", 7), ("105", "SH2", "上海2", 7)],
             "svth_lvl_org_brnch_id string, fith_lvl_org_brnch_nm string, thrd_lvl_org_brnch_nm string, "
             "org_brnch_lvl int")
    dic = df([(1, BIG, "services_type", OPEN), (2, SMALL, "services_type", OPEN), (3, "Other", "other", OPEN)],
             "dict_id bigint, dict_name string, type_code string, end_time string")
    ewb = df([("W1", 10.0, 8.0, 1.0, 2, OPEN, 1), ("W2", 9.0, 9.0, 9.0, 0, OPEN, 1),
              ("W3", 12.0, 12.0, 12.0, None, OPEN, 1), ("W4", 1.0, 1.0, 1.0, 1, OPEN, 1),
              ("W5", None, 5.0, 2.0, 1, OPEN, 1), ("W6", 6.0, 3.0, 3.0, 3, OPEN, 1)],
             "ewb_no string, calc_weight double, operate_weight double, vol double, piece int, "
             "end_time string, rd_status int")
    ewb_detail = df([("W1", 1, OPEN), ("W1", 2, OPEN), ("W2", 1, OPEN), ("W3", 2, OPEN), ("W5", 1, OPEN),
                     ("W6", 3, OPEN)], "ewb_no string, services_type_id bigint, end_time string")
    return {
        "dwd_fact_tms_shipment": shipments, "dwd_fact_tms_shipment_stop": stops,
        "dwd_fact_tms_location": locations, "dim_tms_ane_lw_type": reasons,
        "dim_tms_equipment_group": equipment, "dwd_fact_lb_hs_ewbs_list_no": heads,
        "dwd_fact_lb_hs_ewbs_list_detail": details, "dim_hs_basic_site": sites,
        "dim_dm_pb_bizop_org_brnch": org, "dim_hs_basic_dict": dic, "dwd_fact_hs_opt_ewb": ewb,
        "dwd_fact_hs_opt_ewb_detail": ewb_detail,
    }


def params(**kw):
    return M.MartParams(dt=20220123, stat_date="2022-01-23 12:00:00", window_start="2022-01-23 12:00:00",
                        window_end="2022-01-24 12:00:00", **kw)


@pytest.fixture(scope="module")
def result(spark):
    rows = M.build(spark, tables(spark), params()).collect()
    return sorted((r.asDict() for r in rows),
                  key=lambda r: (r["shipment_gid"], r["trans_rodes"], r["first_distribute_nm"] or ""))


def test_columns_and_rows(spark, result):
    assert len(result) == 4
    assert list(result[0]) == list(M.MART_COLUMNS)
    assert [r["shipment_gid"] for r in result] == ["PD/ANE001", "PD/ANE001", "PD/ANE001", "PD/ANE005"]
    assert all(r["dt"] == 20220123 for r in result)


def test_first_segment_measures(result):
    s1 = result[0]
    assert s1["trans_rodes"] == f"HZ{T0[0]}-SH{T0[2]}"
    assert (s1["first_rodes"], s1["next_rodes"]) == ("HZ", "SH")
    assert (s1["road_planned_schedule"], s1["road_actual_schedule"]) == ("08:00", "08:10")
    # attributes of the earliest list with detail lines (A1), not of A4 / A5
    assert (s1["first_distribute_nm"], s1["first_prov_nm"], s1["next_distribute_nm"], s1["next_prov_nm"]) == \
        ("HZ分拨", "浙江", "SH分拨", "上海")
    assert (s1["car_type"], s1["rated_capacity_total"], s1["rated_vol_total"]) == ("9.6米", 12, 60)
    assert (s1["road_rated_capacity"], s1["by_road_method"]) == (12.0, "1.0")
    assert (s1["overtime_reason"], s1["overtime_son_reason"]) == ("天气", None)
    # measures over all three lists A1..A3: W1 counted twice (two product rows),
    # W2 (0 pieces), W3 (null pieces) and W9 (missing) add pieces but no weight
    assert s1["road_out_piece_num"] == 13
    assert s1["road_ewb_num"] == 6
    assert s1["road_calc_weight"] == pytest.approx(20.0)
    assert s1["road_operate_weight"] == pytest.approx(21.0)
    assert s1["road_vol"] == pytest.approx(4.0)
    assert s1["mini_big_clac_weight"] == pytest.approx(10.0)
    assert s1["mini_small_clac_weight"] == pytest.approx(10.0)
    assert s1["load_rate"] == pytest.approx(20.0 / 12)
    assert s1["dsd_calc_weight"] is None and s1["phd_piece_num"] is None


def test_same_cleaned_name_fans_out(result):
    s2 = result[1:3]
    assert {r["first_distribute_nm"] for r in s2} == {"SH分拨", "SH2"}
    for r in s2:
        assert r["road_planned_schedule"] == "12:00"
        assert (r["road_out_piece_num"], r["road_ewb_num"]) == (8, 6)
        assert r["road_calc_weight"] == pytest.approx(28.0)


def test_cancelled_and_unknown_vehicle(result):
    s5 = result[3]
    assert (s5["car_type"], s5["rated_capacity_total"], s5["road_rated_capacity"]) == ("99米", 0, 0.0)
    assert s5["road_out_piece_num"] is None and s5["load_rate"] is None
    assert s5["first_distribute_nm"] is None


def test_one_lazy_plan(spark):
    text = plan_text(M.build(spark, tables(spark), params()))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert text.count("Scan ExistingRDD") <= len(M.TABLES) + 8        # no input is computed over again


def test_dates_and_window_are_required():
    with pytest.raises(TypeError):
        M.MartParams()


def test_every_predicate_of_the_stand_ins_drops_rows(spark):
    """Each filter of the mart, lifted one at a time, changes the stand-in
    mart's inputs."""
    from conftest import SF_SMALL
    from lanekit.plans.standins import standin_params, standin_tables
    t, p = standin_tables(spark, SF_SMALL), standin_params()
    for name, column, kept in [("dwd_fact_tms_shipment", "end_point", OPEN)] + [
            (n, "end_time", OPEN) for n in M.TABLES if "end_time" in t[n].columns] + [
            ("dwd_fact_lb_hs_ewbs_list_no", "rd_status", 1), ("dwd_fact_hs_opt_ewb", "rd_status", 1),
            ("dim_hs_basic_dict", "type_code", M.PRODUCT_TYPE_CODE)]:
        rows = t[name].groupBy((t[name][column] == kept).alias("kept")).count().collect()
        assert {r["kept"] for r in rows} == {True, False}, (name, column)
    ship = t["dwd_fact_tms_shipment"]
    for dropped in (~ship.attribute13.isin(*p.statuses), ~ship.shipment_gid.startswith(p.shipment_prefix),
                    ship.attribute_date1 == p.window_end, ship.attribute_date1 < p.window_start):
        assert not ship.where(dropped).isEmpty()
    assert not ship.where(ship.attribute_date1 == p.window_start).isEmpty()
    detail = t["dwd_fact_lb_hs_ewbs_list_detail"]
    assert not detail.where("out_piece = 0").isEmpty() and not detail.where("ewb_no IS NULL").isEmpty()
    assert not detail.where("ewb_no LIKE 'none%'").isEmpty()
    seg = M.segments(M.shipments(spark, t, p), p)
    assert not seg.where(seg.trans_mode == p.excluded_mode).isEmpty()
    products = t["dwd_fact_hs_opt_ewb_detail"].where("end_time = '9999-12-31'").groupBy("ewb_no").count()
    assert not products.where("count > 1").isEmpty()


def test_custom_segment_rule(spark):
    from lanekit.functions.columns import route_segments
    p = params(segment_rule=lambda mode, sched: route_segments(sched, 0.5))
    rows = M.build(spark, tables(spark), p).where("shipment_gid = 'PD/ANE001'").collect()
    assert {r["by_road_method"] for r in rows} == {"0.5"}
    assert len(rows) == 3


def test_absent_category_is_null_while_group_exists(spark):
    cats = dict(M.DEFAULT_CATEGORIES)
    cats["dsd_calc_weight"] = ("NO_SUCH_PRODUCT", "calc_weight")
    cats["jzld_piece_num"] = (BIG, "piece")
    rows = M.build(spark, tables(spark), params(categories=cats)).where(
        f"trans_rodes = 'HZ{T0[0]}-SH{T0[2]}'").collect()
    r = rows[0]
    assert r["road_calc_weight"] == pytest.approx(20.0)      # the group exists
    assert r["dsd_calc_weight"] is None                       # category absent: null, not 0
    assert r["jzld_piece_num"] == 2 + 1 + 1                    # pieces of product rows of that category
