from datetime import datetime

import pytest
from conftest import SF_SMALL, plan_text

from lanekit.plans.catalog_ranges import QUERIES, three_dearest
from lanekit.plans.step_functions import Aggregate, call
from lanekit.plans.views import last_view, run_views

MEAN = Aggregate(lambda s, v: (s or (0, 0)) if v is None else ((s or (0, 0))[0] + v, (s or (0, 0))[1] + 1),
                 lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: s[0] / s[1] if s[1] else None, "double", "string", held=3)


def applied(spark, rows, schema, spec):
    spark.createDataFrame(rows, schema).repartition(5).createOrReplaceTempView("agg_rows")
    views = run_views(spark, [("agg_out", call("my_agg", "SELECT k AS key, v AS value FROM agg_rows"))], aggregates={"my_agg": spec})
    return last_view(views)


def test_hot_groups_are_summed_up_before_they_move(spark):
    rows = [(None if i % 11 == 0 else "hot" if i % 3 == 0 else f"k{i % 13}", None if i % 5 == 0 else i) for i in range(2000)]
    wanted = {}
    for k, v in rows:
        wanted.setdefault(k, []).extend([] if v is None else [v])
    df = applied(spark, rows, "k string, v bigint", MEAN)                 # held: three groups a task
    got = {r.key: r.result for r in df.collect()}
    assert got == {k: pytest.approx(sum(v) / len(v)) for k, v in wanted.items()}
    plan = plan_text(df)
    assert plan.index("my_agg(") < plan.index("hashpartitioning(partition_by_0") < plan.index("my_agg_partial(")


def test_groups_without_values_and_no_rows(spark):
    assert [tuple(r) for r in applied(spark, [("a", None)], "k string, v bigint", MEAN).collect()] == [("a", None)]
    assert applied(spark, [], "k string, v bigint", MEAN).count() == 0
    few = applied(spark, [(1, 5), (1, 5), (1, None), (2, 7), (2, 1), (2, 9), (2, 8)], "k bigint, v bigint", three_dearest())
    assert sorted(map(tuple, few.collect())) == [(1, "5"), (2, "9|8|7")]


def test_one_state_a_task_is_shuffled(spark):
    spark.range(0, 60_000, 1, 6).selectExpr("0L AS k", "id AS v").createOrReplaceTempView("agg_hot")
    run_views(spark, [], aggregates={"my_top": three_dearest()})
    partial = spark.sql("SELECT * FROM my_top_partial(TABLE(SELECT k AS key, v AS value FROM agg_hot))")
    assert partial.count() == 6
    assert spark.sql(call("my_top", "SELECT k AS key, v AS value FROM agg_hot")).first().result == "59999|59998|59997"


def test_table_function_sees_groups_in_order(spark):
    df = QUERIES["step_table_function"](spark, SF_SMALL)
    assert "hashpartitioning(" in plan_text(df)
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r.cust, r.ts)):
        day = (r.cust, r.ts // 86_400_000_000)
        assert r.ts - last.get(day, r.ts - 7_200_000_000) >= 7_200_000_000
        last[day] = r.ts


def test_rows_reach_an_aggregate_in_batches(spark):
    """A row of its own costs tens of microseconds; a batch's values are as before: rows, naive times, nulls."""
    rows = [(i % 3, (i, f"n{i}"), datetime(2024, 1, 1, 0, i % 60)) for i in range(300)] + [(None, None, None)]
    latest = Aggregate(lambda s, v: max(s or (), (v.t, v.s.name) if v.t else ()), max, lambda s: f"{s[0]} {s[1]}" if s else None, "string")
    df = applied(spark, [(k, (s, t)) for k, s, t in rows], "k bigint, v struct<s: struct<id: bigint, name: string>, t: timestamp>", latest)
    wanted = {k: "{} {}".format(*max((t, s[1]) for j, s, t in rows if j == k)) for k in range(3)}
    assert {r.key: r.result for r in df.collect()} == {**wanted, None: None}
    assert "ArrowEvalPythonUDTF" in plan_text(df)
