import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanekit.functions.columns import route_segments
from lanekit.plans.views import Step, last_view, register_sql_functions, run_views


def test_steps_skip_disabled_and_blank(spark):
    views = run_views(spark, [
        Step("v_a", "SELECT 1 AS x UNION ALL SELECT 2"),
        Step("v_off", "SELECT * FROM missing_table", enabled=False),
        Step("", ""),
        ("v_blank", "   "),
        {"name": "v_b", "sql": "SELECT x * 10 AS y FROM v_a", "enabled": "true"},
        {"name": "v_c", "sql": "SELECT * FROM missing", "enabled": "false"},
    ])
    assert list(views) == ["v_a", "v_b"]
    assert sorted(r[0] for r in last_view(views).collect()) == [10, 20]


def test_udfs_registered_for_sql_steps(spark):
    @F.pandas_udf(T.LongType())
    def plus_one(s: pd.Series) -> pd.Series:
        return s + 1

    views = run_views(spark, [
        Step("u1", "SELECT plus_one(id) AS a, twice(id) AS b FROM range(3)"),
    ], udfs={"plus_one": plus_one,
             "twice": "CREATE OR REPLACE TEMPORARY FUNCTION twice(x BIGINT) RETURNS BIGINT RETURN x * 2"})
    assert sorted(tuple(r) for r in views["u1"].collect()) == [(1, 0), (2, 2), (3, 4)]


def test_sql_route_segments_equals_column_rule(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("X-Y-Z", 1.0), ("X-Y-X-Y", 0.5), ("X", 1.0), (None, 1.0)], "s string, f double")
    sql = df.selectExpr("route_segments(s, f) AS r").collect()
    col = df.select(route_segments("s", F.col("f")).alias("r")).collect()
    assert sql == col


def test_materialized_step_is_read_from_files(spark):
    views = run_views(spark, [Step("m_base", "SELECT id, id * 3 AS y FROM range(5)", materialize=True),
                              Step("m_use", "SELECT sum(y) AS s FROM m_base")])
    assert views["m_use"].first()["s"] == 30
    assert "FileScan parquet" in views["m_base"]._jdf.queryExecution().executedPlan().toString()


def test_steps_from_xml(spark):
    from lanekit.plans.views import steps_from_xml
    xml = """<configuration>
      <property><sql.name>x_a</sql.name><sql.value>SELECT 1 AS v UNION ALL SELECT 2 AS v</sql.value>
        <sql.enable>true</sql.enable><sql.description>first</sql.description></property>
      <property><sql.name>x_off</sql.name><sql.value>SELECT * FROM nowhere</sql.value>
        <sql.enable>false</sql.enable></property>
      <property><sql.name></sql.name><sql.value></sql.value><sql.enable>true</sql.enable></property>
      <property><sql.name>x_b</sql.name><sql.value>SELECT sum(v) AS s FROM x_a WHERE v &lt; 5</sql.value>
        <sql.enable>true</sql.enable></property>
    </configuration>"""
    steps = steps_from_xml(xml)
    assert [s.name for s in steps] == ["x_a", "x_off", "", "x_b"]
    views = run_views(spark, steps)
    assert list(views) == ["x_a", "x_b"] and views["x_b"].first()["s"] == 3
