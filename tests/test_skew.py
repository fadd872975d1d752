"""The mart on skewed input: one order holds a third of all lineitems (one hot
task, hot lists, a large stop fan-out). The result must still equal the DuckDB
oracle run on the same skewed view."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lanekit.plans import mart as M
from lanekit.plans import mart_sql
from lanekit.plans.catalog import round_doubles
from lanekit.plans.standins import standin_params, standin_tables
from lanekit.sources.tables import load
from oracle_compare import compare, duck

HOT_ORDER = 1


def test_mart_with_a_hot_order_matches_oracle(spark):
    li = load(spark, SF_SMALL, "lineitem")
    skewed = li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(HOT_ORDER).cast("bigint"))
                           .otherwise(F.col("l_orderkey")))
    assert skewed.where(F.col("l_orderkey") == HOT_ORDER).count() * 4 > skewed.count()
    tables = standin_tables(spark, SF_SMALL, overrides={"lineitem": skewed})
    got = round_doubles(M.build(spark, tables, standin_params()))

    con = duck(SF_SMALL)
    con.execute(f"""CREATE OR REPLACE VIEW lineitem AS
        SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN CAST({HOT_ORDER} AS BIGINT) ELSE l_orderkey END
                          AS l_orderkey)
        FROM read_parquet('{SF_SMALL}/lineitem.parquet')""")
    res = compare(got, mart_sql.duckdb_oracle(2), con)
    assert res["ok"], res
    hot = got.where(F.col("order_id") == str(HOT_ORDER)).select("road_out_piece_num").collect()
    assert hot and max(r[0] or 0 for r in hot) > 1000
