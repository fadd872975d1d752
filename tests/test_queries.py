"""Every registered query against its DuckDB oracle on sf0.001, plus plan
checks (pushdown, pruning, join strategies)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL, plan_text
from oracle_compare import compare, duck

from lanekit.plans import catalog

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "dt" and len(df.columns) == 45
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert res["ok"], res
    assert res["types_match"], res


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan_text(QUERIES["filter_conjunction"](spark, SF_SMALL))
    for f in ("EqualTo(l_returnflag,R)", "EqualTo(l_linestatus,F)", "GreaterThan(l_quantity,25.0)"):
        assert f in text.split("PushedFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double" in text
    text = plan_text(QUERIES["scan_project"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    assert "StringStartsWith(url,https://)" in plan_text(QUERIES["filter_prefix"](spark, SF_SMALL))


def test_join_strategies(spark):
    semi = QUERIES["semi_join"](spark, SF_SMALL)
    assert "LeftSemi" in semi._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in plan_text(QUERIES["broadcast_literal_join"](spark, SF_SMALL))
    one_pass = plan_text(QUERIES["category_pivot_sum"](spark, SF_SMALL))
    assert one_pass.count("HashAggregate") == 2           # one partial + one final aggregate
