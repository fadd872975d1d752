import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lanekit.session import get_session
    s = get_session("local[4]", app_name="lanekit-tests", shuffle_partitions=8)
    from lanekit.sources.scratch import shared_root
    shared_root(s)          # uses spark.checkpoint.dir, or a test-only folder if unset
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left(spark):
    """Temp views are listed in every database; a module finds those of no other."""
    yield
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
