from pyspark.sql import functions as F

from conftest import SF_SMALL
from lanekit.sources import scratch
from lanekit.sources.tables import Tables, load, spread


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    root = scratch.shared_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_materialize_writes_once_and_reads_back(spark):
    df = spark.range(50).withColumn("y", F.col("id") * 2)
    m = scratch.materialize(df, "t")
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_spread_only_touches_under_split_inputs(spark):
    one = load(spark, SF_SMALL, "nation")
    assert one.rdd.getNumPartitions() == 1
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, numPartitions=8)
    assert spread(many, 4) is many
    assert Tables(spark, SF_SMALL).region.count() == 5


def test_release_all_removes_materialized_files(spark):
    import os
    m = scratch.materialize(spark.range(10), "rel")
    path = m.inputFiles()[0].replace("file:", "")
    assert os.path.exists(path)
    assert scratch.release_all(spark) >= 1
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    """Without spark.checkpoint.dir nothing is written to a machine's own disk
    unless the master is local."""
    import pytest

    from lanekit.sources import scratch

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        conf = {}

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://host:7077", "k8s://https://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_root(Session(master))


def test_release_drops_scratch_folders_and_databases(spark):
    from lanekit.sources import scratch, transfer
    db = transfer.scratch_database(spark, "t_release")
    transfer.save_table(spark.range(3), f"{db}.t")
    frame = scratch.materialize(spark.range(5), "t_release")
    assert frame.count() == 5
    mine = {k: list(v) for k, v in scratch._MATERIALIZED.items()}
    assert scratch.release_all(spark) == sum(map(len, mine.values()))
    assert not spark.catalog.databaseExists(db)


def test_spread_runs_nothing_and_keeps_order(spark):
    from lanekit.sources.tables import spread
    grouped = spark.range(100).groupBy("id").count()
    assert spread(grouped, 64) is grouped
    ordered = spark.range(100).orderBy("id")
    assert spread(ordered, 64) is ordered
