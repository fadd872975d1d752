import pytest

from lanekit.sources import transfer as X
from lanekit.sources.incremental import follow_export, read_followed
from lanekit.sources.scratch import scratch_path


def counts(spark, out):
    rows = read_followed(spark, f"{out}/to").select("id").collect()
    return sorted(r.id for r in rows)


def test_a_killed_run_gives_the_rows_once(spark):
    """It is killed after a batch was written and before that was noted."""
    out = scratch_path(spark, "killed")
    rows = spark.range(100).selectExpr("id", "id * 2 AS v", "map('a b', id) AS m").repartition(5)
    src = X.export_table(spark, rows, out, name="t")
    seen = []

    def killed(batch):
        if len(seen) == 2:                                       # a half-written third batch
            batch.limit(7).write.mode("overwrite").orc(f"{out}/to/batch_id=2")
            raise RuntimeError("killed")
        seen.append(batch.count())
        return batch

    with pytest.raises(Exception, match="killed"):
        follow_export(spark, src, f"{out}/to", f"{out}/noted", transform=killed, files_per_batch=1)
    assert len(seen) == 2 and len(counts(spark, out)) < 100
    last = follow_export(spark, src, f"{out}/to", f"{out}/noted", files_per_batch=1)
    assert counts(spark, out) == list(range(100))
    assert follow_export(spark, src, f"{out}/to", f"{out}/noted", files_per_batch=1) == last
    assert counts(spark, out) == list(range(100))
    assert {r.id: r.m for r in read_followed(spark, f"{out}/to").collect()}[7] == {"a b": 7}


def test_damaged_lines_fail_their_batch(spark):
    out = scratch_path(spark, "damaged")
    src = X.export_table(spark, spark.range(10).repartition(1), out, name="t")
    follow_export(spark, src, f"{out}/to", f"{out}/noted")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/json/zz.json")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.writeBytes('{"id": 10}\n{"id": "oh')
    stream.close()
    with pytest.raises(Exception):
        follow_export(spark, src, f"{out}/to", f"{out}/noted")
    assert counts(spark, out) == list(range(10))
