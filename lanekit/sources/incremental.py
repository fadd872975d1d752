"""Restores that follow a growing export: a file stream whose batches are
committed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanekit.sources import transfer as X

BATCH = "batch_id"


def follow_export(spark: SparkSession, src: str, target: str, checkpoint: str, definition: X.Definition | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "orc",
                  files_per_batch: int | None = None) -> int:
    """Restores the export files below ``src`` that earlier runs have not, and
    returns the number of the last batch that ended (-1: none yet).

    ``src`` may be a pattern over several exports of one definition (that of
    ``src`` itself if none is given). Which files belong to which batch is kept
    in ``checkpoint`` before a batch starts, and a batch replaces its own folder
    ``target/batch_id=N``: a run that was killed, also between writing a batch
    and noting it, is taken up by the next one and every row arrives once. A
    line that does not parse fails its batch; nothing of it stays.

    Files must arrive whole and keep their names. ``transform`` must work on
    rows of one batch alone.
    """
    d = definition or X.read_definition(spark, src)
    files = spark.readStream.schema(X._plain_type(d.schema)).options(mode="FAILFAST", **X.TIMESTAMPS)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    arrived = X._converted(files.json(f"{src.rstrip('/')}/json"), d.schema, back=True)

    def commit(rows: DataFrame, number: int) -> None:
        done = transform(rows) if transform else rows
        done.write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{BATCH}={number}")

    query = (arrived.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    last = query.lastProgress
    return last["batchId"] if last and last["numInputRows"] else _last_batch(spark, target)


def _last_batch(spark: SparkSession, target: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")), default=-1)


def read_followed(spark: SparkSession, target: str, schema=None, fmt: str = "orc") -> DataFrame:
    """All rows restored so far, with their ``batch_id``."""
    rows = spark.read.format(fmt)
    return (rows.schema(schema) if schema else rows).load(target)
