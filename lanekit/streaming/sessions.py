"""Session windows over a growing input, with late rows counted.

Sessions are kept in Spark's state store until the watermark passes their end;
then they leave it for good. Rows arrive a batch at a time, and of a hot key
only the open sessions and the rows of one batch are ever in one task, which
sorts them on disk if they are many: bound a batch by ``files_per_batch``.
Rows are not merged before that task, since a late row merged with another
would be counted or not as the input's files happen to be cut.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
ROWS = "n_events"


def sessions(rows: DataFrame, keys: Iterable[str], time: str, gap: str, measures: Mapping[str, Column] | None = None,
             late_by: str | None = None) -> DataFrame:
    """(keys, started, ended, n_events, measures): runs of a key's rows with no
    pause over ``gap``; a session ends ``gap`` after its last row.

    ``rows`` may be a table or a stream; a stream needs ``late_by``. A row of a
    stream is late if its own window of ``gap`` ends at or before the watermark,
    the latest time of earlier batches less ``late_by``, and late rows join no
    session. A row that is not late, but whose neighbours' session has ended,
    starts a new one. Rows without a time belong to no session; a null key is a
    key."""
    timed = rows.filter(F.col(time).isNotNull())
    if rows.isStreaming:
        if late_by is None:
            raise ValueError("a stream needs late_by")
        timed = timed.withWatermark(time, late_by)
    keys = list(keys)
    found = timed.groupBy(*keys, F.session_window(time, gap).alias("__session")).agg(
        F.count(F.lit(1)).alias(ROWS), *[c.alias(n) for n, c in (measures or {}).items()])
    return found.select(*keys, F.col("__session.start").alias("started"), F.col("__session.end").alias("ended"), ROWS,
                        *(measures or {}))


def follow_sessions(closed: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Takes in what arrived at the stream under ``closed`` (see ``sessions``)
    since the last run, and writes the sessions that ended to ``target``.

    A batch replaces its own folder, so a run that was killed is taken up by
    the next one and each session is there once."""
    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{BATCH}={number}")

    (closed.writeStream.outputMode("append").foreachBatch(commit).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_sessions(spark: SparkSession, target: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """The sessions that have ended so far; ``like`` has their columns."""
    return spark.read.schema(like.schema).format(fmt).load(target)


def open_rows(spark: SparkSession, checkpoint: str, n_keys: int) -> DataFrame:
    """n: the number of rows in sessions still open after the last batch;
    ``n_keys`` as in ``sessions``."""
    state = spark.read.format("statestore").load(checkpoint)
    # the sums of a session follow its keys and window, the number of its rows first
    value = state.schema["value"].dataType
    plain = T.StructType([T.StructField(f"_{i}", f.dataType, True) for i, f in enumerate(value.fields)])
    return (state.select(F.col("value").cast(plain).alias("value"))
            .agg(F.coalesce(F.sum(f"value._{n_keys + 1}"), F.lit(0)).cast("long").alias("n")))


def late_rows(arrived: DataFrame, closed: DataFrame, still_open: DataFrame, time: str) -> DataFrame:
    """n_arrived, n_closed, n_open, n_late, one row: of the rows with a time in
    ``arrived`` (all that the stream has read), those that are in no session
    that ended and in none that is open were late. All exact."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    one = arrived.agg(F.count(time).alias("n_arrived"))
    # a row each
    return (one.join(closed.agg(total(ROWS, "n_closed"))).join(still_open.select(F.col("n").alias("n_open")))
            .withColumn("n_late", F.col("n_arrived") - F.col("n_closed") - F.col("n_open")))
