from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lanekit.sources.scratch import scratch_path
from lanekit.streaming import sessions as S

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp"


class Input:
    """An input that grows, with gap 10 and lateness 60 minutes."""

    def __init__(self, spark, name):
        self.spark, self.dir, self.n = spark, scratch_path(spark, name), 0

    def arrive(self, rows):
        self.n += 1
        timed = [(k, None if m is None else T0 + timedelta(minutes=m)) for k, m in rows]
        self.spark.createDataFrame(timed, SCHEMA).coalesce(1).write.json(f"{self.dir}/in/{self.n}")

    def found(self, rows, **how):
        return S.sessions(rows, ["k"], "ts", "10 minutes", {"times": F.count("ts"), "first": F.min("ts")}, **how)

    def follow(self):
        stream = self.spark.readStream.schema(SCHEMA).json(f"{self.dir}/in/*")
        S.follow_sessions(self.found(stream, late_by="60 minutes"), f"{self.dir}/out", f"{self.dir}/noted")

    def closed(self):
        return S.read_sessions(self.spark, f"{self.dir}/out", self.found(self.spark.createDataFrame([], SCHEMA)))

    def rows(self):
        minute = lambda t: int((t - T0).total_seconds() // 60)
        return sorted(((r.k or "", minute(r.started), minute(r.ended), r.n_events) for r in self.closed().collect()))

    def counts(self):
        arrived = self.spark.read.schema(SCHEMA).json(f"{self.dir}/in/*")
        return tuple(S.late_rows(arrived, self.closed(), S.open_rows(self.spark, f"{self.dir}/noted", 1), "ts").first())


def test_late_rows_and_open_sessions(spark):
    x = Input(spark, "sessions")
    x.arrive([("a", 0), ("a", 10), ("a", 21), ("a", 0), ("b", 300), (None, 5), ("a", None)])
    x.follow()
    assert x.rows() == [("", 5, 15, 1), ("a", 0, 20, 3), ("a", 21, 31, 1)]
    assert x.counts() == (6, 5, 1, 0)
    # the watermark is 240: windows that end at 240 or before are late
    x.arrive([("a", 231), ("a", 229), ("a", 230), ("a", 235), ("a", 230), ("b", 305), ("c", 500)])
    x.follow()
    assert x.rows() == [("", 5, 15, 1), ("a", 0, 20, 3), ("a", 21, 31, 1), ("a", 231, 245, 2), ("b", 300, 315, 2)]
    assert x.counts() == (13, 9, 1, 3)
    x.follow()                                                    # nothing new
    assert x.counts() == (13, 9, 1, 3)


def test_a_stream_in_order_equals_the_table(spark):
    x = Input(spark, "ordered")
    rows = [("hot" if i % 3 == 0 else f"u{i % 7}", i * 4 + (i * i) % 9) for i in range(300)]
    for i in range(3):
        x.arrive([r for r in rows if i * 400 <= r[1] < (i + 1) * 400] + [("zz", 5000)] * (i == 2))
        x.follow()
    whole = x.found(spark.read.schema(SCHEMA).json(f"{x.dir}/in/*")).filter("k <> 'zz'")
    in_time = [r for r in rows if r[1] < 1200]
    assert sorted(map(tuple, x.closed().drop("batch_id").collect())) == sorted(map(tuple, whole.collect()))
    assert x.counts() == (len(in_time) + 1, len(in_time), 1, 0)


def test_a_killed_run_gives_each_session_once(spark, monkeypatch):
    x = Input(spark, "killed")
    x.arrive([("a", 0), ("a", 5), ("b", 300)])
    real = S.follow_sessions

    def dies(stream, target, checkpoint):
        def commit(batch, number):
            batch.write.mode("overwrite").parquet(f"{target}/{S.BATCH}={number}")
            if number == 1:
                raise RuntimeError("killed")
        (stream.writeStream.outputMode("append").foreachBatch(commit).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())

    monkeypatch.setattr(S, "follow_sessions", dies)
    with pytest.raises(Exception, match="killed"):
        x.follow()
    monkeypatch.setattr(S, "follow_sessions", real)
    x.follow()
    assert x.rows() == [("a", 0, 15, 2)] and x.counts() == (3, 2, 1, 0)


def test_empty_input_and_missing_lateness(spark):
    x = Input(spark, "empty")
    x.arrive([])
    assert x.found(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="late_by"):
        x.found(spark.readStream.schema(SCHEMA).json(f"{x.dir}/in/*"))
