"""Scans of the driver-provided parquet tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


# Plan nodes behind which the partition count is only known by running jobs,
# or behind which the order of rows matters.
_NOT_A_SCAN = re.compile(r"\b(Join|Aggregate|Sort|Window|Repartition\w*|RebalancePartitions|GlobalLimit|Distinct|Generate)\b")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give an under-split scan at least ``min_partitions`` tasks
    (default: the cluster's default parallelism).

    A file scan gets one task per split, and a file holding a single row
    group cannot be split, so a small table can reach the per-row work as one
    task. Only scans with *fewer* splits than the target are redistributed
    (round-robin, so skew-free); a large input already has enough splits and
    is returned unchanged, without an extra shuffle. Anything but projections
    and filters of a scan is returned unchanged too: its partitions are the
    planner's, an order is kept, and nothing is executed to count them.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if _NOT_A_SCAN.search(df._jdf.queryExecution().optimizedPlan().toString()):
        return df
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def load(spark: SparkSession, sf_dir: str, name: str, min_partitions: int | None = None) -> DataFrame:
    """Parquet scan of ``{sf_dir}/{name}.parquet``; projection and filters
    applied later are pushed into this scan by Catalyst. ``min_partitions``
    opts into :func:`spread`."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, min_partitions) if min_partitions else df


class Tables:
    """Lazy accessor: ``Tables(spark, d).orders`` is the orders scan;
    ``overrides`` replaces chosen tables with given DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str, overrides: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.overrides = dict(overrides or {})
        self._scans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        if name not in self._scans:          # one scan object per table
            self._scans[name] = load(self.spark, self.sf_dir, name)
        return self._scans[name]
