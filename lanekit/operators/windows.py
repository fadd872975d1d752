"""Window operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups above this many rows are numbered by the split (range-partitioned)
# path of :func:`rank_rows`; the hot-key set is then at most rows / threshold.
HOT_GROUP_ROWS = 1_000_000

def _order(cols: Sequence) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rn",
              skew_safe: bool = True, hot_threshold: int = HOT_GROUP_ROWS,
              partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)``; ascending
    keys sort nulls first (Spark's default). Give a full tie-break in
    ``order`` for a deterministic numbering.

    ``skew_safe=True`` (the default) never numbers a group in a single task: groups with
    more than ``hot_threshold`` rows are range-partitioned on (keys, order)
    across ``partitions`` tasks (default: shuffle partitions), numbered per
    task, and shifted by the row counts of the preceding tasks of the same
    key. The range-partitioned rows are written once, with the number of the
    range they fell into, and both the numbering and the counts read that
    table: range bounds are sampled, so planning them twice could cut the same
    rows differently. Other groups take the ordinary window. It costs one
    extra counting pass; ``skew_safe=False`` gives the plain window.
    """
    if not skew_safe:
        w = Window.partitionBy(*keys).orderBy(*_order(order))
        return df.withColumn(out, F.row_number().over(w))
    from lanekit.sources.scratch import materialize
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    # the hot-key set (at most rows / hot_threshold keys) is written once to
    # the shared folder, so the counting pass is not repeated by the plan
    hot = materialize(counts.where(F.col("__n") > F.lit(hot_threshold)).select(*keys), "hot_keys")
    if hot.isEmpty():
        return rank_rows(df, keys, order, out, skew_safe=False)
    # the written key set has a known size: the planner broadcasts it or not
    null_safe = [df[k].eqNullSafe(hot[k]) for k in keys]
    cold = df.join(hot, null_safe, "left_anti")
    hot_rows = df.join(hot, null_safe, "left_semi")

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _order(order)
    ranged = materialize(
        hot_rows.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], *ordered)
        .withColumn("__pid", F.spark_partition_id()), "hot_rows")
    local = ranged.withColumn(
        "__local", F.row_number().over(Window.partitionBy("__pid", *keys).orderBy(*ordered)))
    # rows per (task, key), then the rows of the same key in earlier tasks
    per_task = ranged.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__c"))
    offsets = per_task.withColumn(
        "__off", F.coalesce(F.sum("__c").over(
            Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .drop("__c")
    of = {k: f"__of_{k}" for k in ("__pid", *keys)}
    offsets = offsets.select(*[F.col(k).alias(a) for k, a in of.items()], "__off")
    numbered = local.join(offsets, [F.col(k).eqNullSafe(F.col(a)) for k, a in of.items()], "inner") \
        .withColumn(out, (F.col("__local") + F.col("__off")).cast("int")) \
        .drop("__local", "__off", "__pid", *of.values())
    cold_ranked = rank_rows(cold, keys, order, out, skew_safe=False)
    return cold_ranked.unionByName(numbered.select(*cold_ranked.columns))


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence,
                    keep_rank: str | None = None) -> DataFrame:
    """First row per group (``rn = 1``).

    Written as row_number + ``rn = 1`` so the optimizer inserts a
    ``WindowGroupLimit``: a partial top-1 runs in every map task *before* the
    shuffle, so even a group holding a third of all rows reaches the final
    window as at most one row per input partition.
    """
    name = keep_rank or "__rn"
    ranked = rank_rows(df, keys, order, name, skew_safe=False).where(F.col(name) == 1)
    return ranked if keep_rank else ranked.drop(name)
