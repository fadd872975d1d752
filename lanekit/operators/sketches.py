"""Distinct counts and quantiles from sketches that are stored and merged.

A sketch is a binary column of bounded size, whatever the group's rows: HLL
for distinct values, KLL for quantiles. Both are built with partial aggregation
in the scanning tasks, so a group with a third of all rows sends one sketch a
task. Coarser groupings merge stored sketches without the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanekit.sources.scratch import materialize

#: 2 ** LG_K registers of a distinct sketch (8 KB); samples of a quantile sketch.
LG_K = 14
K = 400

def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error of a merged distinct estimate at so many standard
    deviations."""
    return deviations * 1.0389 / 2 ** (lg_k / 2)


def rank_error(k: int = K) -> float:
    """How far a quantile's rank may lie from the one asked for, as a share of
    the rows (99 of 100 times)."""
    return 2.296 / k ** 0.9021


def _hashable(df: DataFrame, column: str) -> Column:
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.col(column)
    # the sketch skips empty values, so none is left empty
    mark, text = (b"=", "binary") if isinstance(kind, T.BinaryType) else ("=", "string")
    return F.concat(F.lit(mark), F.col(column).cast(text))


def sketched(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str] | None = None,
             quantiles: Mapping[str, str] | None = None, lg_k: int = LG_K, k: int = K) -> DataFrame:
    """``keys`` and one sketch per name of ``distinct`` and ``quantiles`` (name
    -> column; quantiles of numbers), written once and read back. Null values
    are in no sketch, empty ones are values; NaN is in no quantile sketch. Values
    of other types than integers, strings and binaries count by their text."""
    aggregates = [F.hll_sketch_agg(_hashable(df, c), lg_k).alias(name) for name, c in (distinct or {}).items()]
    aggregates += [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(name) for name, c in (quantiles or {}).items()]
    return materialize(df.groupBy(*keys).agg(*aggregates), "sketches")


def merged(sketches: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """Sketches of the coarser grouping ``keys`` from stored ones. Sketches of
    later rows can be added with ``unionByName`` before."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in distinct],
                                       *[F.kll_merge_agg_double(c).alias(c) for c in quantiles])


def distinct_estimate(sketch: str | Column) -> Column:
    """The estimated number of distinct values; 0 for a group without any."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long")


def n_values(sketch: str | Column) -> Column:
    """The exact number of values that went into a quantile sketch."""
    return F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0)).cast("long")


def quantile(sketch: str | Column, rank: float) -> Column:
    """A value of the group whose rank is about ``rank`` (0 to 1); null for a
    group without values."""
    return F.when(n_values(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank))))
