"""Aggregations. All are decomposable (sum / count), so Spark runs a partial
aggregate in every map task before the shuffle."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_or_zero(c) -> Column:
    """``sum(coalesce(c, 0))``."""
    return F.sum(F.coalesce(_col(c), F.lit(0)))


def present_count(c) -> Column:
    """``sum(case when c is null then 0 else 1 end)``: like ``count(c)`` on
    non-empty groups, and null (not 0) on an empty input."""
    return F.sum(F.when(_col(c).isNull(), F.lit(0)).otherwise(F.lit(1)))


def category_sums(df: DataFrame, keys: Sequence[str], category, measures: Mapping[str, tuple]) -> DataFrame:
    """One pass, one shuffle: ``measures`` maps output name -> (category value,
    value expression); each output is ``sum(value) where category = v``.
    A group without the category gets null, like a left join whose ON clause
    tests the category."""
    cat = _col(category)
    aggs = [F.sum(F.when(cat == F.lit(v), _col(expr))).alias(name)
            for name, (v, expr) in measures.items()]
    return df.groupBy(*keys).agg(*aggs)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """GROUP BY without aggregates: distinct key tuples."""
    return df.select(*keys).distinct()


def grouped_having(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], having) -> DataFrame:
    """``group by keys`` then a HAVING predicate on the aggregated columns."""
    out = df.groupBy(*keys).agg(*aggs)
    return out.where(having) if having is not None else out
