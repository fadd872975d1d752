"""Projections: renames with literal/cast columns, conditional measures and
derived partition columns."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Select ``{output name: column or source name}`` in the given order."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])


def zero_when(cond: Column, value) -> Column:
    """``case when cond then 0 else value end``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(cond, F.lit(0)).otherwise(v)


def derive_month(df: DataFrame, src: str = "dt", out: str = "month") -> DataFrame:
    """Add (or replace) ``out = substr(src, 1, 6)``, e.g. ``20220123 -> 202201``.
    Applied only when ``src`` is a real column of ``df``."""
    if src not in df.columns:
        return df
    return df.withColumn(out, F.substring(F.col(src).cast("string"), 1, 6))
