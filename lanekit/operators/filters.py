"""Row filters. Every filter is a plain Catalyst predicate so that it is pushed
into the parquet/ORC scan where the source supports it."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: end date that marks the current version of a row.
OPEN_END = "9999-12-31"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def current_rows(df: DataFrame, end_col: str = "end_time", open_value=OPEN_END) -> DataFrame:
    """Keep the current version of slowly-changing rows (``end == open``)."""
    return df.where(F.col(end_col) == F.lit(open_value))


def half_open(df: DataFrame, col, lo, hi) -> DataFrame:
    """``lo <= col < hi``; either bound may be None (unbounded)."""
    c = _col(col)
    conds = []
    if lo is not None:
        conds.append(c >= F.lit(lo))
    if hi is not None:
        conds.append(c < F.lit(hi))
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def has_prefix(df: DataFrame, col, prefix: str) -> DataFrame:
    """``substr(col, 1, len(prefix)) = prefix`` written as ``startswith`` so
    the parquet reader receives a ``StringStartsWith`` pushed filter."""
    return df.where(_col(col).startswith(prefix))


def in_list(df: DataFrame, col, values: Iterable) -> DataFrame:
    return df.where(_col(col).isin(list(values)))


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)


def apply_conditions(df: DataFrame, conditions: Mapping[str, Sequence[str]] | None,
                     clauses: Sequence[str] = ("where", "having")) -> DataFrame:
    """Caller-supplied SQL condition strings, ANDed per clause, applied in the
    fixed order where -> having (the order of ``clauses``). Unknown clause
    names are applied after those, in sorted order. Blank strings are ignored.
    """
    if not conditions:
        return df
    order = list(clauses) + sorted(k for k in conditions if k not in clauses)
    for clause in order:
        conds = [c for c in conditions.get(clause, []) or [] if c and c.strip()]
        if conds:
            df = df.where(" AND ".join(f"({c})" for c in conds))
    return df
