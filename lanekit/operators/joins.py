"""Joins: dimension enrichment (left joins, role-playing dims, right-side
residual predicates) and existence tests."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(df: DataFrame, dim: DataFrame, keys: Mapping[str, str], columns: Mapping[str, str],
           how: str = "left", dim_filter: Column | str | None = None,
           broadcast: bool = False) -> DataFrame:
    """Join ``dim`` to ``df`` on ``keys`` (left column -> dim column) and add
    ``columns`` (dim column -> output name).

    ``dim_filter`` is a predicate on the dim applied *before* the join, which
    is how an ON-clause residual such as ``d.level in (5, 7)`` keeps unmatched
    left rows. Keys never match on null. ``broadcast=True`` is for dims that
    are bounded by construction; otherwise the planner decides by size, and
    adaptive execution again by the size it meets.
    """
    right = dim
    if dim_filter is not None:
        right = right.where(dim_filter)
    key_alias = {rk: f"__rk{i}_{rk}" for i, rk in enumerate(keys.values())}
    right = right.select(*[F.col(rk).alias(a) for rk, a in key_alias.items()],
                         *[F.col(src).alias(out) for src, out in columns.items()])
    if broadcast:
        right = F.broadcast(right)
    cond = reduce(lambda a, b: a & b,
                  [F.col(lk) == F.col(key_alias[rk]) for lk, rk in keys.items()])
    return df.join(right, cond, how).drop(*key_alias.values())


def enrich_chain(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """Apply several :func:`enrich` calls in order (each spec is its kwargs)."""
    return reduce(lambda acc, spec: enrich(acc, **spec), specs, df)


def _keys_of(keys_df: DataFrame, on: Mapping[str, str] | Sequence[str]) -> tuple[DataFrame, Column]:
    """The distinct keys and the join condition. Distinct first: a key that
    holds a large share of the right side leaves each map task as one row,
    where a semi or anti join would send all its rows to one task (adaptive
    execution splits hot partitions on the left side of these joins only)."""
    if not isinstance(on, Mapping):
        on = {k: k for k in on}
    alias = {rk: f"__sk{i}" for i, rk in enumerate(on.values())}
    right = keys_df.select(*[F.col(rk).alias(a) for rk, a in alias.items()]).distinct()
    return right, reduce(lambda a, b: a & b, [F.col(lk) == F.col(alias[rk]) for lk, rk in on.items()])


def keep_matching(df: DataFrame, keys_df: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (left semi join)."""
    return df.join(*_keys_of(keys_df, on), "left_semi")


def keep_missing(df: DataFrame, keys_df: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_df`` (left join, then
    right key is null, as an anti join)."""
    return df.join(*_keys_of(keys_df, on), "left_anti")
