"""Many groupings of one table: cubes from a lattice, exact distinct counts
that can be merged."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanekit.operators.ordered import in_ranges
from lanekit.sources.scratch import materialize

#: Estimating 2 ** k groupings is one aggregation with as many columns.
MAX_DIMS = 10

_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def cube(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def rollup(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def lattice_plan(dims: Sequence[str], sets: Iterable[tuple[str, ...]], size: Mapping[frozenset, int]) -> dict[frozenset, frozenset]:
    """For each grouping the finer one to compute it from: the smallest of
    those at hand. ``size`` has the estimated groups of each."""
    wanted = sorted({frozenset(s) for s in sets}, key=lambda s: (-len(s), sorted(s)))
    at_hand, parent = [frozenset(dims)], {}
    for s in wanted:
        if s != frozenset(dims):
            parent[s] = min((p for p in at_hand if p > s), key=lambda p: (size[p], len(p), sorted(p)))
            at_hand.append(s)
    return parent


def grouped(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, str]],
            sets: Iterable[tuple[str, ...]] | None = None) -> DataFrame:
    """The groupings ``sets`` (default: all, a cube) of ``df`` in one table:
    the columns ``dims`` (null where a grouping leaves one out), ``grouping_id``
    (a bit per dimension, the first one highest, set where it is left out) and
    ``measures``: name -> (``sum``, ``count``, ``min`` or ``max``, column).

    The rows are read once, for the finest grouping; every other one merges
    the groups of the smallest finer one (sizes are estimated by one pass over
    the finest), so no row is repeated per grouping. Null values of a
    dimension are a group of their own, told apart by ``grouping_id``. No rows
    in, none out.
    """
    sets = [tuple(s) for s in (cube(dims) if sets is None else sets)]
    if len(dims) > MAX_DIMS:
        raise ValueError(f"{len(dims)} dimensions; at most {MAX_DIMS}")
    finest = materialize(df.groupBy(*dims).agg(*[_FIRST[op](c).alias(name) for name, (op, c) in measures.items()]), "lattice")
    inner = [s for s in {frozenset(s) for s in sets} if 0 < len(s) < len(dims)]
    estimates = finest.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.struct(*sorted(s))) for s in inner]).first()
    size = {frozenset(dims): estimates[0], frozenset(): 1, **dict(zip(inner, estimates[1:]))}
    parent = lattice_plan(dims, sets, size)
    merged = [_MERGE[op](name).alias(name) for name, (op, _) in measures.items()]
    done = {frozenset(dims): finest}
    for s, p in parent.items():                              # finer ones first
        keys = [d for d in dims if d in s] or [F.lit(0).alias("__all")]
        done[s] = done[p].groupBy(*keys).agg(*merged)
        if s in parent.values():                             # others are computed from it
            done[s] = materialize(done[s], "lattice")
    types = {f.name: f.dataType for f in finest.schema.fields}
    parts = []
    for s in dict.fromkeys(frozenset(s) for s in sets):
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)
        parts.append(done[s].select(*[F.col(d) if d in s else F.lit(None).cast(types[d]).alias(d) for d in dims],
                                    F.lit(bits).cast("long").alias("grouping_id"), *measures))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ distinct counts

def _dictionary(values: DataFrame, partitions: int | None = None) -> DataFrame:
    """Distinct ``value`` -> dense number from 0, by ranges."""
    ranged = in_ranges(values.distinct(), ["value"], "dictionary", partitions)
    per = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # a row per range
    start = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("__range").orderBy("value")) - 1
    return (ranged.withColumn("__at", within).join(per.select("__range", start.alias("__start")), "__range")
            .select("value", (F.col("__start") + F.col("__at")).cast("long").alias("number")))


def value_sets(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Per group of ``keys`` the exact set of values of each column, as
    bits: keys, ``of`` (the name in ``columns``), ``bucket``, ``bits``.

    The pairs of key and value are reduced to distinct ones first, before and
    after a shuffle by both, so a frequent key is no hot group; values are
    numbered densely; the numbers of a group become words of 64 bits, a row for
    each bucket of 64 numbers that the group has a value in. So a group takes no
    more rows than it has values, however many values all groups have together.
    The sets can be stored and merged (see :func:`distinct_counts`). Null
    values belong to no set. Groups without any value have no rows.
    """
    sets = []
    for name, column in columns.items():
        # read and shuffled for the pairs alone: two narrow columns per set
        pairs = materialize(df.select(*keys, F.col(column).alias("value")).filter("value is not null").distinct(), "value-pairs")
        numbers = _dictionary(pairs.select("value"))
        numbered = pairs.join(numbers, "value").select(*keys, "number")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number").bitwiseAND(63).cast("int"))
        sets.append(numbered.groupBy(*keys, F.shiftright("number", 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))
                    .select(*keys, F.lit(name).alias("of"), "bucket", "bits"))
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return materialize(out, "value-sets")


def distinct_counts(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The number of distinct values per group of ``keys`` (some or all of the
    keys that ``sets`` were built with): a column per set, 0 where a group has
    no value in it. Words of one bucket are merged, then their bits counted."""
    names = [r[0] for r in sets.select("of").distinct().orderBy("of").collect()]
    merged = sets.groupBy(*keys, "of", "bucket").agg(F.bit_or("bits").alias("bits"))
    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("of") == name, F.bit_count("bits"))), F.lit(0)).cast("long").alias(name)
    return merged.groupBy(*keys).agg(*[count(n) for n in names])
