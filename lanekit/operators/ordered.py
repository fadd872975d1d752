"""Operators over ordered groups that never hold a group in one task: as-of
joins, row frames, global ranks.

All of them cut an order into ranges. A range is what one task sorts; what a
row needs from beyond its range is a few values per range (the last version
before it, the rows counted before it, some neighbouring rows), however large
the group is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from lanekit.operators.windows import HOT_GROUP_ROWS, rank_rows
from lanekit.sources.scratch import materialize

#: Rows of one key that a task frames at once (more if the frame is wider).
FRAME_ROWS = 200_000


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written once, with its range's
    number in ``__range``. Bounds come from a sample, so a range must not be
    planned twice: all readers use the written numbers."""
    n = partitions or _shuffle_partitions(df)
    return materialize(df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), name)


def ranks(values: DataFrame, order: Sequence[str], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """The distinct rows of ``values`` (columns ``order``) with ``out``: how
    many rows of ``values`` come before, as a long. Equal rows share a rank,
    so they are counted before anything is sorted and a frequent value is one
    row. Nulls come first."""
    counts = values.groupBy(*order).agg(F.count(F.lit(1)).alias("__n"))
    ranged = in_ranges(counts, order, "ranks", partitions)
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    # a row per range
    offsets = (ranged.groupBy("__range").agg(F.sum("__n").alias("__n"))
               .select("__range", F.coalesce(F.sum("__n").over(earlier.orderBy("__range")), F.lit(0)).alias("__offset")))
    within = F.coalesce(F.sum("__n").over(earlier.partitionBy("__range").orderBy(*order)), F.lit(0))
    return (ranged.withColumn("__within", within).join(offsets, "__range")
            .select(*order, (F.col("__offset") + F.col("__within")).alias(out)))


# ------------------------------------------------------------------ as-of join

def as_of_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
               columns: Mapping[str, str], tie: Sequence[str] = (), how: str = "left", strict: bool = False,
               since: Callable[[Column], Column] | None = None, partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with the last version of its key: the row of
    ``right`` that has equal ``on`` columns and the greatest ``right_time`` not
    after ``left_time`` (before it, if ``strict``).

    ``columns`` maps columns of ``right`` to their names in the result. Of
    versions of one time the one greatest by ``tie``, then by ``columns``,
    counts. ``since`` maps the left time to the earliest time that a version
    may have; older ones do not match. ``how``: ``left`` keeps rows without a
    version (nulls), ``inner`` drops them. Null keys or times match nothing.

    Versions and the distinct (key, time) pairs that ask for them are sorted
    together into ranges; within a range the last version is carried forward,
    and a range's first key also takes the last version of the ranges before
    it. A key with very many rows is thus spread over many ranges, and rows of
    ``left`` travel once, to meet their answer.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    keys = [f"__k{i}" for i in range(max(len(on), 1))]
    order = [*keys, "__time", "__side"]
    kind = dict(left.select(left_time).dtypes)[left_time]

    def keyed(df, time, *more):
        named = [F.col(c) for c in on] or [F.lit(0)]
        rows = df.select(*[c.alias(k) for c, k in zip(named, keys)], F.col(time).cast(kind).alias("__time"), *more)
        return rows.dropna(subset=[*keys, "__time"])

    payload = F.struct(F.col("__time").alias("time"), *[F.col(f"__v.{o}").alias(o) for o in columns.values()]).alias("__last")
    best = F.struct(*[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)], *[F.col(c).alias(o) for c, o in columns.items()])
    versions = (keyed(right, right_time, best.alias("__v")).groupBy(*keys, "__time").agg(F.max("__v").alias("__v"))
                .select(*keys, "__time", F.lit(1 if strict else 0).alias("__side"), payload))
    asked = keyed(left, left_time).distinct().withColumn("__side", F.lit(0 if strict else 1))
    ranged = in_ranges(versions.unionByName(asked, allowMissingColumns=True), order, "as_of", partitions)

    carried = F.last("__last", ignorenulls=True).over(
        Window.partitionBy("__range", *keys).orderBy("__time", "__side").rowsBetween(Window.unboundedPreceding, 0))
    # the last version in any earlier range belongs to a range's first key, or that key has none there
    key = F.struct(*keys)
    latest = F.max(F.when(F.col("__last").isNotNull(), F.struct(key.alias("key"), F.col("__time"), F.col("__last"))))
    edges = ranged.groupBy("__range").agg(F.min(key).alias("first"), latest.alias("latest"))
    before = F.last("latest", ignorenulls=True).over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    # a row per range: at most ``partitions`` rows are broadcast
    edges = edges.withColumn("before", before).filter(F.col("before.key") == F.col("first")).select(
        F.col("__range").alias("__of"), "first", F.col("before.__last").alias("__before"))
    found = (ranged.withColumn("__last", carried).filter(F.col("__side") == (0 if strict else 1))
             .join(F.broadcast(edges), (F.col("__range") == F.col("__of")) & (key == F.col("first")), "left")
             .select(*keys, "__time", F.coalesce("__last", "__before").alias("__last")).filter("__last is not null"))
    if since is not None:
        found = found.filter(F.col("__last.time") >= since(F.col("__time")))
    same = [left[c] == found[k] for c, k in zip(on, keys)] + [left[left_time] == found["__time"]]
    return left.join(found, same, how).select(*[left[c] for c in left.columns], *[F.col("__last")[o].alias(o) for o in columns.values()])


# ----------------------------------------------------------------- row frames

def framed(df: DataFrame, keys: Sequence[str], order: Sequence, columns: Mapping[str, Callable[[WindowSpec], Column]],
           before: int = 0, after: int = 0, block: int = FRAME_ROWS, hot_threshold: int = HOT_GROUP_ROWS) -> DataFrame:
    """``df`` with window columns that look at most ``before`` rows back and
    ``after`` rows ahead: moving sums, lags, leads.

    ``columns`` maps a name to a function of a window (already partitioned and
    ordered) that gives the column, for example
    ``lambda w: F.sum("x").over(w.rowsBetween(-6, 0))``. Give a full tie-break
    in ``order`` for a deterministic result.

    Rows are numbered per key (see :func:`rank_rows`) and cut into blocks of
    ``block`` rows; a block also gets the last ``before`` rows of the one
    before it and the first ``after`` of the next, which are dropped once
    their neighbours are done. So a task holds a block of a key, not the key.
    """
    size = max(block, before, after, 1)
    numbered = rank_rows(df, keys, order, "__rn", hot_threshold=hot_threshold)
    place, own = (F.col("__rn") - 1) % size, F.floor((F.col("__rn") - 1) / size).cast("long")
    blocks = F.array_compact(F.array(
        own, F.when(place >= size - before, own + 1), F.when((place < after) & (own > 0), own - 1)))
    copies = numbered.withColumn("__own", own).withColumn("__block", F.explode(blocks))
    window = Window.partitionBy(*keys, "__block").orderBy("__rn")
    done = copies.select("*", *[make(window).alias(name) for name, make in columns.items()])
    return done.filter(F.col("__block") == F.col("__own")).select(*df.columns, *columns)
