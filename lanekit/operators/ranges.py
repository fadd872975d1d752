"""Joins on ranges, as equi-joins: overlapping intervals and inequalities.

Both give each row a few bucket keys such that two rows share a key exactly
once if they belong together, and (almost) never otherwise. What is left is a
plain join on these keys, which Spark shuffles, sorts and splits like any
other; nothing is compared with everything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanekit.operators.ordered import ranks
from lanekit.sources.scratch import materialize

#: An interval without end goes on to here; no time reaches it.
OPEN = 1 << 62
#: Neighbouring ranks that are compared one by one in :func:`inequality_join`
#: and in the measures of :func:`interval_join`.
BLOCK_BITS = 6

#: How measures of pairs are merged: of a cell's rows, then of a row's cells.
_MEASURE = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def _checked(measures: Mapping[str, tuple[str, str]]) -> None:
    for how, _ in measures.values():
        if how not in _MEASURE:
            raise ValueError(f"not a measure: {how!r}")


def _of_rows(measures: Mapping[str, tuple[str, str]], row: str) -> list[Column]:
    """Aggregates of right rows, as columns ``of_<measure>``."""
    return [_MEASURE[how][0](F.lit(1) if c == "*" else F.col(row)[c]).alias(f"of_{m}") for m, (how, c) in measures.items()]


def _merged(measures: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Aggregates of columns ``of_<measure>``, under the same names."""
    return [_MEASURE[how][1](f"of_{m}").alias(f"of_{m}") for m, (how, _) in measures.items()]


def as_units(df: DataFrame, column: str) -> Column:
    """Times as whole numbers: microseconds, days, or the number itself."""
    kind = dict(df.select(column).dtypes)[column]
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if kind == "date":
        return F.unix_date(column).cast("long")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("long")
    raise TypeError(f"{column} is {kind}; intervals are of timestamps, dates or whole numbers")


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


# -------------------------------------------------------------- interval join

def _spans(df: DataFrame, start: str, end: str | None, on: Sequence[str], side: str) -> DataFrame:
    """The rows of ``df`` as a struct, their keys, and [from, to) in units with
    its level: the smallest power of two that is not below its length. Spans
    that are empty or have a null key or start match nothing and are left out."""
    low = as_units(df, start)
    high = low + 1 if end is None else F.coalesce(as_units(df, end), F.lit(OPEN))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias(f"{side}_row"),
                     *[F.col(c).alias(f"{side}_k{i}") for i, c in enumerate(on)], low.alias(f"{side}_from"), high.alias(f"{side}_to"))
    rows = rows.dropna(subset=[*[f"{side}_k{i}" for i in range(len(on))], f"{side}_from"]).filter(f"{side}_from < {side}_to")
    length = F.col(f"{side}_to") - F.col(f"{side}_from")
    return rows.withColumn(f"{side}_level", F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))))


def _copies(rows: DataFrame, side: str, own_levels: list[int], other_levels: list[int]) -> DataFrame:
    """A copy of each row per role, level and bucket it is looked for in.

    Two spans meet at the greater of their levels. There the one whose level
    it is, is *at home*; the other, shorter one is a guest. Guests never meet
    guests: ``role`` 1 pairs left rows at home with all right ones, ``role`` 2
    left guests with right rows at home."""
    level = F.col(f"{side}_level")
    roles = []
    for x in sorted({*own_levels, *other_levels}):
        at_home, guest = level == x, level < x
        if x in own_levels and min(other_levels, default=x + 1) <= x:
            roles.append(F.when(at_home, F.struct(F.lit(1).alias("role"), F.lit(x).alias("x"))))
            if side == "right":
                roles.append(F.when(at_home, F.struct(F.lit(2).alias("role"), F.lit(x).alias("x"))))
        if min(own_levels, default=x) < x and x in other_levels:
            roles.append(F.when(guest, F.struct(F.lit(2 if side == "left" else 1).alias("role"), F.lit(x).alias("x"))))
    none = F.array().cast("array<struct<role:int,x:int>>")
    spread = rows.withColumn("__at", F.explode(F.array_compact(F.array(*roles)) if roles else none))
    first, last = (_shift(F.col(f"{side}_{c}") - n, F.col("__at.x")) for c, n in (("from", 0), ("to", 1)))
    return spread.select("*", F.explode(F.sequence(first, last)).alias(f"{side}_bucket")).select(
        *rows.columns, F.col("__at.role").alias(f"{side}_role"), F.col("__at.x").alias(f"{side}_x"), f"{side}_bucket")


def _near(first: Column, end: Column) -> Column:
    """What [first, end) of ranks takes of blocks that it does not fill, as
    (node, low, high): one part of a block, or two."""
    size, mask = 1 << BLOCK_BITS, (1 << BLOCK_BITS) - 1
    a, b, low, high = F.shiftright(first, BLOCK_BITS), F.shiftright(end, BLOCK_BITS), first.bitwiseAND(mask), end.bitwiseAND(mask)

    def part(met, node, low, high):
        return F.when(met & (low < high), F.struct(node.alias("node"), low.alias("low"), high.alias("high")))
    zero, whole = F.lit(0).cast("long"), F.lit(size).cast("long")
    return F.explode(F.array_compact(F.array(
        part(a == b, a, low, high), part((a < b) & (low > 0), a, low, whole), part(a < b, b, zero, high))))


def _far(first: Column, end: Column, levels: int) -> Column:
    """The blocks that [first, end) of ranks fills, as the fewest (level,
    node): at most two per level, and a block lies in one of them."""
    out = []
    for x in range(levels):
        low, high = (F.shiftright(c, BLOCK_BITS + x) for c in (first + ((1 << (BLOCK_BITS + x)) - 1), end))
        for odd, node in ((low, low), (high, high - 1)):
            out.append(F.when((low < high) & (odd.bitwiseAND(1) == 1), F.struct(F.lit(x).alias("level"), node.alias("node"))))
    return F.explode(F.array_compact(F.array(*out)))


def _above(block: Column, levels: int) -> Column:
    """The (level, node) that a block lies in."""
    return F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.shiftright(block, x).alias("node")) for x in range(levels)]))


def _span_measures(a: DataFrame, b: DataFrame, ks: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(keys, from, to) of the left spans with a partner, and their partners'
    measures. Either the right span covers the left one's start, or it starts
    within the left one behind its start: ranks in spans both times, so right
    spans (or starts) are summed up per part of a block and per node of blocks
    before they are met."""
    def spans(df, side):
        return df.select(*[F.col(f"{side}_{k}").alias(k) for k in ks], F.col(f"{side}_from").alias("from"), F.col(f"{side}_to").alias("to"),
                         *[c for c in df.columns if c == "right_row"])

    sides = {"left": materialize(spans(a, "left").distinct(), "interval-left"),
             "right": materialize(spans(b, "right").groupBy(*ks, "from", "to").agg(*_of_rows(measures, "right_row")), "interval-right")}
    ends = reduce(DataFrame.unionByName, [df.select(*ks, F.col(c).alias("value")) for df in sides.values() for c in ("from", "to")])
    ranked = materialize(ranks(ends.distinct(), [*ks, "value"]), "interval-ranks")
    levels = int((ranked.agg(F.max("rank")).first()[0] or 0) >> BLOCK_BITS).bit_length()
    for s in sides:
        for c, r in (("from", "first"), ("to", "end")):
            sides[s] = sides[s].join(ranked.select(*ks, F.col("value").alias(c), F.col("rank").alias(r)), [*ks, c])
        sides[s] = materialize(sides[s], f"interval-placed-{s}")
    lefts, rights = sides.values()
    block, place = F.shiftright("first", BLOCK_BITS).alias("node"), F.col("first").bitwiseAND((1 << BLOCK_BITS) - 1).alias("place")
    of = [f"of_{m}" for m in measures]

    def summed(df, *by):
        return df.groupBy(*ks, *by).agg(*_merged(measures))

    def meet(df, other, *by):
        # exploded rows are more than the planner counts: it must not broadcast them
        return df.join(other.hint("merge"), [*ks, *by])

    def inline(df, made, *columns):
        return df.select(*ks, *columns, made.alias("__at")).select(*ks, *columns, "__at.*")

    inside = (F.col("low") <= F.col("place")) & (F.col("place") < F.col("high"))
    first, end = F.col("first"), F.col("end")
    # right spans that cover a left start; what fills its block is looked up once for the block
    starts = lefts.select(*ks, "from", block, place).distinct()
    near = summed(inline(rights, _near(first, end), *of), "node", "low", "high")
    found = [meet(starts, near, "node").filter(inside).select(*ks, "from", *of)]
    if levels:
        far = summed(inline(rights, _far(first, end, levels), *of), "level", "node")
        blocks = inline(starts.select(*ks, F.col("node").alias("block")).distinct(), _above(F.col("block"), levels), "block")
        full = summed(meet(blocks, far, "level", "node"), "block").withColumnRenamed("block", "node")
        found.append(meet(starts, full, "node").select(*ks, "from", *of))
    covering = summed(reduce(DataFrame.unionByName, found), "from")
    found = [lefts.select(*ks, "from", "to").join(covering, [*ks, "from"])]
    # right spans that start within a left one
    begun = summed(rights, "first").select(*ks, block, place, *of)
    found.append(meet(inline(lefts, _near(first + 1, end), "from", "to"), begun, "node").filter(inside).select(*ks, "from", "to", *of))
    if levels:
        nodes = summed(inline(summed(begun, "node").withColumnRenamed("node", "block"), _above(F.col("block"), levels), *of), "level", "node")
        found.append(meet(inline(lefts, _far(first + 1, end, levels), "from", "to"), nodes, "level", "node").select(*ks, "from", "to", *of))
    return summed(reduce(DataFrame.unionByName, found), "from", "to")


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str | None], right_span: tuple[str, str | None],
                  on: Sequence[str] = (), left_name: str = "left", right_name: str = "right",
                  measures: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Pairs of rows with equal ``on`` columns whose spans overlap, as two
    struct columns ``left_name`` and ``right_name``.

    A span is [start, end): timestamps, dates or whole numbers, both sides
    alike. Without an end column (None) it is the instant ``start``; a null end
    is open. Null starts and keys, and spans that end before they begin, match
    nothing.

    Levels are powers of two. A pair meets at the level of its longer span,
    where neither covers more than two buckets, in the bucket that holds the
    later of the two starts: exactly one. A row has at most two copies per
    level that the other side has (up to 63, counted beforehand), however long
    its span is.

    With ``measures``, as in :func:`inequality_join`, the result has a row per
    left row with a partner: its struct and the measures of its partners. No
    pair is made then: starts and ends of both sides are ranked together, and
    right spans are summed up per part of a block of ``2 ** BLOCK_BITS`` ranks
    and per node of a binary tree of blocks. A span has two parts and two
    nodes per level at most, so the work goes with the rows and the logarithm
    of their number, not with the pairs; equal spans are one.
    """
    a, b = _spans(left, *left_span, on, "left"), _spans(right, *right_span, on, "right")
    if measures is not None:
        _checked(measures)
        ks = [f"k{i}" for i in range(len(on))]
        found = _span_measures(a, b, ks, measures)
        same = [F.col(f"left_{c}") == found[c] for c in (*ks, "from", "to")]
        return a.join(found, reduce(Column.__and__, same)).select(
            F.col("left_row").alias(left_name), *[F.col(f"of_{m}").alias(m) for m in measures])
    levels = [[r[0] for r in s.select(c).distinct().collect()] for s, c in ((a, "left_level"), (b, "right_level"))]
    lefts, rights = _copies(a, "left", *levels), _copies(b, "right", *reversed(levels))
    later = F.greatest("left_from", "right_from")
    keys = [F.col(f"left_{c}") == F.col(f"right_{c}") for c in ("role", "x", "bucket", *[f"k{i}" for i in range(len(on))])]
    met = (F.col("left_from") < F.col("right_to")) & (F.col("right_from") < F.col("left_to"))
    owner = _shift(later, F.col("left_x")) == F.col("left_bucket")
    return lefts.join(rights, reduce(Column.__and__, keys) & met & owner).select(
        F.col("left_row").alias(left_name), F.col("right_row").alias(right_name))


# ------------------------------------------------------------ inequality join

def _numbered(df: DataFrame, side: str) -> DataFrame:
    """``df`` written once, with a number of its own for every row."""
    return materialize(df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("id")),
                       f"inequality-{side}")


def _dyadic(block: Column, levels: int, wanted: int) -> Column:
    """Keys of a block: (level, prefix above it) for each level at which its
    bit is ``wanted``, and the block itself. Of two different blocks the lower
    has 0 and the upper 1 at the highest bit that differs, so they share
    exactly that key; equal blocks share the last one."""
    def at(x):
        return F.when(F.shiftright(block, x).bitwiseAND(1) == wanted,
                      F.shiftright(block, x + 1) * 64 + x)
    return F.array_compact(F.array(*[at(x) for x in range(levels)], block * 64 + 63))


def inequality_join(left: DataFrame, right: DataFrame, conditions: Sequence[tuple[str, str, str]], on: Sequence[str] = (),
                    left_name: str = "left", right_name: str = "right",
                    measures: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Pairs of rows that meet one or two (or more) inequalities, as two
    struct columns. ``conditions`` are (left column, ``<``, ``<=``, ``>`` or
    ``>=``, right column); ``on`` columns must be equal. Nulls match nothing.

    For every condition the values of both sides are ranked together within
    their key, such that the condition is "left rank below right rank"
    (counted from the end for ``>``; among equal values the side comes first
    that makes it so). Ranks are cut into blocks of ``2 ** BLOCK_BITS``; two
    rows in different blocks share exactly one key of :func:`_dyadic`, and
    sharing it proves the condition. Rows of one block are compared. With two
    conditions a row has a copy per pair of keys: about (log2 of the largest
    key's blocks / 2) squared, with its columns, so that pairs are whole where
    they are found and move no more. The pairs that are looked at and dropped
    are those within a block only, so the work goes with the rows and the
    result, never with their product. A value with very many rows is one rank:
    its rows share all their keys and join like those of any other frequent
    key.

    With ``measures``, name -> (``count``, ``sum``, ``min`` or ``max``, right
    column or ``*``), the result has a row per left row with a partner: its
    struct and the measures of its partners. The right rows of a key are then
    summed up before they meet the left ones, so that no pair between blocks
    is made and the work does not go with their number; only rows of one block
    are paired.
    """
    _checked(measures or {})
    sides = {"left": _numbered(left, "left"), "right": _numbered(right, "right")}
    ks = [f"k{i}" for i in range(len(on))]
    keyed = {s: df.select("id", "row", *[F.col("row")[c].alias(k) for c, k in zip(on, ks)]).dropna(subset=ks)
             for s, df in sides.items()}
    rows = dict(keyed)
    for i, (a, op, b) in enumerate(conditions):
        if op not in ("<", "<=", ">", ">="):
            raise ValueError(f"not an inequality: {op!r}")
        # equal values: the left side comes first where equal ones match going up, or do not match going down
        first = "left" if op in ("<=", ">") else "right"
        order = [*ks, "value", "side"]
        values = {s: df.select("id", *ks, F.col("row")[c].alias("value"), F.lit(0 if s == first else 1).alias("side"))
                  .filter("value is not null") for (s, df), c in zip(keyed.items(), (a, b))}
        ranked = materialize(ranks(values["left"].select(*order).unionByName(values["right"].select(*order)), order), "inequality-ranks")
        # a key's ranks are counted from its first one: few levels if no key has many rows
        span = ranked.groupBy(*ks).agg(F.min("rank").alias("lowest"), F.max("rank").alias("highest"))
        total = span.agg(F.max(F.col("highest") - F.col("lowest"))).first()[0] or 0
        levels = max(0, int(total).bit_length() - BLOCK_BITS)
        ranked = ranked.join(span, ks) if ks else ranked.withColumns({"lowest": F.lit(0), "highest": F.lit(int(total))})
        # for > from the end: the greater value is the lower rank
        ranked = ranked.select(*order, (F.col("highest") - F.col("rank") if op.startswith(">") else F.col("rank") - F.col("lowest")).alias("rank"))
        for s in sides:
            of = values[s].join(ranked, order).select("id", F.col("rank").alias(f"r{i}"))
            keys = _dyadic(F.shiftright(f"r{i}", BLOCK_BITS), levels, 0 if s == "left" else 1)
            rows[s] = rows[s].join(of, "id").withColumn(f"d{i}", keys)
    n = range(len(conditions))
    ds, rs = [f"d{i}" for i in n], [f"r{i}" for i in n]

    def exploded(s, carried):
        df = rows[s].select(*carried, *ks, *rs, *ds)
        for d in ds:
            df = df.withColumn(d, F.explode(d))
        return df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns])

    same = [F.col(f"left_{c}") == F.col(f"right_{c}") for c in [*ks, *ds]]
    if measures is None:
        below = [F.col(f"left_{r}") < F.col(f"right_{r}") for r in rs]
        return exploded("left", ["row"]).join(exploded("right", ["row"]), reduce(Column.__and__, same + below)).select(
            F.col("left_row").alias(left_name), F.col("right_row").alias(right_name))

    inputs = {m: (F.lit(1) if c == "*" else F.col("right_row")[c]) for m, (_, c) in measures.items()}
    lefts = exploded("left", ["id"])
    rights = exploded("right", ["row"]).select("*", *[c.alias(f"of_{m}") for m, c in inputs.items()]).drop("right_row")
    # a condition whose key is a block of its own is still to be compared; others are met by all of a key's rows
    cells = ["right_" + c for c in [*ks, *ds]]
    for d, r in zip(ds, rs):
        alone = F.col(f"right_{d}").bitwiseAND(63) == 63
        rights = rights.withColumn(f"right_{r}", F.when(alone, F.col(f"right_{r}")))
    rights = rights.groupBy(*cells, *[f"right_{r}" for r in rs]).agg(
        *[_MEASURE[how][0](f"of_{m}").alias(f"of_{m}") for m, (how, _) in measures.items()])
    below = [F.col(f"right_{r}").isNull() | (F.col(f"left_{r}") < F.col(f"right_{r}")) for r in rs]
    found = lefts.join(rights, reduce(Column.__and__, same + below)).groupBy("left_id").agg(
        *[_MEASURE[how][1](f"of_{m}").alias(m) for m, (how, _) in measures.items()])
    return sides["left"].join(found, F.col("id") == F.col("left_id")).select(F.col("row").alias(left_name), *measures)
