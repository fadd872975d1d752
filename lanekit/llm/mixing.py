"""Mixing sources to target weights, in DataFrame operations only.

Every source gets a word budget, every document a hash-random key. Within a
source the documents are range-sorted by that key, a distributed prefix sum
of their sizes tells where each one begins, and the source is cut where the
prefix sum reaches its budget; a budget above the source's size repeats the
whole source first (epochs).

The keys are uniform, so the ranges of a source are known without sampling:
range ``i`` of ``2**bits`` equal ones, about ``rows_per_range`` documents
each, with ``bits`` from the source's own row count. A source that holds a
third of all rows is therefore spread over as many ranges as it needs. Prefix
sums go over three levels (blocks of ranges, ranges, documents), each with a
small window. The documents a source takes in its last epoch are those up to
one place in its order, so what a document needs for its decision is its own
key and one row of its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lanekit.llm.common import fresh, n_words, stage

KEY_BITS = 60
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 256
RANGES_PER_BLOCK_BITS = 12


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """60 uniform bits of an MD5 of seed, id and text, so that rows without an
    id, or of one id, have keys of their own; nulls count as ''."""
    of = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(of), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_docs) -> the same with ``target``.

    Sources in code point order, null last, take the weights in turn. Targets
    share the total by weight; one that would pass ``max_epochs`` times its
    source's size stops there and the rest is shared again. That is the level
    ``lam`` at which sum(min(cap, weight * lam)) is the total: with sources
    ordered by cap / weight, the first few are capped, and ``lam`` belongs to
    the first source whose own level does not pass its ratio. One row per
    source; empty in, empty out; all sizes 0: all targets 0.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))
    return (sources
            .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
            .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("level", level)
            .withColumn("place", F.row_number().over(by_ratio))
            .withColumn("lam", F.min(fits).over(everything)["level"])
            .select("source", "source_size", "n_docs",
                    F.least(F.col("cap"), F.col("weight") * F.col("lam")).alias("target")))


def sized_documents(docs: DataFrame, seed: str) -> DataFrame:
    """The narrow rows the mix is computed on."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       random_key(F.col("doc_id"), F.col("text"), seed).alias("key"))


def prefix_sums(rows: DataFrame) -> DataFrame:
    """Adds ``before``: the sizes of the documents of the same source that
    come earlier by key. ``rows`` has ``source``, ``range``, ``key``,
    ``doc_id`` and ``size``.

    What lies before a range is a prefix sum over blocks of ranges plus one
    over the ranges of its block; it enters the range as a leading row, so
    the last level needs no join, only the range partitioning itself.
    """
    block = F.shiftright("range", RANGES_PER_BLOCK_BITS)
    ranges = (rows.groupBy("source", "range").agg(F.sum("size").alias("size"))
              .withColumn("block", block))
    earlier = W.rowsBetween(W.unboundedPreceding, -1)
    blocks = (ranges.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
              .withColumn("range", F.lit(-1).cast("long"))
              .withColumn("size", F.coalesce(F.sum("block_size").over(
                  earlier.partitionBy("source").orderBy("block")), F.lit(0)))
              .select("source", "range", "size", "block"))
    heads = (ranges.unionByName(blocks)
             .withColumn("offset", F.sum("size").over(earlier.partitionBy("source", "block").orderBy("range")))
             .filter("range >= 0")
             .select("source", "range", F.lit(-1).cast("long").alias("key"),
                     F.col("offset").alias("size")))
    in_range = (W.partitionBy("source", "range").orderBy("key", "doc_id", "size")
                .rowsBetween(W.unboundedPreceding, -1))
    return (rows.unionByName(heads, allowMissingColumns=True)
            .repartitionByRange("source", "range")
            .withColumn("before", F.sum("size").over(in_range))
            .filter("key >= 0"))


def source_cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(source, source_size, target, epochs, cut), one row per source of
    ``rows`` (see :func:`sized_documents`): how often its whole size fits into
    the target, and the last place (key, id, size) that the rest reaches, null
    if it reaches none. A document is reached if its middle is."""
    per_source = stage(source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")),
        weights, max_epochs), "mix-sources")
    bits = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n_docs") / F.lit(float(rows_per_range)))))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = per_source.withColumn("epochs", epochs.cast("long"))
    named = plan.select(F.col("source").alias("named"), (F.lit(KEY_BITS) - bits).cast("int").alias("shift"),
                        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))
    placed = (rows.join(named, F.col("source").eqNullSafe(F.col("named")))
              .withColumn("range", F.call_function("shiftright", F.col("key"), F.col("shift")))
              .select("source", "range", "key", "doc_id", "size", "rest"))
    reached = prefix_sums(placed).filter((F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= F.col("rest")))
    cuts = reached.groupBy(F.col("source").alias("named")).agg(F.max(_place()).alias("cut"))
    return (plan.join(cuts, F.col("source").eqNullSafe(F.col("named")), "left")
            .select("source", "source_size", "target", "epochs", "cut"))


def _place() -> Column:
    """Where a document stands in its source."""
    return F.struct("key", "doc_id", "size")


def _times(cuts: DataFrame, alias: str) -> tuple[DataFrame, Column]:
    """The cuts under column ``alias`` and the number of times a document
    with key, id and size is taken by its source's."""
    found = cuts.select(F.struct("source", "source_size", "target", "epochs", "cut").alias(alias))
    c = F.col(alias)
    once_more = (F.col("size") > 0) & F.coalesce(_place() <= c["cut"], F.lit(False))
    return found, c["epochs"] + once_more.cast("long")


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``
    (columns doc_id, source, text; others are ignored).

    ``taken`` is a whole number of times the size: all full epochs of the
    budget, plus once more where the document's middle lies before the cut of
    the last, partial epoch (so a source misses its target by at most half a
    document). Keys depend on id, text and seed only, so reruns agree. Null or
    empty texts have size 0 and take 0; null sources form one source, last in
    order; a null id counts as the empty string; rows that repeat an id are
    rows of their own, and only those that repeat id, text and source share a
    decision. No rows in, none out.
    """
    rows = stage(sized_documents(docs, seed), "mix-sizes")
    cuts, times = _times(stage(source_cuts(rows, weights, max_epochs, rows_per_range), "mix-cuts"), "found")
    return (rows.join(cuts, F.col("source").eqNullSafe(F.col("found")["source"]))
            .select("doc_id", "size", F.col("found")["source_size"].alias("source_size"),
                    F.col("found")["target"].alias("target"), (F.col("size") * times).alias("taken")))


def mixed(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS,
          max_epochs: int = MAX_EPOCHS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its
    columns unchanged; a document that the mix does not take goes, one that
    three epochs take comes three times. A document's key and its source's cut
    decide, so texts stay where they are."""
    rows = stage(sized_documents(docs, seed), "mix-sizes")
    cuts = stage(source_cuts(rows, weights, max_epochs, rows_per_range), "mix-cuts")
    found, row, turn = fresh("found"), fresh("row"), fresh("turn")
    cuts, times = _times(cuts, found)
    wide = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias(row), "doc_id", "source",
                       n_words(F.col("text")).alias("size"), random_key(F.col("doc_id"), F.col("text"), seed).alias("key"))
    return (wide.join(cuts, F.col("source").eqNullSafe(F.col(found)["source"]))
            .withColumn("size", times * (F.col("size") > 0).cast("long")).filter("size > 0")
            .withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("size").cast("int"))))
            .select(*[F.col(row)[c].alias(c) for c in docs.columns]))
