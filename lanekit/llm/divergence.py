"""Source divergence audit: how the terms of one source differ from those of
its language and of the language's other sources.

Count-cell ranking. The value of a term depends on two counts only, the
group's and the language's (or the other source's), and counts repeat a lot.
So terms are grouped into cells by their pair of counts, the value is worked
out once a cell, cells of one value are merged, and their cumulative
multiplicity tells which values reach the first ranks; only the terms of these
values are looked up again and put in UTF-8 order.

Terms are counted in tasks (a bounded table of sums per task, flushed when
full), so a text never travels. Pairs of sources are compared in blocks of
terms: a block holds the counts of some terms in all sources of a language,
and its sums per pair are added up afterwards. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lanekit.llm.common import stage

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
#: Sums a counting task holds before it hands them on.
HELD_SUMS = 400_000
#: Counts in a block of terms (terms x sources), and sources whose pairs one
#: task compares with all later ones.
BLOCK_CELLS = 1 << 18
STRIPE = 512

#: Letters keep their byte (A-Z in lower case), as do all bytes of characters
#: beyond ASCII; everything else separates terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of A-Z, a-z and characters beyond ASCII, A-Z lower-cased, as
    UTF-8."""
    return text.encode("utf-8").translate(_TERM_BYTES).split()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> sums (lang, source, term, n, docs). A row with
    a null term marks a group as present."""
    held: dict[tuple, dict] = {}
    size = 0

    def flush():
        for (lang, source), group in held.items():
            names = list(group)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(names), pa.string()), "source": pa.array([source] * len(names), pa.string()),
                "term": pa.array([t if t is None else t.decode("utf-8") for t in names], pa.string()),
                "n": pa.array([group[t][0] for t in names], pa.int64()),
                "docs": pa.array([group[t][1] for t in names], pa.int64())})

    for batch in batches:
        for lang, source, text in zip(*[batch.column(i) for i in range(3)]):
            group = held.setdefault((lang.as_py(), source.as_py()), {None: [0, 0]})
            before = len(group)
            for term, n in Counter(terms_of(text.as_py())).items():
                sums = group.get(term)
                if sums is None:
                    group[term] = [n, 1]
                else:
                    sums[0] += n
                    sums[1] += 1
            size += len(group) - before + 1
            if size > HELD_SUMS:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all of ``docs``; null text, lang and
    source are ''. Every group also has a row with a null term."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    sums = rows.mapInArrow(_sums, "lang string, source string, term string, n long, docs long")
    # summed up before the shuffle already: a second partial sum would find little
    sums = sums.repartition("lang", "source", "term")
    return sums.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def smoothed(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(UNIT * (count + 2) / (total + 2 * terms)), exactly."""
    top = (count.cast("decimal(19,0)") + 2) * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, (total + 2 * terms).cast("decimal(19,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / (p + q)); p and q are at most UNIT + 1, so the
    square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, lang_n): the terms in at least ``min_docs`` documents of
    the language and their occurrences there."""
    return (counts.filter("term is not null").groupBy("lang", "term")
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"))


def group_sizes(counts: DataFrame, kept: DataFrame, used: DataFrame) -> DataFrame:
    """(lang, source, place, total, lang_total, terms), a row per group: its
    place among the language's sources, its occurrences of kept terms, the
    language's, and the number of kept terms (0 where there are none)."""
    groups = counts.select("lang", "source").distinct()
    per_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    per_group = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    return (groups.join(per_lang, "lang", "left").join(per_group, ["lang", "source"], "left")
            .select("lang", "source", F.row_number().over(W.partitionBy("lang").orderBy("source")).alias("place"),
                    *[F.coalesce(c, none).alias(c) for c in ("total", "lang_total", "terms")]))


# -------------------------------------------------------------- single terms

def top_terms(used: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` terms of every group that are more frequent there than in
    the language, by value, then term: lang, source, item, value, rank.

    ``used``: lang, source, term, n, lang_n with n > 0."""
    cells = (used.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("times"))
             .join(groups, ["lang", "source"])
             .withColumn("p", smoothed(F.col("n"), F.col("total"), F.col("terms")))
             .withColumn("q", smoothed(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
             .filter("p > q").select("lang", "source", "n", "lang_n", "times", gap(F.col("p"), F.col("q")).alias("value")))
    cells = stage(cells, "divergence-cells")
    by_value = W.partitionBy("lang", "source").orderBy(F.col("value").desc())
    # the first ranks lie within as many distinct values; each task sends on no more
    first = (cells.groupBy("lang", "source", "value").agg(F.sum("times").alias("times"))
             .withColumn("turn", F.row_number().over(by_value)).filter(F.col("turn") <= top))
    before = F.coalesce(F.sum("times").over(by_value.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    reach = first.withColumn("before", before).filter(F.col("before") < top).select("lang", "source", "value", "before")
    wanted = cells.select("lang", "source", "n", "lang_n", "value").join(reach, ["lang", "source", "value"])
    by_term = W.partitionBy("lang", "source", "value").orderBy("term")
    return (used.join(wanted, ["lang", "source", "n", "lang_n"])
            .withColumn("turn", F.row_number().over(by_term)).filter(F.col("turn") <= top)
            .withColumn("rank", (F.col("before") + F.col("turn")).cast("int")).filter(F.col("rank") <= top)
            .select("lang", "source", F.col("term").alias("item"), "value", "rank"))


# ------------------------------------------------------------ pairs of sources

def _smoothed_counts(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """As :func:`smoothed`; the counts are distinct ones, so few."""
    return np.array([1 + UNIT * (int(c) + 2) // (total + 2 * terms) for c in counts], np.int64)


def pair_sums(key: tuple, terms: pd.DataFrame, groups: pd.DataFrame, width: int = STRIPE) -> pd.DataFrame:
    """One block of terms of one language: for every source of the stripe and
    every later one the sum of the values, cell by cell. A cell is a pair of
    counts; its value is worked out once and taken as often as it occurs."""
    lang, _, stripe = key
    groups = groups.sort_values("place")
    n_groups, n_terms = len(groups), len(terms)
    counts = np.zeros((n_groups, n_terms), np.int64)
    for column, (places, ns) in enumerate(zip(terms["places"], terms["counts"])):
        counts[np.asarray(places) - 1, column] = ns
    # per source: each term's number among the distinct counts, and p of each of these
    cells = []
    for row, total, v in zip(counts, groups["total"], groups["terms"]):
        distinct, number = np.unique(row, return_inverse=True)
        cells.append((number, _smoothed_counts(distinct, int(total), int(v))))
    left, right, values = [], [], []
    for a in range(int(stripe) * width, min((int(stripe) + 1) * width, n_groups)):
        number, p_of = cells[a]
        for b in range(a + 1, n_groups):
            other, q_of = cells[b]
            pair, times = np.unique(number * len(q_of) + other, return_counts=True)
            first, second = np.divmod(pair, max(len(q_of), 1))
            p, q = p_of[first], q_of[second]
            left.append(a + 1)
            right.append(b + 1)
            values.append(int(((p - q) ** 2 // (p + q) * times).sum()))
    return pd.DataFrame({"lang": np.array([lang] * len(left), object), "a": np.array(left, np.int32), "b": np.array(right, np.int32),
                         "value": np.array(values, np.int64)})


def source_gaps(used: DataFrame, groups: DataFrame, width: int = STRIPE) -> DataFrame:
    """Every ordered pair of sources of a language with the sum over its kept
    terms, ranked: lang, source, item, value, rank.

    Terms are dealt into blocks of about ``BLOCK_CELLS`` counts by their hash;
    a task holds one block for one stripe of sources. Every block also gets
    its language's groups, as absent terms count as well; a language without
    kept terms has one empty block, so that its pairs come out with 0.
    """
    n_sources = F.count("*").over(W.partitionBy("lang"))
    sized = groups.withColumn("sources", n_sources).withColumn(
        "blocks", F.ceil((F.col("terms") * F.col("sources") + 1) / F.lit(BLOCK_CELLS))).withColumn(
        "stripes", F.ceil(F.col("sources") / F.lit(width)))
    sized = sized.filter("sources > 1")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    stripes = F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1))
    right = (sized.select("lang", "place", "total", "terms", "stripes", blocks.alias("block"))
             .select("lang", "block", stripes.alias("stripe"), "place", "total", "terms"))
    vectors = (used.join(sized.select("lang", "source", "place", "blocks", "stripes"), ["lang", "source"])
               .groupBy("lang", "term", "blocks", "stripes").agg(F.collect_list(F.struct("place", "n")).alias("at"))
               .select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), stripes.alias("stripe"),
                       F.col("at.place").alias("places"), F.col("at.n").alias("counts")))
    key = ("lang", "block", "stripe")
    sums = (vectors.groupBy(*key).cogroup(right.groupBy(*key))
            .applyInPandas(lambda key, terms, places: pair_sums(key, terms, places, width), "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("of"), F.col("b").alias("to")),
                                                 F.struct(F.col("b").alias("of"), F.col("a").alias("to")))).alias("e"), "value")
    names = groups.select("lang", "source", "place")
    named = (both.select("lang", "e.of", "e.to", "value")
             .join(names.withColumnRenamed("place", "of"), ["lang", "of"])
             .join(names.select("lang", F.col("source").alias("item"), F.col("place").alias("to")), ["lang", "to"]))
    by_value = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return named.select("lang", "source", "item", "value", F.row_number().over(by_value).alias("rank"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank for all groups (lang, source) of
    ``docs`` (columns text, lang, source; others are ignored): parts ``pair``
    (all other sources of the language) and ``term`` (the first ``top`` kept
    terms that are over-represented in the group).

    Null text, lang and source are ''. Repeated rows are documents of their
    own. A language without kept terms has pairs of value 0 and no terms; one
    with a single source has no pairs. No rows in, none out.
    """
    counts = stage(term_counts(docs), "divergence-counts")
    kept = stage(kept_terms(counts, min_docs), "divergence-kept")
    used = stage(counts.filter("term is not null").join(kept, ["lang", "term"])
                 .select("lang", "source", "term", "n", "lang_n"), "divergence-used")
    groups = stage(group_sizes(counts, kept, used), "divergence-groups")
    pairs = source_gaps(used, groups).withColumn("part", F.lit("pair"))
    terms = top_terms(used, groups, top).withColumn("part", F.lit("term"))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.select(*columns).unionByName(terms.select(*columns))
