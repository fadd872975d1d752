"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector, padded with zeros to the length of the code, is turned by one
random rotation, and the signs of its coordinates are packed into bits. With the vector's norm and the alignment of
the rotated unit vector with its own sign vector as correction scalars, the
sign code gives an unbiased estimate of the inner product with a query, and
the alignment bounds the estimate's error: what the code misses is orthogonal
to it, and a random rotation spreads it evenly over all directions, so the
error in units of ``1 / sqrt(bits - 1)`` is about standard normal and exceeds
``ERROR_UNITS`` in one of some ten thousand cases. Codes have a multiple of
``dims`` bits, ``CODE_BITS`` at least: the bounds of a code of 64 bits hardly
tell vectors of 64 numbers apart. Vectors whose upper bound does not reach the ``k``-th best lower bound are out; the
others are reranked on the original vectors in double precision.

The query set grows with the table, so it is dealt in blocks, and the table in
chunks. Each block meets each chunk once; a task works through its share of the
chunks and keeps at most ``k`` vectors per query, so what is left to merge does
not grow with the number of chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lanekit.llm.common import shuffle_tasks, stage

K = 20
ERROR_UNITS = 4.0
CODE_BITS = 512
CHUNK_ROWS = 1024
QUERY_ROWS = 2048
SHARE_CHUNKS = 8
SEED = 7


def code_length(dims: int, least: int = CODE_BITS) -> int:
    """The smallest multiple of ``dims`` that is ``least`` or more."""
    return dims * max(1, -(-least // dims))


def rotation(dims: int, seed: int = SEED, bits: int | None = None) -> np.ndarray:
    """The first ``dims`` columns of a random orthogonal matrix of ``bits``
    (``dims``, if none are given) rows: what it does to vectors that are
    padded with zeros."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits or dims, dims)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed sign bits, norm, alignment) of each row."""
    turned = vectors @ turn.T
    norm = np.linalg.norm(vectors, axis=1)
    aligned = np.abs(turned).sum(axis=1) / (np.sqrt(turned.shape[1]) * norm)
    return np.packbits(turned > 0, axis=1), norm, aligned


def signs(bits: np.ndarray, length: int) -> np.ndarray:
    """+-1 per coordinate from packed bits."""
    return np.unpackbits(bits, axis=1, count=length).astype(np.float32) * 2 - 1


def estimates(turned: np.ndarray, size: np.ndarray, bits: np.ndarray, norm: np.ndarray, aligned: np.ndarray,
              units: float = ERROR_UNITS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) of rotated queries of
    norms ``size`` and the half-width of their error bounds."""
    length = turned.shape[1]
    scale = (norm / (aligned * np.sqrt(length))).astype(np.float32)
    found = turned.astype(np.float32) @ (signs(bits, length) * scale[:, None]).T
    miss = norm * np.sqrt(np.maximum(1 - aligned ** 2, 0)) / aligned * (units / np.sqrt(max(length - 1, 1)))
    # a slack for the single precision of the estimate itself
    return found, np.outer(size.astype(np.float32), (miss + 1e-5 * norm).astype(np.float32))


class Block:
    """A block of queries and the best vectors found for them so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, k: int = K):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.turned, self.size = vectors @ turn.T, np.linalg.norm(vectors, axis=1)
        self.row, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def least(self) -> np.ndarray:
        """The k-th best score of each query so far; minus infinity with fewer."""
        out = np.full(len(self.ids), -np.inf)
        count = np.bincount(self.row, minlength=len(self.ids))
        full = count == self.k
        out[full] = self.score[np.cumsum(count)[full] - 1]
        return out

    def meet(self, ids: np.ndarray, vectors: np.ndarray, bits: np.ndarray, norm: np.ndarray, aligned: np.ndarray,
             units: float = ERROR_UNITS) -> None:
        """Takes in a chunk: only vectors whose upper bound reaches the k-th
        best score, or the k-th best lower bound, are reranked."""
        guess, width = estimates(self.turned, self.size, bits, norm, aligned, units)
        least, k = self.least(), self.k
        fresh = np.flatnonzero(least == -np.inf)
        if len(fresh) and len(ids) > k + 1:            # one more: a query's own row does not count
            least[fresh] = np.partition(guess[fresh] - width[fresh], -k - 1, axis=1)[:, -k - 1]
        guess += width
        row, col = np.nonzero(guess >= np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None])
        other = self.ids[row] != ids[col]
        row, col = row[other], col[other]
        if not len(row):
            return
        score = np.concatenate([np.einsum("ij,ij->i", self.vectors[row[i:i + 65_536]], vectors[col[i:i + 65_536]])
                                for i in range(0, len(row), 65_536)])
        row, found, score = (np.concatenate(x) for x in ((self.row, row), (self.found, ids[col]), (self.score, score)))
        order = np.lexsort((found, -score, row))
        row, found, score = row[order], found[order], score[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row, "left") < k
        self.row, self.found, self.score = row[kept], found[kept], score[kept]


# ------------------------------------------------------------------ operator

def usable(vector: Column) -> Column:
    """Neither null nor zero, no null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _narrow(rows: np.ndarray) -> np.ndarray:
    """In single precision where that loses nothing."""
    single = rows.astype(np.float32)
    return single if (single == rows).all() else rows.astype(np.float64)


def index(vectors: DataFrame, dims: int, chunk_rows: int = CHUNK_ROWS, seed: int = SEED) -> DataFrame:
    """(ids, vectors, bits, norm, aligned), one row per chunk of ``vectors``
    (vec_id, vector as array<double> of ``dims`` numbers): the table packed
    with its codes. Every row is indexed; nothing is fitted."""

    def run(batches):
        turn = rotation(dims, seed, code_length(dims))
        for b in batches:
            for i in range(0, b.num_rows, chunk_rows):
                part = b.slice(i, chunk_rows)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                rows = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                bits, norm, aligned = encode(rows, turn)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in (ids, _narrow(rows), bits, norm, aligned)],
                    ["ids", "vectors", "bits", "norm", "aligned"])

    return vectors.select("vec_id", "vector").mapInArrow(
        run, "ids binary, vectors binary, bits binary, norm binary, aligned binary")


def nearest(vectors: DataFrame, queries: DataFrame, dims: int, k: int = K, units: float = ERROR_UNITS,
            query_rows: int = QUERY_ROWS, chunk_rows: int = CHUNK_ROWS, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` vectors of ``vectors`` with
    the largest inner product per row of ``queries``, without the query's own
    id; ties go to the smaller id. Both have vec_id and vector."""
    chunks = stage(index(vectors, dims, chunk_rows, seed), "ann-index")
    blocks = max(1, -(-queries.count() // query_rows))
    dealt = queries.select(F.col("vec_id").alias("q"), "vector",
                           F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks).cast("long")).alias("block"))
    # a block holds about query_rows queries: one row
    packed = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("q", "vector"))).alias("queries"))
    # every block meets every chunk once; a block is dealt to several tasks, each
    # of which meets SHARE_CHUNKS full chunks or as many rows in smaller ones, so
    # that what is left to merge depends on the rows alone
    n_rows = chunks.agg(F.sum(F.length("ids"))).first()[0] or 0
    n_shares = max(1, -(-n_rows // (8 * chunk_rows * SHARE_CHUNKS)))
    tasks, shares = max(shuffle_tasks(chunks.sparkSession), blocks * n_shares), F.lit(n_shares).cast("long")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    # a block goes to a task once, before the chunks that it meets there
    met = (chunks.withColumn("share", F.pmod(F.xxhash64("ids"), shares)).withColumn("block", each(F.lit(blocks).cast("long")))
           .unionByName(packed.withColumn("share", each(shares)), allowMissingColumns=True)
           .repartition(tasks, "block", "share").sortWithinPartitions("block", "share", F.col("queries").isNull())
           .select("block", "queries", "ids", "vectors", "bits", "norm", "aligned"))

    def run(batches):
        def best(block):
            return pa.RecordBatch.from_arrays([pa.array(block.ids[block.row], pa.int64()), pa.array(block.found, pa.int64()),
                                               pa.array(block.score, pa.float64())], ["query_id", "vec_id", "score"])

        turn, number, block = rotation(dims, seed, code_length(dims)), None, None
        for b in batches:
            for at, queries, *packed in zip(*b.columns):
                if queries.is_valid:
                    if block:
                        yield best(block)
                    number = at.as_py()
                    block = Block(queries.values.field("q").to_numpy(zero_copy_only=False),
                                  queries.values.field("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), turn, k)
                if queries.is_valid or at.as_py() != number:              # a block without queries meets nothing
                    continue
                ids, bits, norm, aligned = (np.frombuffer(packed[i].as_buffer(), kind) for i, kind in (
                    (0, np.int64), (2, np.uint8), (3, np.float64), (4, np.float64)))
                n, raw = len(ids), packed[1].as_buffer()
                rows = np.frombuffer(raw, np.float32 if raw.size == 4 * n * dims else np.float64)
                block.meet(ids, rows.reshape(n, dims).astype(np.float64), bits.reshape(n, -1), norm, aligned, units)
        if block:
            yield best(block)

    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_in_table(table: DataFrame, every: int = 20, k: int = K, **settings) -> DataFrame:
    """Searches ``table`` (vec_id, embedding) for the rows whose id is
    divisible by ``every``.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without an id; vectors of another length than the most
    frequent one (ties: the longer) are no candidates of any inner product and
    are left out too. Rows that repeat an id count once per distinct vector.
    Fewer than ``k`` candidates: all of them. No usable rows: no result.
    """
    rows = (table.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
            .select("vec_id", F.col("embedding").cast("array<double>").alias("vector")))
    sizes = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = sizes[0]["dims"] if sizes else 1
    rows = rows.filter(F.size("vector") == dims).dropDuplicates(["vec_id", "vector"])
    return nearest(rows, rows.filter(F.col("vec_id") % every == 0), dims, k, **settings)
