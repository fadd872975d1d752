"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64 bits. Their lower 46 are two blocks of 23; in each the
words of the perfect binary Golay code serve as anchor points: every 23-bit
value lies within 3 bits of exactly one of them (the covering radius). A
fingerprint's *home* is its nearest anchor in both blocks, and it is
replicated to every anchor that lies within covering radius plus threshold.
If two fingerprints differ in at most ``t`` bits, ``t1`` of them in the first
block and ``t2`` in the second, the second one lies within ``3 + t1`` and
``3 + t2`` of the first one's home, so both meet there. With ``t`` = 2 that is
61 anchors of 2**24 on average, and comparisons happen per anchor only.

Equal fingerprints are one row from the start, so copies cost nothing. At an
anchor only home rows are compared with the rest; an anchor that is home to
very many fingerprints is split into salted parts, each with some of the home
rows and all of the others. A task reports a spanning forest of the links it
finds, never all pairs.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import fresh, stage
from lanekit.llm.graph import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42

#: Length, redundancy, covering radius and generator polynomial
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code.
GOLAY_BITS, GOLAY_CHECK, GOLAY_RADIUS, GOLAY_POLYNOMIAL = 23, 11, 3, 0xC75

HOMES_PER_PART = 4096
ROWS_PER_CHUNK = 200_000
PAIRS_PER_STEP = 2_000_000


# ------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the UTF-8 bytes of a whole text: A-Z in lower
    case, majority of the XXH64 values of all word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    cuts = zip(starts[:n].tolist(), ends[len(words) - n:].tolist())
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in cuts])
    ones = np.zeros(64, np.int64)
    values = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(values[i:i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, uid, fp) for every row; ``uid`` is a hash of its text."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], pa.int64())],
                ["doc_id", "uid", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("uid"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, uid bigint, fp bigint"))


# ------------------------------------------------------------------ anchors

def _remainder(v: np.ndarray) -> np.ndarray:
    """Syndromes of 23-bit values."""
    v = v.copy()
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        v ^= np.where((v >> bit) & 1, GOLAY_POLYNOMIAL << (bit - GOLAY_CHECK), 0)
    return v


@cache
def _errors(max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All error patterns of up to radius + ``max_bits`` bits, by syndrome and
    then by excess over the radius: (patterns, excess, first, upto), where a
    syndrome ``s`` with budget ``e`` owns patterns first[s] : + upto[s, e]."""
    pattern = np.array([sum(1 << b for b in c) for k in range(GOLAY_RADIUS + max_bits + 1)
                        for c in combinations(range(GOLAY_BITS), k)], np.int64)
    excess = np.maximum(0, np.bitwise_count(pattern).astype(np.int64) - GOLAY_RADIUS)
    syndrome = _remainder(pattern)
    order = np.lexsort((pattern, excess, syndrome))
    pattern, excess, syndrome = pattern[order], excess[order], syndrome[order]
    size = 1 << GOLAY_CHECK
    upto = np.stack([np.bincount(syndrome[excess <= e], minlength=size) for e in range(max_bits + 1)], axis=1)
    return pattern, excess, np.searchsorted(syndrome, np.arange(size)), upto


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of ``count[i]`` consecutive positions from ``first[i]``."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]


def anchors(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, anchor, is_home) of every anchor each fingerprint goes to."""
    pattern, excess, first, upto = _errors(max_bits)
    mask = (1 << GOLAY_BITS) - 1
    low, high = fp & mask, (fp >> GOLAY_BITS) & mask
    s_low, s_high = _remainder(low), _remainder(high)
    owner, at = _spread(first[s_low], upto[s_low, max_bits])
    spent = excess[at]
    word = low[owner] ^ pattern[at]
    step, at = _spread(first[s_high[owner]], upto[s_high[owner], max_bits - spent])
    owner_of = owner[step]
    return (owner_of, (word[step] << GOLAY_BITS) | (high[owner_of] ^ pattern[at]),
            (spent[step] == 0) & (excess[at] == 0))


def _homes(prints: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            _, anchor, _ = anchors(b.column(0).to_numpy(zero_copy_only=False), 0)
            yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])

    return prints.select("fp").mapInArrow(run, "anchor bigint")


def _replicas(prints: DataFrame, max_bits: int) -> DataFrame:
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 4096):
                part = fp[i:i + 4096]
                owner, anchor, home = anchors(part, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(part[owner]), pa.array(home)], ["anchor", "fp", "home"])

    return prints.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")


# -------------------------------------------------------------------- links

def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of a[i] and b[i]; labels become smallest members."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label[:] = nxt


def forest(part: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between home rows and the other rows of
    the same part; ``part`` is sorted."""
    node, index = np.unique(fp, return_inverse=True)
    label = np.arange(len(node))
    begin = np.searchsorted(part, part, "left")
    size = np.searchsorted(part, part, "right") - begin
    rows = np.flatnonzero(home & (size > 1))
    ends = np.cumsum(size[rows])
    at = 0
    while at < len(rows):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS_PER_STEP, "right")))
        own = rows[at:to]
        owner, other = _spread(begin[own], size[own])
        a, b = index[own][owner], index[other]
        near = np.bitwise_count(node[a] ^ node[b]) <= max_bits
        _merge(label, a[near], b[near])
        at = to
    child = np.flatnonzero(label != np.arange(len(node)))
    return node[child], node[label[child]]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges that connect the distinct fingerprints ``prints`` (fp)
    exactly as all pairs at ``max_bits`` or fewer differing bits would."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the anchors are made for 0 to 3 differing bits")
    homes = _homes(prints).groupBy("anchor").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / HOMES_PER_PART).cast("int")
    # the planner takes the replicas for as many rows as there are prints, and
    # would broadcast them where the homes are known to be more than that
    met = (_replicas(prints, max_bits).join(homes.hint("merge"), "anchor")
           .withColumn("parts", parts)
           .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .withColumn("home", F.col("home") & (F.pmod(F.xxhash64("fp"), F.col("parts")) == F.col("part")))
           .select(F.xxhash64("anchor", "part").alias("part"), "fp", "home")
           .repartition("part").sortWithinPartitions("part"))

    def run(batches):
        def solve(rows):
            part, fp, home = (np.concatenate(c) for c in zip(*rows))
            a, b = forest(part, fp, home, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held, n = [], 0
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            n += batch.num_rows
            if n >= ROWS_PER_CHUNK and held[0][0][0] != held[-1][0][-1]:
                part, fp, home = (np.concatenate(c) for c in zip(*held))
                cut = int(np.searchsorted(part, part[-1], "left"))
                yield solve([(part[:cut], fp[:cut], home[:cut])])
                held, n = [(part[cut:], fp[cut:], home[cut:])], len(part) - cut
        if n:
            yield solve(held)

    return met.mapInArrow(run, "a bigint, b bigint")


# ----------------------------------------------------------------- operator

def _grouped(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, uid, fp, root, component_id) for every row; ``root`` is the
    smallest fingerprint of its component."""
    prints = stage(fingerprints(docs, shingle), "simhash-prints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    linked = stage(distinct.join(roots, "fp"), "simhash-linked")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = linked.join(smallest, "root").select("fp", "root", "component_id")
    classes = (distinct.join(of_linked, "fp", "left")
               .select("fp", F.coalesce("root", "fp").alias("root"),
                       F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id"))
                       .alias("component_id")))
    return prints.join(classes, "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of ``docs`` (columns
    doc_id, text; others are ignored).

    ``component_id`` is the smallest doc_id among all documents reachable by
    links of ``max_bits`` or fewer differing fingerprint bits, the document
    included. Null, empty and wordless texts have fingerprint zero and link
    like any other; texts shorter than a shingle hash their whole word
    sequence. Rows that repeat an id are rows of their own (same result for
    equal texts). A null id never is a component's id unless all are null.
    """
    return _grouped(docs, shingle, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per group, with all its columns: the one of the
    smallest id (a null id only if there is no other), of rows that share it
    the one whose text has the smallest hash, and of equal rows any one.
    Texts move only if the list of survivors is too large for the planner to
    broadcast."""
    same = _grouped(docs, shingle, max_bits).groupBy("root", "doc_id", "uid").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "n")).alias("first")
    id_, uid, n = fresh("id"), fresh("uid"), fresh("n")
    keep = stage(same.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias(id_), F.col("first.uid").alias(uid), F.col("first.n").alias(n)), "simhash-keep")
    match = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(uid))
    once = docs.join(keep.filter(F.col(n) == 1), match, "left_semi")
    repeated = docs.join(keep.filter(F.col(n) > 1), match)
    return once.unionByName(repeated.dropDuplicates([id_, uid]).select(*[docs[c] for c in docs.columns]))
