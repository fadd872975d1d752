"""Conversation prefix trie with totals, by the van Emde Boas recursion.

A conversation is a sequence of turns; a node of the trie is a distinct prefix.
The sequences are cut at half their (padded) depth: the upper halves are a
trie of their own, and the lower halves that hang below the same upper half,
the same *cut prefix*, are another one, rooted in that prefix. Giving every cut
prefix a name makes both independent, so all tries of one height are cut in
one go, down to height 1, where a conversation's slot holds the name of the
prefix before it and its own turn. That is one round per halving, however deep
the conversations are, and no task ever holds a conversation, a prefix's
members or a subtree.

Names are SHA-256 digests: of a turn, of two adjoining runs of turns, of a
forest's name and the run that is cut off below it. Equal prefixes get equal
names without being brought together, so a prefix that all conversations share
is no hot key. Rows meet by (conversation, place), counts by partial
aggregation.

Subtree totals go the other way: tries of height 1 know theirs; to join an
upper trie with its lower forests, a forest's total is grafted onto the node
that it is rooted in and onto that node's ancestors in the upper trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import n_words, stage
from lanekit.operators.windows import rank_rows

ROOT = b"\x00" * 32
#: conv_id's group is conv_id - conv_id % GROUP; the first h turns come from
#: there, h = crc32(conv_id) % HEADS.
GROUP, HEADS = 20, 4
#: Characters of an id list that travel in one row.
LIST_CHARS = 1 << 16
#: Conversations above this many turns are numbered by several tasks.
HOT_TURNS = 200_000


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turn_code(role: Column, text: Column) -> Column:
    """A digest of role and text; the role's length keeps them apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, code, words): the turns of ``turns`` (conv_id, turn, role,
    text) in their order, from 1. Null turns come first, equal ones in the
    order of their digest; rows without conv_id are left out."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), "turn", turn_code(F.col("role"), F.col("text")).alias("code"),
                        n_words(F.col("text")).alias("words")).filter("conv is not null")
    ranked = rank_rows(stage(rows, "trie-turns"), ["conv"], ["turn", "code"], "pos", hot_threshold=HOT_TURNS)
    return ranked.select("conv", "pos", "code", "words")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its group's first one."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``own`` (conv, pos, code, words) -> (conversations (conv), rebuilt
    turns (conv, pos, code, words)): the first h turns of the group's first
    conversation, then the own ones after the first h."""
    base = F.col("conv") - F.col("conv") % GROUP
    lengths = own.groupBy("conv").agg(F.max("pos").alias("length"))
    heads = (own.filter((F.col("conv") == base) & (F.col("pos") < HEADS)).groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "code", "words"))).alias("head")))
    convs = stage(lengths.withColumn("base", base).join(heads, "base", "left")
                  .withColumn("h", shared_turns(F.col("conv")))
                  .select("conv", "length", "h", F.coalesce(F.slice("head", 1, F.col("h")), F.array()).alias("head")), "trie-heads")
    taken = convs.select("conv", F.explode("head").alias("t")).select("conv", "t.pos", "t.code", "t.words")
    # the own turns move up where the group's first conversation is too short;
    # only these conversations are looked up
    short = convs.filter((F.size("head") < F.col("h")) & (F.col("length") > F.col("h"))).select(
        "conv", (F.col("h") - F.size("head")).alias("missing"))
    later = (own.filter(F.col("pos") > shared_turns(F.col("conv"))).join(short, "conv", "left")
             .select("conv", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("pos"), "code", "words"))
    return convs.select("conv"), taken.unionByName(later)


# ------------------------------------------------------------------ recursion

def runs_by_height(turns: DataFrame, height: int) -> list[DataFrame]:
    """(conv, run, code) for heights 1, 2, 4 .. up to ``height`` / 2: the runs
    of that many turns that are complete, cut from the start, and the digest
    of each. A run's digest comes from those of its halves."""
    runs = [turns.select("conv", (F.col("pos") - 1).alias("run"), "code")]
    while 1 << len(runs) < height:
        half = (F.col("run") % 2).cast("int")
        joined = (runs[-1].groupBy("conv", F.floor(F.col("run") / 2).cast("int").alias("run"))
                  .agg(F.max(F.when(half == 0, F.col("code"))).alias("a"), F.max(F.when(half == 1, F.col("code"))).alias("b"))
                  .filter("b is not null").select("conv", "run", digest(F.col("a"), F.col("b")).alias("code")))
        runs.append(stage(joined, "trie-runs"))
    return runs


def named_prefixes(convs: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """(conv, depth, name) for every prefix of every conversation, the empty
    and the whole one included: the tries are cut in half until they have
    height 1. A trie's row is a conversation's part in it: (conv, number of
    the part, name of the prefix before it)."""
    parts = convs.select("conv", F.lit(0).alias("part"), F.lit(ROOT).alias("name"))
    for i, halves in enumerate(reversed(runs)):
        upper = halves.filter("run % 2 = 0").select("conv", F.floor(F.col("run") / 2).cast("int").alias("part"), "code")
        cut = parts.join(upper, ["conv", "part"], "left")
        # the upper half keeps its root; the lower one is rooted in the cut prefix
        below = F.when(F.col("code").isNotNull(), F.struct(
            (F.col("part") * 2 + 1).alias("part"), digest(F.col("name"), F.col("code")).alias("name")))
        both = F.array_compact(F.array(F.struct((F.col("part") * 2).alias("part"), "name"), below))
        parts = cut.select("conv", F.explode(both).alias("p")).select("conv", "p.part", "p.name")
        if i % 4 == 3:
            parts = stage(parts, "trie-parts")
    return stage(parts.withColumnRenamed("part", "depth"), "trie-prefixes")


# --------------------------------------------------------------------- nodes

def _chunks(batches: Iterator[pa.RecordBatch], list_chars: int = LIST_CHARS) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv) -> (name, first conv, comma-joined ids)."""
    out: list[tuple] = []
    name, ids, chars = None, [], 0

    def closed():
        if ids:
            out.append((name, ids[0], ",".join(map(str, ids))))

    def sent():
        rows = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                                           pa.array([r[2] for r in out], pa.string())], ["name", "first", "ids"])
        out.clear()
        return rows

    for batch in batches:
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != name or chars > list_chars:
                closed()
                name, ids, chars = node, [], 0
            ids.append(conv)
            chars += 20
        if len(out) > 100:
            yield sent()
    closed()
    yield sent()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, first, ids) -> (name, digest of the joined lists); only
    the running digest is held."""
    name, running = None, None
    for batch in batches:
        names, found = [], []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if node != name:
                if running is not None:
                    names.append(name)
                    found.append(running.hexdigest())
                name, running = node, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], ["name", "ends_sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([running.hexdigest()], pa.string())],
                                         ["name", "ends_sha256"])


def end_lists(ends: DataFrame) -> DataFrame:
    """(name, conv) -> (name, ends_sha256): SHA-256 of the ids in ascending
    order, comma-joined. Ranges of ids are joined in parallel first; a digest
    runs over a node's ids in order, so its last step is one task a node, over
    rows of ``LIST_CHARS`` characters."""
    lists = (ends.select("name", "conv").repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
             .mapInArrow(_chunks, "name binary, first long, ids string"))
    return (lists.repartition("name").sortWithinPartitions("name", "first")
            .mapInArrow(_digests, "name binary, ends_sha256 string"))


def grafted(nodes: DataFrame, prefixes: DataFrame, height: int) -> DataFrame:
    """``nodes`` (name, parent, depth, conv, leaves, saved: own values) with
    leaves and saved summed over subtrees.

    At heights 1, 2, 4 ..: a lower forest's roots are the children of a node
    at the last depth of the upper trie. Their totals are added to that node
    and to its ancestors in the upper trie, which any of its conversations
    names. A node is a cut at one height only, so all rounds together make
    about half as many rows as there are nodes, times the number of rounds.
    """
    totals, h = nodes, 1
    paths = stage(prefixes.join(nodes.select("conv").distinct(), "conv", "left_semi"), "trie-paths")
    while h < height:
        start = F.col("depth") - 1
        lower = totals.filter(start % (2 * h) == h)
        rooted = lower.groupBy(F.col("parent").alias("name")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        above = (rooted.join(totals.select("name", "conv", F.col("depth").alias("cut")), "name")
                 .select("conv", F.explode(F.sequence(F.col("cut") - h + 1, F.col("cut"))).alias("depth"), "leaves", "saved")
                 .join(paths, ["conv", "depth"]).groupBy("name")
                 .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        none = F.lit(0).cast("long")
        totals = stage(totals.join(above, "name", "left").select(
            "name", "parent", "depth", "conv", (F.col("leaves") + F.coalesce("more_leaves", none)).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", none)).alias("saved")), "trie-totals")
        h *= 2
    return totals


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv, pos from 1, code, words) over
    all ``convs`` (conv): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 (see :func:`prefix_trie`)."""
    turns = stage(turns, "trie-rebuilt")
    deepest = turns.agg(F.max("pos")).first()[0] or 0
    height = 1
    while height < deepest + 1:              # a slot more than turns: for the whole prefix
        height *= 2
    prefixes = named_prefixes(convs, runs_by_height(turns, height) if height > 1 else [])
    steps = prefixes.join(turns.select("conv", (F.col("pos") - 1).alias("depth"), "code", "words"), ["conv", "depth"], "left")
    steps = stage(steps, "trie-steps")
    ends = end_lists(steps.filter("code is null"))
    # a node: a prefix and a turn; its name is that of any member's prefix of that depth
    children = (steps.filter("code is not null").groupBy(F.col("name").alias("parent"), "code")
                .agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
                     (F.max("depth") + 1).alias("depth")))
    below = children.join(prefixes, ["conv", "depth"]).select("name", "parent", "depth", "conv", "n_convs", "words")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "conv", "n_convs",
        F.lit(0).cast("long").alias("words"))
    nodes = stage(below.unionByName(root), "trie-nodes")
    n_children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(n_children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    counted = stage(counted, "trie-counted")
    own = counted.select("name", "parent", "depth", "conv", (F.col("n_children") == 0).cast("long").alias("leaves"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    # the root is above all blocks of depths: it takes the sum of its children
    totals = grafted(own, prefixes, height)
    whole = totals.filter("depth <= 1").agg(F.sum("leaves").alias("whole_leaves"), F.sum("saved").alias("whole_saved")) \
        .withColumn("name", F.lit(ROOT))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (counted.join(totals.select("name", "leaves", "saved"), "name").join(whole, "name", "left")
            .join(ends, "name", "left").join(parents, "parent", "left")
            .select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                    "n_children", F.coalesce("whole_leaves", "leaves").alias("n_leaves"),
                    F.coalesce("whole_saved", "saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per distinct prefix of the rebuilt ``conversations`` (columns
    conv_id, turn, role, text; others are ignored): smallest member conv_id,
    depth, parent_conv_id (null for the root), n_convs (members), n_children,
    n_leaves (childless nodes in the subtree, itself included), saved_tokens
    (over the subtree, (members - 1) x words of the node's last text) and
    ends_sha256 (of the ids of members that end here).

    Null role and text are empty; null turns come first, rows of one turn in
    the order of their content's SHA-256, repeated rows are turns of their
    own. ``%`` takes the sign of the id. Rows without conv_id take no part;
    no rows in, none out.
    """
    return trie(*rebuilt(stage(numbered_turns(conversations), "trie-own")))
