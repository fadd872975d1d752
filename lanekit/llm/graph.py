"""Connected components of an edge list, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def _with_smallest(edges: DataFrame) -> DataFrame:
    """(node, near) -> adds ``least``, the smallest of the node's neighbours
    and itself. Partial aggregation first, so a hub is one row per task."""
    least = edges.groupBy("node").agg(F.min("near").alias("m")).select(
        "node", F.least("node", "m").alias("least"))
    return edges.join(least, "node")


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): the smallest node reachable, for
    every node that has an edge.

    Alternates the large-star and small-star steps: every node hands its
    larger (then its smaller) neighbours to the smallest one it knows, until
    the edges are stars. Each round's edges are written once to the shared
    folder, which also cuts the lineage. Edges never outnumber the input's;
    null ends and loops are ignored.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("child"),
                                                F.least("a", "b").alias("parent")).distinct(), "cc")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("child").alias("node"), F.col("parent").alias("near")).union(
            edges.select(F.col("parent").alias("node"), F.col("child").alias("near")))
        large = (_with_smallest(both).filter("near > node")
                 .select(F.col("near").alias("node"), F.col("least").alias("near")).distinct())
        small = _with_smallest(large)
        edges = stage(small.select(F.explode(F.array(
            F.struct(F.col("near").alias("child"), F.col("least").alias("parent")),
            F.struct(F.col("node").alias("child"), F.col("least").alias("parent")))).alias("e"))
            .select("e.child", "e.parent").filter("child <> parent").distinct(), "cc")
        state, last = _state(edges), state
        if state == last:
            break
    roots = edges.select(F.col("child").alias("node"), F.col("parent").alias("root"))
    return roots.union(edges.select("parent", "parent").distinct())
