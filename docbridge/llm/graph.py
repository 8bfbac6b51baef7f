"""Connected components in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (columns a, b: long); root is the least node of its component.

    Every node hooks onto its least neighbour, parents are replaced by grandparents,
    edges are rewritten to parents and repeated or closed ones dropped, until none is
    left.  With hashed node numbers chains are short and rounds few.  State is cut by
    checkpoints; a node with many edges is only ever counted with partial aggregation
    or met in a sort-merge join whose large keys Spark can split.  Self-loops and repeated
    edges are harmless; no edges give no rows.
    """
    e = checkpoint(_tidy(edges))
    nodes = None
    while not e.isEmpty():
        ends = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = checkpoint(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")))
        above = first.select(F.col("node").alias("up"), F.col("up").alias("above"))
        up = checkpoint(first.join(above.hint("merge"), "up").select("node", F.col("above").alias("up")), first)
        step = up.select(F.col("node").alias("root"), "up")
        if nodes is None:
            nodes = checkpoint(up.select("node", F.col("up").alias("root")))
        else:
            nodes = checkpoint(nodes.join(step.hint("merge"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), nodes)
        rewritten = e
        for end in ("a", "b"):
            rewritten = rewritten.join(up.select(F.col("node").alias(end), "up").hint("merge"), end).drop(end).withColumnRenamed("up", end)
        e = checkpoint(_tidy(rewritten), e, up)
    return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0) if nodes is None else nodes
