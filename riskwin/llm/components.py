"""Connected components of an undirected graph held as a table of edges.

Contraction: every node points to its smallest neighbour (or itself), the
pointers are followed to their ends by doubling, and both ends of every edge
are replaced by where they lead. Edges inside one tree vanish; the rounds end
when no edge is left. Edges, pointers and labels stay distributed; the driver
sees counts only. Every round is cut off with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.session import checkpoint_root


def _follow(pointers: DataFrame, small=lambda df: df) -> DataFrame:
    """Pointers (node, to) with every ``to`` replaced by the end of its path."""
    while True:
        ahead = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
        stepped = (
            pointers.join(small(ahead), "to")
            .select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved"))
            .checkpoint()
        )
        pointers = stepped.select("node", "to")
        if stepped.filter("moved").isEmpty():
            return pointers


def connected_components(edges: DataFrame, broadcast_rows: int = 0) -> DataFrame:
    """Smallest node of its component for every node that has an edge.

    ``edges``: columns ``a`` and ``b`` (long, no nulls, any order, repeats and
    loops allowed). Returns ``node``, ``root``; an empty table gives no rows.
    Rounds with at most ``broadcast_rows`` edges broadcast their pointers (at most
    two an edge) instead of dealing both sides of a join out.
    """
    checkpoint_root(edges.sparkSession)
    edges = (
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct().checkpoint()
    )
    labels = None
    while not edges.isEmpty():
        small = F.broadcast if broadcast_rows and edges.count() <= broadcast_rows else lambda df: df
        ends = edges.select(F.inline(F.array(
            F.struct(F.col("a").alias("node"), F.col("b").alias("near")),
            F.struct(F.col("b").alias("node"), F.col("a").alias("near")))))
        pointers = _follow(
            ends.groupBy("node").agg(F.min("near").alias("near"))
            .select("node", F.least("node", "near").alias("to")).checkpoint(),
            small,
        )
        if labels is None:
            labels = pointers.withColumnRenamed("to", "root")
        else:
            moved = pointers.select(F.col("node").alias("root"), "to")
            labels = (
                labels.join(small(moved), "root", "left")
                .select("node", F.coalesce("to", "root").alias("root")).checkpoint()
            )
        for end in ("a", "b"):
            edges = (
                edges.join(small(pointers.withColumnRenamed("node", end)), end)
                .drop(end).withColumnRenamed("to", end)
            )
        edges = (
            edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct().checkpoint()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
