"""Connected components of an edge table, by contraction.

In every round each node takes the neighbour of least hash below its own as
its target, and the edges are drawn again between the targets, so that only
edges between different targets are left. Rounds go on until no edge is left;
targets are then followed back from the last round to the first. The order is
the bijective hash of the node number, so chains of rising numbers shrink like
any others, and a star is gone after two rounds.

A node with many edges is a hot key of the two joins of a round. Both sides
of these joins are stored tables, so adaptive execution broadcasts the side
of targets where its files are small and splits hot partitions where not; the
least neighbour is an aggregate with partial results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _contract(edges: DataFrame) -> list[DataFrame]:
    """The tables (u, m) of the rounds: node and target, where they differ."""
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min_by("v", F.xxhash64("v")).alias("m"))
        hooks = stored(least.where(F.xxhash64("m") < F.xxhash64("u")), "targets")
        rounds.append(hooks)
        u = edges.join(hooks, "u", "left").select(F.coalesce("m", "u").alias("a"), "v")
        ends = u.join(hooks.withColumnRenamed("u", "v"), "v", "left").select("a", F.coalesce("m", "v").alias("b"))
        edges = stored(ends.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "edges")
    return rounds


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) of every node of the edges (a, b) except the roots: nodes
    are connected if and only if they have (or are) the same root. None where
    no two different nodes are joined."""
    first = (edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    rounds = _contract(stored(first, "edges"))
    if not rounds:
        return None
    out = rounds[-1].select(F.col("u").alias("node"), F.col("m").alias("root"))
    for hooks in reversed(rounds[:-1]):
        last = out.select(F.col("node").alias("m"), "root")
        through = hooks.join(last, "m", "left").select(F.col("u").alias("node"), F.coalesce("root", "m").alias("root"))
        out = through.union(out).distinct()
    return stored(out, "roots")


def least_members(edges: DataFrame) -> DataFrame | None:
    """(node, least) of every node of the edges (a, b): the least node of its
    component; None where no two different nodes are joined."""
    roots = components(edges)
    if roots is None:
        return None
    least = stored(roots.groupBy("root").agg(F.least(F.min("node"), F.col("root")).alias("least")), "least")
    return (roots.join(least, "root").select("node", "least")
            .union(least.select(F.col("root").alias("node"), "least")))
