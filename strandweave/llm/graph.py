"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut, sorted_side


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """vertex, label: every vertex that has an edge, and the least vertex that it can reach.

    Each round every vertex hooks to its least neighbour and the edges are
    drawn anew between the hooks, without loops and repeats. Labels should
    be in random order (hashes, say): then a constant share of the vertices
    goes in every round. Loops and nulls in `edges` are ignored; an empty
    table gives an empty one. Nothing but row counts reaches the driver.
    """
    rest = cut(_tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    rounds = []
    while not rest.isEmpty():
        ends = rest.select("u", "v").unionByName(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = ends.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("hook"))
        hooks = _further(_further(near))
        hooks = cut(hooks)
        rounds.append(hooks)
        moved = rest.join(sorted_side(hooks), "u").select(F.col("hook").alias("a"), "v").join(sorted_side(hooks.select(F.col("u").alias("v"), "hook")), "v").select(F.col("a").alias("u"), F.col("hook").alias("v"))
        rest = cut(_tidy(moved))
    if not rounds:
        return rest.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    labels = rounds[0].select(F.col("u").alias("vertex"), F.col("hook").alias("label"))
    for hooks in rounds[1:]:
        labels = labels.join(sorted_side(hooks.select(F.col("u").alias("label"), "hook")), "label", "left").select("vertex", F.coalesce("hook", "label").alias("label"))
    return cut(labels)


def _further(hooks: DataFrame) -> DataFrame:
    """Hooks of hooks."""
    next_ = hooks.select(F.col("u").alias("hook"), F.col("hook").alias("far"))
    return hooks.join(sorted_side(next_), "hook", "left").select("u", F.coalesce("far", "hook").alias("hook"))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
