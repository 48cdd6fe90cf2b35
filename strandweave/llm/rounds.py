"""Linking the members of buckets without drawing all pairs of a large one.

A bucket (a band of a signature, a shared anchor) names members that may
be alike. In a round, a small bucket has all pairs between its components
drawn. A larger one has its best connected member compared with all others,
so a group of copies costs one comparison a member. What joins a component needs
no comparison inside it any more, and buckets with one component are done.
What is still apart after a few such rounds is handed back, or drawn whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, sorted_side
from .graph import components

#: A bucket of at most so many members has its pairs drawn at once: 4 to a member.
SMALL = 9


def link(members: DataFrame, labels: DataFrame, verify: Callable[[DataFrame], DataFrame], may: Callable[[str, str], Column], rounds: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """(labels, rest) after some rounds of comparisons.

    members: bucket, v (a vertex), deg (how connected it is), m (a struct).
    labels: v and comp, the least vertex that it is known to reach; every
    vertex of members has a row. may(ma, mb) says whether two members'
    structs allow a link. verify gets distinct candidates a, b (a < b) and
    returns the linked pairs of vertices a, b. rest: the members of buckets
    that still hold several components and were larger than SMALL. With
    `whole` the last round draws their pairs instead, and rest is empty.
    """
    rest = members
    for k in range(rounds):
        rest = _apart(rest, labels)
        if rest.isEmpty():
            break
        last = whole and k == rounds - 1
        new = cut(_tried(rest, may, last))
        linked = verify(new).select("a", "b").distinct()
        labels = _joined(labels, linked)
        rest = rest.limit(0) if last else rest.where(F.col("held") > SMALL)
        rest = rest.select("bucket", "v", "deg", "m")
        if last:
            break
    return labels, rest


def apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components: bucket, v, deg, m, comp, held."""
    return _apart(members, labels)


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    told = members.select("bucket", "v", "deg", "m").join(sorted_side(labels), "v")
    mixed = told.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return cut(told.join(sorted_side(mixed.where("low <> high").select("bucket", "held")), "bucket"))


def _tried(members: DataFrame, may: Callable[[str, str], Column], last: bool) -> DataFrame:
    """a, b: the pairs of a round, each once."""
    one = members if last else members.where(F.col("held") <= SMALL)
    ends = one.select("bucket", F.col("v").alias("a"), F.col("comp").alias("ca"), F.col("m").alias("ma"))
    others = one.select("bucket", F.col("v").alias("b"), F.col("comp").alias("cb"), F.col("m").alias("mb"))
    drawn = ends.join(sorted_side(others), "bucket").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & may("ma", "mb")).select("a", "b")
    if last:
        return drawn.distinct()
    many = members.where(F.col("held") > SMALL)
    tops = many.groupBy("bucket").agg(F.max(F.struct("deg", "v", "comp", "m")).alias("top"))
    led = many.join(sorted_side(tops), "bucket").where((F.col("comp") != F.col("top.comp")) & may("m", "top.m"))
    led = led.select(F.least("v", "top.v").alias("a"), F.greatest("v", "top.v").alias("b"))
    return drawn.unionByName(led).distinct()


def _joined(labels: DataFrame, linked: DataFrame) -> DataFrame:
    """labels after the links: only the components that they touch are named anew."""
    ends = cut(linked)
    for end in ("a", "b"):
        ends = ends.join(sorted_side(labels.select(F.col("v").alias(end), F.col("comp").alias(f"c{end}"))), end)
    moved = components(ends.select("ca", "cb"), "ca", "cb").where("vertex <> label").select(F.col("vertex").alias("comp"), "label")
    return cut(labels.join(sorted_side(moved), "comp", "left").select("v", F.coalesce("label", "comp").alias("comp")))
