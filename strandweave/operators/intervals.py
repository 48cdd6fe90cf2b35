"""Intervals by contig: merging, coverage sweeps, masking, range joins. Half-open, from 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import dealt


def checked(rows: DataFrame, start="start", end="end") -> DataFrame:
    """rows; negative starts and ends before starts raise an error when they are read."""
    bad = (F.col(start) < 0) | (F.col(end) < F.col(start))
    return rows.withColumn(start, F.when(bad, F.raise_error(F.lit("bad interval"))).otherwise(F.col(start)))


#: Positions of a bin. A scan along a contig is a scan of each bin, and one of the short table of bins.
BIN_WIDTH = 1 << 16


def _in_bins(rows: DataFrame, pos: str, bin_width: int) -> DataFrame:
    return rows.withColumn("__at", F.floor(F.col(pos) / bin_width))


#: A key: all its columns in one, so that null keys are keys and equal in a join. A bin: its key and its place along it.
KEY, BIN = ["__key"], ["__key", "__at"]


def _keyed(rows: DataFrame, keys: Sequence[str], *columns: Column | str) -> DataFrame:
    return rows.select(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("__key"), *columns)


def _named(rows: DataFrame, keys: Sequence[str], *columns: Column | str) -> DataFrame:
    return rows.select(*[F.col(f"__key.k{i}").alias(k) for i, k in enumerate(keys)], *columns)


def merge(rows: DataFrame, keys: Sequence[str] = ("contig",), start="start", end="end", length: Column | None = None, bin_width: int = BIN_WIDTH, tasks: int | None = None) -> DataFrame:
    """Sorted, disjoint intervals: overlapping and book-ended ones become one. [s, s) counts as [s - 1, s + 1).

    Two levels: each bin's furthest end is carried to the bins after it, and
    bins are merged by themselves from what they are handed. What continues
    a block of an earlier bin then joins the last block that began before.
    So a contig is as many tasks as it has bins, and no task sorts more than one.
    tasks: of each shuffle (`session.tasks_for`); without a number the session decides.
    """
    empty = F.col(start) == F.col(end)
    wide = _keyed(rows, keys, F.when(empty, F.col(start) - 1).otherwise(F.col(start)).alias(start), F.when(empty, F.col(end) + 1).otherwise(F.col(end)).alias(end), *([length.alias("__length")] if length is not None else []))
    if length is not None:
        wide = wide.withColumn(end, F.least(end, "__length")).drop("__length")
        wide = wide.withColumn(start, F.greatest(F.col(start), F.lit(0))).where(F.col(start) < F.col(end))
    earlier = Window.partitionBy(*KEY).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    # all rows have a bin: a left join keeps them where they lie, also where they are few enough to be broadcast
    # rows of one start meet before the windows: a bin sorts one row a position at most
    wide = dealt(_in_bins(wide, start, bin_width), tasks, *BIN).groupBy(*BIN, start).agg(F.max(end).alias(end))
    bins = dealt(wide.groupBy(*BIN).agg(F.max(end).alias("__end")), tasks, *KEY)
    reached = bins.select(*BIN, F.max("__end").over(earlier).alias("__reach"))
    along = Window.partitionBy(*BIN).orderBy(start)
    own = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    met = wide.join(dealt(reached, tasks, *BIN), BIN, "left").withColumn("__reach", F.greatest("__reach", own))
    marked = met.withColumn("__new", F.when(F.col("__reach").isNull() | (F.col(start) > F.col("__reach")), 1).otherwise(0))
    blocks = marked.withColumn("__block", F.sum("__new").over(along)).groupBy(*BIN, "__block").agg(F.min(start).alias(start), F.max(end).alias(end))
    # block 0 of a bin goes on with the last block that began in an earlier one
    own_block = F.col("__block") > 0
    last = dealt(blocks.groupBy(*BIN).agg(F.max(F.when(own_block, F.col(start))).alias("__last"), F.max(F.when(~own_block, F.col(end))).alias(end)), tasks, *KEY)
    going_on = last.select(*KEY, F.max("__last").over(earlier).alias(start), end).where(F.col(end).isNotNull())
    owned = dealt(blocks.where(own_block).select(*KEY, start, end).unionByName(going_on), tasks, *KEY, start)
    return _named(owned.groupBy(*KEY, start).agg(F.max(end).alias(end)), keys, start, end)


def depth_steps(rows: DataFrame, keys: Sequence[str] = ("contig",), start="start", end="end", bin_width: int = BIN_WIDTH, tasks: int | None = None, caps: DataFrame | None = None) -> DataFrame:
    """keys, pos, next_pos, depth: runs between breakpoints. Events of one position meet before the windows.

    Two levels: the sums of bins are added up along the short table of bins, and each bin
    is swept from the depth it begins with. tasks: of each shuffle, as in `merge`.
    caps: keys and a column cap, one row a key; it meets the table of bins, and keys without a cap are left out.
    """
    ups = _keyed(rows, keys, F.col(start).alias("pos"), F.lit(1).alias("step"))
    downs = _keyed(rows, keys, F.col(end).alias("pos"), F.lit(-1).alias("step"))
    steps = dealt(_in_bins(ups.unionByName(downs), "pos", bin_width), tasks, *BIN).groupBy(*BIN, "pos").agg(F.sum("step").alias("step"))
    order = Window.partitionBy(*KEY).orderBy("__at")
    bins = dealt(steps.groupBy(*BIN).agg(F.sum("step").alias("__step"), F.min("pos").alias("__first")), tasks, *KEY)
    bins = bins.select(*BIN, F.coalesce(F.sum("__step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.lead("__first").over(order).alias("__next"))
    if caps is not None:
        bins = bins.join(dealt(_keyed(caps, keys, "cap"), tasks, *KEY), KEY)
    along = Window.partitionBy(*BIN).orderBy("pos")
    swept = steps.join(dealt(bins, tasks, *BIN), BIN, "left" if caps is None else "inner")
    return _named(swept, keys, "pos", F.coalesce(F.lead("pos").over(along), F.col("__next")).alias("next_pos"), (F.col("__before") + F.sum("step").over(along)).alias("depth"), *(["cap"] if caps is not None else []))


def at_least(rows: DataFrame, cap: Column | DataFrame, keys: Sequence[str] = ("contig",), start="start", end="end", bin_width: int = BIN_WIDTH, tasks: int | None = None) -> DataFrame:
    """Maximal intervals whose depth reaches `cap`: a column of rows that is one value to a key, or a table of keys and cap. Null keys have none."""
    caps = (cap if isinstance(cap, DataFrame) else rows.groupBy(*keys).agg(F.max(cap).alias("cap"))).na.drop(subset=list(keys))
    high = depth_steps(rows, keys, start, end, bin_width, tasks, caps).where((F.col("depth") >= F.col("cap")) & F.col("next_pos").isNotNull())
    return merge(high.select(*keys, F.col("pos").alias(start), F.col("next_pos").alias(end)), keys, start, end, bin_width=bin_width, tasks=tasks)


def covered(start: Column, end: Column, length: Column) -> Column:
    """Bases of [start, end) inside [0, length)."""
    return F.greatest(F.lit(0), F.least(end, length) - F.least(F.greatest(start, F.lit(0)), length))


def depth_cap(mean: Column, min_depth: int = 1) -> Column:
    """mean + 4 sqrt(mean) to 2 places; min_depth + 1 where that is no more than min_depth."""
    cap = F.rint((mean + 4 * F.sqrt(mean)) * 100) / 100
    return F.when(cap <= min_depth, F.lit(float(min_depth + 1))).otherwise(cap)


def slop(rows: DataFrame, by: int, length: str, start="start", end="end") -> DataFrame:
    """Intervals widened on both sides, kept inside [0, length)."""
    return rows.withColumn(start, F.greatest(F.col(start) - by, F.lit(0))).withColumn(end, F.least(F.col(end) + by, F.col(length)))


def binned(rows: DataFrame, bin_width: int, start="start", end="end") -> DataFrame:
    """rows once for each bin they touch (column __bin)."""
    last = F.greatest(F.col(start), F.col(end) - 1)
    return rows.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / bin_width), F.floor(last / bin_width))))


def range_join(points: DataFrame, spans: DataFrame, keys: Sequence[str], pos="pos", start="start", end="end", bin_width: int = 16_384, how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Points with the spans that hold them: an equi-join on keys and position bin, then the exact test.

    how: inner, left_semi or left_anti. A span is in as many bins as it
    touches, and a point in one, so that no pair comes twice. tasks: of the join, as in `merge`.
    """
    left = dealt(points.withColumn("__bin", F.floor(F.col(pos) / bin_width)), tasks, "__bin", *keys)
    right = binned(spans, bin_width, start, end)
    clash = [c for c in right.columns if c in points.columns and c not in keys]
    if clash:
        raise ValueError(f"columns on both sides: {clash}")
    right = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bin").alias("__rbin"), *[c for c in right.columns if c not in keys and c != "__bin"])
    right = dealt(right, tasks, "__rbin", *[f"__k{i}" for i in range(len(keys))])
    on = (F.col("__bin") == F.col("__rbin")) & (F.col(pos) >= F.col(start)) & (F.col(pos) < F.col(end))
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__k{i}"))
    return left.join(right, on, how).drop("__bin", "__rbin", *[f"__k{i}" for i in range(len(keys))])


def unmasked(points: DataFrame, mask: DataFrame, keys: Sequence[str] = ("contig",), pos="pos", start="start", end="end", bin_width: int = 16_384, tasks: int | None = None) -> DataFrame:
    """Points outside all mask intervals."""
    return range_join(points, mask.select(*keys, F.col(start).alias("__ms"), F.col(end).alias("__me")), keys, pos, "__ms", "__me", bin_width, "left_anti", tasks)
