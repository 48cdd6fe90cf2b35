"""Band counts: how many marked rows lie within w of a row, of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def within(mark: Column, keys: Sequence[str], pos: Column, w: int) -> Column:
    """Rows with `mark` whose position is at most w away (the row itself counts); none if w is negative."""
    if w < 0:
        return F.lit(0).cast("long")
    frame = Window.partitionBy(*keys).orderBy(pos).rangeBetween(-w, w)
    return F.sum(F.when(mark, 1).otherwise(0)).over(frame).cast("long")


def away_from(rows: DataFrame, mark: Column, keys: Sequence[str], pos: Column, w: int) -> DataFrame:
    """rows that have no marked row within w."""
    return rows.withColumn("__near", within(mark, keys, pos, w)).where("__near = 0").drop("__near")


def sliding(value: Column, keys: Sequence[str], order: Column, w: int) -> tuple[Column, Column]:
    """Mean and population deviation over the w rows on either side, unrounded."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(-w, w)
    return F.avg(value).over(frame), F.stddev_pop(value).over(frame)


def reverse_cumulative(histogram: DataFrame, value: str, count: str, digits: int = 6) -> DataFrame:
    """histogram with frac_ge: the share of counts at this value or above (0 if there are none)."""
    total = F.sum(count).over(Window.partitionBy())
    above = F.sum(count).over(Window.orderBy(F.desc(value)))
    return histogram.withColumn("frac_ge", F.when(total > 0, F.round(above / total, digits)).otherwise(0.0))
