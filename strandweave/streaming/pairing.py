"""Pairing strands as they arrive: a stream-stream join within a time bound, or a queue for each molecule."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def pair_stream(reads: DataFrame, keys: list[str], side: str, first: str, second: str, time: str, carry: list[str], lateness: str = "10 minutes") -> DataFrame:
    """Pairs of rows of both sides with equal keys that arrive within `lateness` of each other; older state is let go."""
    one = reads.where(F.col(side) == first).select(*[F.col(k).alias(f"{k}_1") for k in (*keys, time, *carry)]).withWatermark(f"{time}_1", lateness)
    two = reads.where(F.col(side) == second).select(*[F.col(k).alias(f"{k}_2") for k in (*keys, time, *carry)]).withWatermark(f"{time}_2", lateness)
    near = F.expr(f"{time}_2 between {time}_1 - interval {lateness} and {time}_1 + interval {lateness}")
    same = near
    for k in keys:
        same = same & (F.col(f"{k}_1") == F.col(f"{k}_2"))
    out = one.join(two, same)
    return out.select(*[F.col(f"{k}_1").alias(k) for k in keys], *[f"{c}_{n}" for c in (time, *carry) for n in (1, 2)])


def depth_stream(events: DataFrame, keys: list[str], time: str, width: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Counts by key and time window, each emitted once its window is over."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("depth")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "depth")


def pair_in_order_stream(reads: DataFrame, keys: list[str], side: str, order: str, first: str, second: str, carry: list[str]) -> DataFrame:
    """keys and, for order and each carried column c, c_1 and c_2: `pairing.in_order` on a stream.

    Each key's state is the one read that waits: a later one of its side takes its place, and one
    of the other side makes a pair with it and empties the state. Reads of a micro-batch count in
    the order given; batches count as they come, so any split of an ordered input gives the same pairs.
    """
    told = [order, *carry]
    kinds = {c: reads.schema[c].dataType for c in (*keys, side, *told)}
    out = T.StructType([T.StructField(k, kinds[k]) for k in keys] + [T.StructField(f"{c}_{n}", kinds[c]) for c in told for n in (1, 2)])
    state = T.StructType([T.StructField("side", T.StringType())] + [T.StructField(c, kinds[c]) for c in told])

    def run(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        waiting, made = held.get if held.exists else None, []
        rows = [r for frame in frames for r in zip(frame[side], *(frame[c] for c in told), strict=True)]
        for row in sorted(rows, key=lambda r: r[1]):
            if waiting is not None and waiting[0] != row[0] and {waiting[0], row[0]} == {first, second}:
                one, two = (waiting, row) if waiting[0] == first else (row, waiting)
                made.append((*key, *(x for pair in zip(one[1:], two[1:], strict=True) for x in pair)))
                waiting = None
            else:
                waiting = row
        if waiting is None:
            if held.exists:
                held.remove()
        else:
            held.update(tuple(x.item() if hasattr(x, "item") else x for x in waiting))
        yield pd.DataFrame(made, columns=out.names)

    return reads.select(*keys, side, *told).groupBy(*keys).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.NoTimeout)
