"""Low-complexity intervals of sequences by the symmetric DUST score.

An interval of l 3-mers, of which 3-mer t occurs c(t) times, scores
sum c(t) (c(t) - 1) / 2 / (l - 1). It is perfect if it scores above the
threshold and no interval inside it scores higher; the mask is the union of
all perfect intervals of at most `window` bases. Where none can begin is told by
counts of equal pairs, a few passes over bytes for each length; the other stretches have all
intervals scored at once, one length after the other. Short sequences are laid end to end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.dna import BASES
from . import intervals

WINDOW, THRESHOLD = 64, 2.0
#: Letters that are scored at a time.
SLICE = 1 << 18


#: Lengths at which pairs are counted: what lies between two of them needs the pairs of the lesser and has at most those of the greater.
STEPS = [4, 5, 6, 8, 10, 13, 17, 22, 29, 38, 50, 65, 86, 113, 148, 194, 253]


def _may_begin(left: np.ndarray, right: np.ndarray, most: int, threshold: float) -> np.ndarray:
    """Whether an interval above the threshold, of at most `most` 3-mers and one, can begin at each 3-mer: a bound, met by all that do."""
    n, least = len(left), 1
    ahead, behind, found = np.zeros(n, np.uint8), np.zeros(n, np.uint8), np.zeros(n, bool)
    for d in range(1, min(most, n - 1) + 1):
        same = (right[d:] == left[: n - d]).view(np.uint8)
        ahead[: n - d] += same
        behind[d:] += same
        if d in STEPS or d == min(most, n - 1):
            bound = threshold * least * (1 - 1e-6)
            if d * (d + 1) / 2 > bound:
                step = -ahead[:-1].astype(np.int16)
                step[: n - 1 - d] += behind[d + 1 :]
                pairs = np.cumsum(step, dtype=np.int32) + int(behind[: d + 1].sum(dtype=np.int64))  # among the d + 1 from the second on
                found[1:] |= pairs > bound
                found[0] |= behind[: d + 1].sum(dtype=np.int64) > bound
            least = d + 1
    return found


def perfect(letters: np.ndarray, own: int | np.ndarray, window: int = WINDOW, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the union of the perfect intervals that begin in the first `own` letters, or where own is true. Other letters than A, C, G, T are in none."""
    if window > 256:
        raise ValueError("a window is at most 256 bases")
    none = np.zeros(0, np.int64)
    known = np.full(256, 4, np.uint8)
    known[list((BASES + BASES.lower()).encode())] = [0, 1, 2, 3] * 2
    x = known[letters]
    n = len(x) - 2
    allowed = own[: max(n, 0)] if isinstance(own, np.ndarray) else np.arange(max(n, 0)) < own
    if n < 2 or not allowed.any():
        return none, none
    bad = np.maximum(np.maximum(x[:-2], x[1:-1]), x[2:]) > 3
    code = x[:-2] * np.uint8(25) + x[1:-1] * np.uint8(5) + x[2:]
    left, right = np.where(bad, np.uint8(254), code), np.where(bad, np.uint8(255), code)  # a strange 3-mer equals none
    most = window - 3
    began = np.flatnonzero(_may_begin(left, right, most, threshold) & allowed)
    if not len(began):
        return none, none
    # stretches that hold all of an interval from where it may begin, with strange 3-mers between them
    fresh = np.flatnonzero(np.diff(began) > most + 4) + 1
    first, last = began[np.concatenate([[0], fresh])], np.minimum(began[np.concatenate([fresh - 1, [-1]])] + most, n - 1)
    size = last - first + 4
    ends = np.cumsum(size)
    at = np.arange(ends[-1]) - np.repeat(ends - size - first, size)  # of each 3-mer, in the whole
    apart = at > np.repeat(last, size)
    at = np.minimum(at, n - 1)
    left, right, bad = np.where(apart, np.uint8(254), left[at]), np.where(apart, np.uint8(255), right[at]), bad[at] | apart
    starts, stops = _scored(left, right, bad, allowed[at], window, threshold)
    return at[starts], at[starts] + stops - starts


def _scored(left: np.ndarray, right: np.ndarray, bad: np.ndarray, allowed: np.ndarray, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The same of 3-mers: all intervals, one length after the other."""
    n = len(left)
    strange = np.concatenate([[0], np.cumsum(bad)])
    # small whole numbers and their quotients: narrow types hold them exactly, or keep different ones apart
    seen, pairs, best = np.zeros(n, np.int16), np.zeros(n, np.int16), np.zeros(n, np.float32)
    cover = np.zeros(n + 3, np.int64)
    for d in range(1, min(window - 2, n)):
        seen[d:] += right[d:] == left[: n - d]
        pairs = pairs[: n - d] + seen[d:]  # equal pairs among the 3-mers i to i + d
        score = np.divide(pairs, np.float32(d), dtype=np.float32)
        inside = np.maximum(best[:-1], best[1:])
        good = np.flatnonzero((score > threshold) & (score >= inside))
        good = good[allowed[good] & (strange[good + d + 1] == strange[good])]
        cover[good] += 1  # intervals of one length have different bounds
        cover[good + d + 3] -= 1
        best = np.maximum(score, inside)
    held = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    steps = np.flatnonzero(np.diff(held))
    return steps[::2], steps[1::2]


def low_complexity(tiles: DataFrame, size: int, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """contig, start, end: merged low-complexity intervals of a reference in tiles (`molecules.reference_tiles`) of `size` bases.

    A tile is scored with the first bases of the next one, so that an interval belongs to the tile where it begins.
    """
    if size < window:
        raise ValueError("a tile is at least a window")
    body = tiles.select("contig", "tile", F.substring("seq", F.col("lead") + 1, F.lit(size)).alias("body"))
    following = body.select("contig", (F.col("tile") - 1).alias("tile"), F.substring("body", 1, window - 1).alias("more"))
    whole = body.join(following, ["contig", "tile"], "left").select("contig", (F.col("tile") * size).alias("at"), F.length("body").alias("own"), F.concat("body", F.coalesce("more", F.lit(""))).alias("seq"))
    return intervals.merge(scored(whole, tiles.schema["contig"].dataType.simpleString(), window, threshold), ["contig"])


def of_sequences(rows: DataFrame, contig: str, seq: str, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """contig, start, end of sequences that are a row each."""
    whole = rows.where(F.col(seq).isNotNull()).select(F.col(contig).alias("contig"), F.lit(0).cast("long").alias("at"), F.length(seq).alias("own"), F.col(seq).alias("seq"))
    found = scored(whole, whole.schema["contig"].dataType.simpleString(), window, threshold)
    return found.withColumnRenamed("contig", contig) if contig != "contig" else found


def scored(pieces: DataFrame, kind: str, window: int, threshold: float) -> DataFrame:
    """contig, start, end from pieces (contig, at, own, seq): intervals that begin in a piece's own letters, disjoint within a piece."""

    def told(parts: list[tuple[int, int, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, start and end in parts (row, place, letters, own letters) that are laid end to end, a strange letter between them."""
        size = np.array([len(x) + 1 for _, _, x, _ in parts])
        offset = np.cumsum(size) - size
        letters, own = np.full(size.sum(), ord("N"), np.uint8), np.zeros(size.sum(), bool)
        for k, (_, _, x, mine) in zip(offset, parts, strict=True):
            letters[k : k + len(x)] = x
            own[k : k + mine] = True
        a, b = perfect(letters, own, window, threshold)
        which = np.searchsorted(offset, a, "right") - 1
        shift = np.array([at for _, at, _, _ in parts])[which] - offset[which]
        return np.array([row for row, *_ in parts])[which], a + shift, b + shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, parts, held = [], [], 0
            for row in range(len(batch)):
                letters = np.frombuffer(batch.column("seq")[row].as_py().encode("ascii", "replace"), np.uint8)
                at, own = batch.column("at")[row].as_py(), batch.column("own")[row].as_py()
                for k in range(0, own, SLICE):
                    parts.append((row, at + k, letters[k : k + SLICE + window - 1], min(SLICE, own - k)))
                    held += len(parts[-1][2])
                    if held >= SLICE:
                        found.append(told(parts))
                        parts, held = [], 0
            if parts:
                found.append(told(parts))
            if not found:
                continue
            rows, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(rows):
                continue
            # what goes on from the slice before is one interval with it
            reach = np.maximum.accumulate(last + (rows << 40))
            new = np.concatenate([[True], first[1:] + (rows[1:] << 40) > reach[:-1]])
            begin = np.flatnonzero(new)
            end = reach[np.concatenate([begin[1:] - 1, [len(rows) - 1]])] - (rows[begin] << 40)
            yield pa.RecordBatch.from_arrays([batch.column("contig").take(pa.array(rows[begin])), pa.array(first[begin]), pa.array(end)], names=["contig", "start", "end"])

    return pieces.mapInArrow(run, f"contig {kind}, start long, end long")
