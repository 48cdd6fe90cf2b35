"""Molecules walked as arrays: what `walk` says a row a base, said a row a molecule.

Both reads of a molecule and the stretch of reference below them are one row.
An Arrow function lays out the aligned blocks of each read by cumulative
sums, masks qualities by difference arrays, merges the two block lists by
position and classifies what both align, before anything is exploded: only
the records (x, m, z) and the runs of callable positions leave the task.
Depths are then sweeps over runs, and the reference comes in tiles that a
molecule meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import dealt
from . import intervals
from .filters import D, I, cigar_total, identity
from .pairing import openers, strand
from .walk import BLOCK_OPS, QUERY_OPS, REFERENCE_OPS

TILE = 1 << 14
KEYS = ["sample", "contig", "zm"]
ALONG = KEYS[::-1]  # sorts find what tells most rows apart in front
READ = ["pos", "op", "len", "seq", "qual", "sm", "sim", "ec", "end"]
#: What a strand says of a record, and its type.
CALL = {"base": pa.string(), "bq": pa.int32(), "qpos": pa.int32(), "bq_mean": pa.float64(), "bq_sd": pa.float64(), "qlen": pa.int32(), "sim": pa.float64(), "sm": pa.int32(), "start": pa.int32(), "end": pa.int32(), "ec": pa.float64()}
RECORD = {"pos": pa.int32(), "ref": pa.string(), "tri": pa.string(), "kind": pa.string(), "callable": pa.bool_(), "n_mis": pa.int64(), "nob": pa.int32()}
_SQL = {pa.string(): "string", pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", pa.bool_(): "boolean"}
N = ord("N")


# Arrays of one read


def _table(ops: tuple[int, ...]) -> np.ndarray:
    """Whether each operation is one of ops."""
    return np.isin(np.arange(16), ops)


_REFERENCE, _QUERY, _BLOCK, _INDEL = _table(REFERENCE_OPS), _table(QUERY_OPS), _table(BLOCK_OPS), _table((I, D))


def placed(op: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each operation's offset on the reference and in the query."""
    r, q = length * _REFERENCE[op], length * _QUERY[op]
    return np.cumsum(r) - r, np.cumsum(q) - q


def trimmed(n: int, trim: float) -> int:
    """Bases that the end trim takes of n: all of them where a share rounds to none."""
    if trim < 0:
        raise ValueError("trim is not negative")
    if trim == 0 or trim >= 1:
        return int(trim)
    return int(np.rint(n * trim)) or n


def masked(qual: np.ndarray, op: np.ndarray, length: np.ndarray, trim: float, indel_pad: int) -> np.ndarray:
    """Qualities with zeros at the ends and around insertions and deletions: differences at the bounds, added up."""
    out, n, size = qual.astype(np.int64), trimmed(len(qual), trim), len(qual)
    if n:
        out[:n] = 0
        out[max(0, size - n) :] = 0
    indel = _INDEL[op]
    if indel.any():
        q = placed(op, length)[1][indel]
        steps = np.zeros(size + 1, np.int64)
        np.add.at(steps, np.clip(q - indel_pad, 0, size), 1)
        np.add.at(steps, np.clip(q + indel_pad + np.where(op[indel] == I, length[indel], 0) + 1, 0, size), -1)
        out[np.cumsum(steps[:-1]) > 0] = 0
    return out


# Rows of molecules side by side: arrays over all of their letters, each with its row


#: Letters of reads that are laid out at a time.
LETTERS = 1 << 19
#: Positions of different rows differ by this at least.
_APART = 1 << 34


def picked(seed: int | np.ndarray, pos: np.ndarray, share: int) -> np.ndarray:
    """Whether pmod(xxhash64(..., pos), share) = 0, with seed the hash of the columns before pos: the published 64-bit hash of one int."""
    p1, p2, p3, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    with np.errstate(over="ignore"):
        h = np.asarray(seed, np.int64).view(np.uint64) + p5 + np.uint64(4) ^ (pos.astype(np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF)) * p1
        h = (h << np.uint64(23) | h >> np.uint64(41)) * p2 + p3
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        h ^= h >> np.uint64(32)
    return h.view(np.int64) % share == 0


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _listed(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Each row's first place in the values of all rows, with the end of the last; null is empty."""
    return np.concatenate([[0], np.cumsum(_numbers(column.value_lengths()))]), column.flatten()


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, bounds, letters = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    return bounds - bounds[0], np.frombuffer(letters or b"", np.uint8)[bounds[0] : bounds[-1]]


def _spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For so many elements of each: which it is of, and its place from 0."""
    whose = np.repeat(np.arange(len(lengths)), lengths)
    return whose, np.arange(len(whose)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _text(letters: np.ndarray, width: int = 1) -> pa.Array:
    """Texts of `width` letters that lie one after the other."""
    if (letters > 127).any():
        return pa.array([x.tobytes().decode("latin-1") for x in letters.reshape(-1, width)], pa.string())
    return pa.Array.from_buffers(pa.string(), len(letters) // width, [None, pa.py_buffer(np.arange(0, len(letters) + 1, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(letters))])


class Reads:
    """One side's reads of some rows, laid out: row, key and place of every aligned base, in order.

    key is a base's position with the row's distance; place is where its letter lies among those of all rows.
    """

    def __init__(self, batch: pa.RecordBatch, suffix: str, rules: Rules):
        self.columns = {name: batch.column(f"{name}{suffix}") for name in READ}
        self.start = _numbers(self.columns["pos"])
        self.bounds, self.letters = _bytes(self.columns["seq"])
        self.sizes = np.diff(self.bounds)
        op_bounds, ops = _listed(self.columns["op"])
        op, length = _numbers(ops), _numbers(_listed(self.columns["len"])[1])
        whose = np.repeat(np.arange(len(batch)), np.diff(op_bounds))
        (r, q), first = placed(op, length), op_bounds[whose]
        r, q = r - r[first], q - q[first]  # within the row
        block = np.flatnonzero(_BLOCK[op] & (length > 0))
        of, k = _spread(length[block])
        self.row, at = whose[block][of], q[block][of] + k
        if (at >= self.sizes[self.row]).any():
            raise IndexError("a CIGAR reaches beyond its read")
        self.key, self.place = self.row * _APART + self.start[self.row] + r[block][of] + k, self.bounds[self.row] + at
        indel = np.flatnonzero(_INDEL[op])
        self.quality = self._masked(rules, whose[indel], q[indel], np.where(op[indel] == I, length[indel], 0))
        if (at >= self.rated_n[self.row]).any():
            raise IndexError("a CIGAR reaches beyond its read's qualities")

    def _masked(self, rules: Rules, row: np.ndarray, q: np.ndarray, inserted: np.ndarray) -> np.ndarray:
        """What `masked` says of each row, at the places of its letters; without qualities they are all 0."""
        bounds, values = _listed(self.columns["qual"])
        rated = self.columns["qual"].is_valid().to_numpy(zero_copy_only=False)
        n = np.where(rated, np.diff(bounds), self.sizes)
        whose, k = _spread(n)
        out = np.zeros(len(whose), np.int64)
        out[rated[whose]] = _numbers(values)
        ends = np.array([trimmed(int(x), rules.trim) for x in n], np.int64) if 0 < rules.trim < 1 else np.full(len(n), trimmed(0, rules.trim), np.int64)
        out[(k < ends[whose]) | (k >= (n - ends)[whose])] = 0
        self.rated_first, self.rated_n = np.cumsum(n) - n, n
        if len(row):
            first = self.rated_first + np.arange(len(n))  # a row more each, for steps at its end
            steps = np.zeros(len(whose) + len(n), np.int64)
            np.add.at(steps, first[row] + np.clip(q - rules.indel_pad, 0, n[row]), 1)
            np.add.at(steps, first[row] + np.clip(q + rules.indel_pad + inserted + 1, 0, n[row]), -1)
            out[np.cumsum(steps)[first[whose] + k] > 0] = 0
        return out

    def qualities(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.quality[place - self.bounds[row] + self.rated_first[row]]

    def call(self, row: np.ndarray, place: np.ndarray, window: int) -> dict[str, pa.Array]:
        """The fields of CALL at places of rows. bq_mean and bq_sd: of the qualities within `window` in the read, to 2 places; from two cumulative sums."""
        at, size, first = place - self.bounds[row], self.rated_n[row], self.rated_first[row]
        one, two = (np.concatenate([[0], np.cumsum(x)]) for x in (self.quality, self.quality * self.quality))
        low, high = first + np.maximum(at - window, 0), first + np.minimum(at + window, size - 1) + 1
        mean = (one[high] - one[low]).astype(float) / (high - low)
        deviation = np.sqrt(np.maximum((two[high] - two[low]).astype(float) / (high - low) - mean * mean, 0.0))
        rows, (sm_bounds, sm) = pa.array(row), _listed(self.columns["sm"])
        passes = sm.take(pa.array(sm_bounds[row] + at, mask=at >= np.diff(sm_bounds)[row]))
        whole = {"base": _text(self.letters[place]), "bq": pa.array(self.quality[first + at]), "qpos": pa.array(at), "bq_mean": pa.array(np.rint(mean * 100) / 100), "bq_sd": pa.array(np.rint(deviation * 100) / 100)}
        whole |= {"qlen": pa.array(self.sizes[row]), "sim": self.columns["sim"].take(rows), "sm": passes, "start": self.columns["pos"].take(rows), "end": self.columns["end"].take(rows), "ec": self.columns["ec"].take(rows)}
        return {name: x.cast(CALL[name]) for name, x in whole.items()}


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of consecutive positions."""
    if not len(key):
        return key, key
    cut = np.flatnonzero(np.diff(key) != 1)
    return np.concatenate([key[:1], key[cut + 1]]), np.concatenate([key[cut], key[-1:]]) + 1


@dataclass(frozen=True)
class Rules:
    min_bq: int = 93
    mismatch_window: int = 20
    quality_window: int = 20
    z_share: int = 0
    trim: float = 50
    indel_pad: int = 10


def walked_rows(batch: pa.RecordBatch, suffixes: list[str], rules: Rules) -> list[pa.Array]:
    """n_callable, runs, records, qualities of some rows.

    Two reads: positions that both align, an m where one differs from the reference, an x where both do
    alike; near an m nothing is callable. One read stands for both strands: no m, nothing near one.
    """
    column = lambda name: batch.column(batch.schema.get_field_index(name))
    sides, n = [Reads(batch, s, rules) for s in suffixes], len(batch)
    below, letters = _bytes(column("below"))
    lead, lengths = below[:-1] - _numbers(column("below_start")), _numbers(column("length"))
    one = sides[0]
    key, row, places = one.key, one.row, [one.place]
    if len(sides) == 2:
        at = np.searchsorted(sides[1].key, key)
        met = np.append(sides[1].key, -1)[at] == key
        key, row, places = key[met], row[met], [one.place[met], sides[1].place[at[met]]]
    under = key - row * _APART + lead[row]
    known = (under >= below[row]) & (under < below[row + 1])
    key, row, under, places = key[known], row[known], under[known], [x[known] for x in places]
    pos, ref = key - row * _APART, letters[under]
    bases = [x.letters[p] for x, p in zip(sides, places, strict=True)]
    bq = np.minimum.reduce([x.qualities(row, p) for x, p in zip(sides, places, strict=True)])
    match = [b == ref for b in bases]
    same = np.logical_and.reduce(match)
    good = bq >= rules.min_bq if rules.min_bq or len(sides) == 1 else np.ones(len(key), bool)
    if len(sides) == 2:
        split, agreed = good & (match[0] != match[1]), good & ~match[0] & ~match[1] & (bases[0] == bases[1]) & (ref != N)
    else:
        split, agreed = np.zeros(len(key), bool), good & ~same & (bases[0] != N) & (ref != N)
    chosen = good & same & picked(_numbers(column("seed"))[row], pos, rules.z_share) if rules.z_share else np.zeros(len(key), bool)
    at, w = key[split], min(rules.mismatch_window, _APART >> 2)
    near = np.searchsorted(at, key + w, "right") - np.searchsorted(at, key - w, "left") if w >= 0 and len(at) else np.zeros(len(key), np.int64)
    callable_ = (good & same | agreed) & (near == 0)
    told = np.flatnonzero(split | agreed | chosen)
    t_row, t_pos = row[told], pos[told]
    inner = (t_pos > 0) & (t_pos < lengths[t_row] - 1)
    around = under[told][inner][:, None] + np.arange(-1, 2)
    tri = _text(letters[around].ravel(), 3).take(pa.array(np.cumsum(inner) - 1, mask=~inner))
    fields = {"pos": pa.array(t_pos), "ref": _text(ref[told]), "tri": tri, "kind": pa.array(["m", "x", "z"]).take(pa.array(np.where(split, 0, np.where(agreed, 1, 2))[told])), "callable": pa.array(callable_[told])}
    nob = sum(np.abs(_numbers(sides[0].columns[c]) - _numbers(sides[1].columns[c])) for c in ("pos", "end")) if len(sides) == 2 else np.zeros(n, np.int64)
    fields |= {"n_mis": pa.array((near - (split & (w >= 0)))[told]), "nob": pa.array(nob[t_row])}
    fields = {name: x.cast(RECORD[name]) for name, x in fields.items()}
    for suffix, side, p in zip(suffixes, sides, places, strict=True):
        fields |= {f"{name}{suffix}": x for name, x in side.call(t_row, p[told], rules.quality_window).items()}
    first, last = runs(key[callable_])
    r_row = first // _APART
    seen, often = np.unique(row[same] * _APART + bq[same], return_counts=True)
    count = lambda rows: np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    listed = lambda rows, columns: pa.ListArray.from_arrays(pa.array(count(rows), pa.int32()), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))
    number = lambda x, kind=pa.int32(): pa.array(x).cast(kind)
    return [
        number(np.bincount(row[callable_], minlength=n), pa.int64()),
        listed(r_row, {"start": number(first - r_row * _APART), "end": number(last - r_row * _APART)}),
        listed(t_row, fields),
        listed(seen // _APART, {"bq": number(seen % _APART), "n": number(often, pa.int64())}),
    ]


def slices(batch: pa.RecordBatch, suffixes: list[str], most: int = LETTERS) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, so many at a time that their reads hold at most `most` letters; a row with more by itself."""
    size = np.cumsum(sum(_numbers(pc.utf8_length(batch.column(batch.schema.get_field_index(f"seq{s}")))) for s in suffixes))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


# Rows of molecules


def reference_tiles(reference: DataFrame, size: int = TILE) -> DataFrame:
    """contig, tile, lead, seq, length: the reference in pieces of `size` bases, each with a neighbour on both sides where there is one.

    reference: contig, seq of whole contigs, or pieces of `tables.sequence_chunks` of that size.
    """
    if "lead" in reference.columns:
        length = reference.groupBy("contig").agg(F.max(F.col("start") + F.length("seq") - F.col("lead") - F.col("tail")).alias("length"))
        one = F.least("lead", F.lit(1))
        own = reference.select("contig", F.floor(F.col("start") / size).alias("tile"), one.alias("lead"), F.upper(F.substring("seq", F.col("lead") - one + 1, F.length("seq"))).alias("seq"), F.when(F.col("start") % size != 0, F.raise_error(F.lit("pieces of another size"))).alias("bad"))
        return own.join(length, "contig").where("bad is null").drop("bad")
    length = F.length("seq").cast("long")
    pieces = reference.where("length(seq) > 0").select("contig", "seq", length.alias("length"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((length - 1) / size))).alias("tile"))
    lead = F.when(F.col("tile") > 0, 1).otherwise(0)
    return pieces.select("contig", "tile", lead.alias("lead"), F.upper(F.substring("seq", (F.col("tile") * size - lead + 1).cast("int"), lead + size + 1)).alias("seq"), "length")


def stretches(spans: DataFrame, tiles: DataFrame, keys: list[str], size: int = TILE, tasks: int | None = None, by: list[str] | None = None) -> DataFrame:
    """keys, below_start, below, length: the letters under each span (contig, low, high), with a neighbour on both sides; dealt by some of keys.

    A span meets the few tiles it touches, one row each; what shuffles is tiles and the spans' own letters.
    """
    asked = spans.select(*keys, F.greatest(F.col("low") - 1, F.lit(0)).cast("long").alias("__low"), (F.col("high") + 1).cast("long").alias("__high")).where("__low < __high")
    parts = asked.withColumn("tile", F.explode(F.sequence(F.floor(F.col("__low") / size), F.floor((F.col("__high") - 1) / size))))
    met = parts.join(tiles, ["contig", "tile"])
    a, b = F.greatest("__low", F.col("tile") * size), F.least(F.col("__high"), (F.col("tile") + 1) * size, F.col("length"))
    cut = met.withColumn("__a", a).withColumn("__part", F.substring("seq", (a - F.col("tile") * size + F.col("lead") + 1).cast("int"), (b - a).cast("int"))).where("length(__part) > 0")
    listed = F.sort_array(F.collect_list(F.struct("__a", "__part")))  # the few tiles of one span
    return dealt(cut, tasks, *(by or keys)).groupBy(*keys).agg(F.min("__a").alias("below_start"), F.array_join(F.transform(listed, lambda x: x["__part"]), "").alias("below"), F.max("length").alias("length"))


def prepared(reads: DataFrame) -> DataFrame:
    """reads with the columns of READ and the end of their alignment."""
    out = reads.withColumn("end", F.col("pos") + cigar_total(F.col("cigar"), REFERENCE_OPS))
    out = out.withColumn("op", F.transform("cigar", lambda c: c["op"].cast("int"))).withColumn("len", F.transform("cigar", lambda c: c["len"].cast("int")))
    out = out.withColumn("sim", identity() if "nm" in reads.columns else F.lit(None).cast("double"))
    return out.withColumn("sm", F.col("sm").cast("array<int>") if "sm" in reads.columns else F.lit(None).cast("array<int>"))


def pairs(reads: DataFrame, tasks: int | None = None, columns: list[str] = READ) -> DataFrame:
    """sample, contig, zm, mol and, with _1 and _2, the two reads' columns: molecules in order of input.

    Pairing leaves a zm's reads in one partition in order, so making a row of two neither moves nor sorts anything.
    """
    sided = prepared(reads).withColumn("strand", strand(F.col("qname"))).select(*KEYS, "strand", "input_ord", *columns)
    met = openers(dealt(sided, tasks, *KEYS), ALONG, "strand", "input_ord", columns)
    forward = F.col("strand") == "fwd"
    own, other = (lambda c: F.col(c)), (lambda c: F.col(f"__next.{c}"))
    return met.select(*KEYS, "mol", *[F.when(forward, one(c)).otherwise(two(c)).alias(f"{c}_{k}") for k, one, two in ((1, own, other), (2, other, own)) for c in columns])


def walked(reads: DataFrame, tiles: DataFrame, rules: Rules, one_read: bool = False, size: int = TILE, tasks: int | None = None) -> DataFrame:
    """sample, contig, zm, mol or qname, n_callable, runs, records, qualities: a row for each molecule that the reference lies under.

    reads: already filtered. runs: array of (start, end) of callable positions. records:
    array of the classified changes with what the strands say. qualities: (bq, n) of
    positions where all strands match the reference, ungated. one_read: reads stand for both strands.
    tasks: of each shuffle of reads, whose rows are wide (`session.tasks_for`); without a number the session decides.
    """
    if one_read:
        named, suffixes = [*KEYS, "qname"], [""]
        rows = prepared(reads).select(*named, "input_ord", *READ)
        keys, seed = [*named, "input_ord"], F.xxhash64("sample", "contig", "qname")
        spans = rows.select(*keys, F.col("pos").alias("low"), F.col("end").alias("high"))
        wide = dealt(rows, tasks, *keys).join(stretches(spans, tiles, keys, size, tasks), keys)
    else:
        named, suffixes = [*KEYS, "mol"], ["_1", "_2"]
        rows, keys, seed = pairs(reads, tasks), named, F.xxhash64("sample", "contig", "zm")
        places = pairs(reads, tasks, ["pos", "end"])  # of narrow rows
        spans = places.select(*keys, F.greatest("pos_1", "pos_2").alias("low"), F.least("end_1", "end_2").alias("high")).where("low < high")
        found = stretches(spans, tiles, keys, size, tasks, KEYS).withColumnRenamed("mol", "__mol")
        # wide rows stay where pairing has left them, in its order: mol is compared, not dealt by
        wide = rows.join(found.hint("merge"), ALONG).where(F.col("mol") - F.col("__mol") == 0).drop("__mol")
    wide = wide.select(*named, *[f"{c}{s}" for s in suffixes for c in READ], "below_start", "below", "length", seed.alias("seed"))
    fields = RECORD | {f"{name}{s}": kind for s in suffixes for name, kind in CALL.items()}
    kinds = {c: rows.schema[c].dataType.simpleString() for c in named}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + f", n_callable long, runs array<struct<start:int,end:int>>, records array<struct<{','.join(f'{n}:{_SQL[k]}' for n, k in fields.items())}>>, qualities array<struct<bq:int,n:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, suffixes):
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in named], *walked_rows(part, suffixes, rules)], names=[*named, "n_callable", "runs", "records", "qualities"])

    return wide.mapInArrow(run, schema)


def records(molecules: DataFrame) -> DataFrame:
    """The classified changes, a row each, with the columns that `walk` gives them."""
    keys = [c for c in molecules.columns if c not in ("n_callable", "runs", "records", "qualities")]
    return molecules.select(*keys, F.explode("records").alias("r")).select(*keys, "r.*")


def qualities(molecules: DataFrame) -> DataFrame:
    """bq, n over all molecules."""
    return molecules.select(F.explode("qualities").alias("q")).groupBy("q.bq").agg(F.sum("q.n").alias("n"))


def depth_runs(molecules: DataFrame, bin_width: int = intervals.BIN_WIDTH) -> DataFrame:
    """sample, contig, start, end, depth: where equally many molecules are callable, but for none."""
    spans = molecules.select("sample", "contig", F.explode("runs").alias("r")).select("sample", "contig", F.col("r.start").cast("long").alias("start"), F.col("r.end").cast("long").alias("end"))
    steps = intervals.depth_steps(spans, ["sample", "contig"], bin_width=bin_width).where("depth > 0 and next_pos is not null")
    return steps.select("sample", "contig", F.col("pos").alias("start"), F.col("next_pos").alias("end"), F.col("depth").cast("int").alias("depth"))


def with_contexts(depths: DataFrame, tiles: DataFrame, size: int = TILE) -> DataFrame:
    """sample, contig, pos, tri, depth of every position of depth_runs but a contig's edges: runs meet tiles, then become positions."""
    parts = depths.withColumn("tile", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    met = parts.join(tiles, ["contig", "tile"])
    a, b = F.greatest("start", F.col("tile") * size, F.lit(1)), F.least(F.col("end"), (F.col("tile") + 1) * size, F.col("length") - 1)
    cut = met.withColumn("a", a).withColumn("b", b).where("a < b")
    letters = F.substring("seq", (F.col("a") - F.col("tile") * size + F.col("lead")).cast("int"), (F.col("b") - F.col("a") + 2).cast("int"))
    cut = cut.select("sample", "contig", F.col("a").cast("long").alias("a"), "depth", letters.alias("letters"))
    kinds = {c: cut.schema[c].dataType.simpleString() for c in ("sample", "contig")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, len(batch), 256):
                part = batch.slice(row, 256)
                bodies = [np.frombuffer(x.encode(), np.uint8) for x in part.column("letters").to_pylist()]
                n = np.array([len(x) - 2 for x in bodies])
                whose = pa.array(np.repeat(np.arange(len(part)), n))
                pos = np.repeat(part.column("a").to_numpy(), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                triples = np.concatenate([np.lib.stride_tricks.sliding_window_view(x, 3) for x in bodies])
                tri = pa.Array.from_buffers(pa.string(), len(triples), [None, pa.py_buffer(np.arange(0, 3 * len(triples) + 1, 3, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(triples))])
                yield pa.RecordBatch.from_arrays([part.column("sample").take(whose), part.column("contig").take(whose), pa.array(pos), tri, part.column("depth").take(whose)], names=["sample", "contig", "pos", "tri", "depth"])

    return cut.mapInArrow(run, f"sample {kinds['sample']}, contig {kinds['contig']}, pos long, tri string, depth int")
