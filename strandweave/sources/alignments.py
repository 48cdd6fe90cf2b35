"""Alignment files: a Python data source over BGZF-compressed binary alignments.

A file is read by many tasks. Without regions its bytes are divided evenly;
a task finds the first block of its share and, inside it, the first record
(`first_record`), and owns the records that begin in its share's blocks. With
regions, the file's binning index tells which stretches of the file can hold
their records, and only those are read; a stretch begins at a record.

Memory is bounded by a block, a record and an Arrow batch. Paths are opened with
Arrow's file systems, so every executor must see them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "sample string, contig string, pos int, flag int, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual array<int>, qname string, nm int, ec double, zm bigint, sm array<int>, input_ord bigint"
# 4-bit base codes and the sizes of tag types in the format.
LETTERS = "=ACMGRSVTWYHKDBN"
SIZES = {"A": "c", "c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
# The levels of the binning index, smallest bins first, as (first bin, shift of a position).
BINS = ((4681, 14), (585, 17), (73, 20), (9, 23), (1, 26), (0, 29))
LINEAR_SHIFT = 14
#: A block of the container never exceeds this; a share's first block begins this far into it at most.
BLOCK_BYTES = 1 << 16
#: Bytes that are inflated to find a record, and records that have to follow one another there.
LOOK_BYTES, CHAIN = 1 << 20, 4
SPLIT_BYTES = 64 << 20
BATCH_ROWS, BATCH_BYTES = 2_000, 16_000_000
_PAIRS = np.array([[ord(LETTERS[b >> 4]), ord(LETTERS[b & 15])] for b in range(256)], np.uint8)
_REFERENCE_OPS = (0, 2, 3, 7, 8)


def opened(path: str):
    """A file for random access, by the scheme of its path."""
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def exists(path: str) -> bool:
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.get_file_info(name).type == fs.FileType.File


def inflated(file) -> Iterator[bytes]:
    """The uncompressed members of any multi-member gzip stream, for files without the container's block sizes."""
    engine, held = zlib.decompressobj(31), b""
    while True:
        data = held or file.read(1 << 16)
        if not data:
            return
        out, held = engine.decompress(data), b""
        if engine.eof:
            held, engine = engine.unused_data, zlib.decompressobj(31)
        if out:
            yield out


def block_size(head: bytes) -> int | None:
    """Bytes of the block that begins with head; null if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return None
    end, at = 12 + struct.unpack_from("<H", head, 10)[0], 12
    while at + 4 <= min(end, len(head)):
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


class Cursor:
    """Reads on from a virtual offset (a block's place in the file, and a place in its data)."""

    def __init__(self, file, block: int, within: int = 0):
        self.file, self.within = file, within
        self._load(block)

    def _load(self, at: int) -> None:
        self.block, raw = at, self.file.read_at(BLOCK_BYTES, at)
        size = block_size(raw)
        if raw and (size is None or len(raw) < size):
            raise ValueError("the file is cut off, or has no block here")
        self.after = at + size if raw else None
        self.data = zlib.decompress(raw[:size], 31) if raw else b""

    def here(self) -> int | None:
        """The virtual offset of the next byte; null at the end."""
        while self.within >= len(self.data):
            if self.after is None:
                return None
            self.within -= len(self.data)
            self._load(self.after)
        return self.block << 16 | self.within

    def take(self, n: int) -> bytes:
        """The next n bytes, or none at the end."""
        parts, left = [], n
        while left:
            if self.here() is None:
                if parts:
                    raise ValueError("the file is cut off")
                return b""
            parts.append(self.data[self.within : self.within + left])
            self.within += len(parts[-1])
            left -= len(parts[-1])
        return b"".join(parts)


class Stream:
    """The same over a plain stream of members; places are counted in bytes."""

    def __init__(self, file):
        self.members, self.held, self.place = inflated(file), b"", 0

    def here(self) -> int | None:
        while not self.held:
            more = next(self.members, None)
            if more is None:
                return None
            self.held = more
        return self.place

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while left:
            if self.here() is None:
                if parts:
                    raise ValueError("the file is cut off")
                return b""
            parts.append(self.held[:left])
            self.held = self.held[len(parts[-1]) :]
            left -= len(parts[-1])
        self.place += n
        return b"".join(parts)


def header(source) -> list[tuple[str, int]]:
    """(name, length) of the reference sequences; source then stands at the first record."""
    if source.take(4) != b"BAM\1":
        raise ValueError("not a binary alignment file")
    source.take(struct.unpack("<i", source.take(4))[0])
    contigs = []
    for _ in range(struct.unpack("<i", source.take(4))[0]):
        name = source.take(struct.unpack("<i", source.take(4))[0])[:-1].decode()
        contigs.append((name, struct.unpack("<i", source.take(4))[0]))
    return contigs


def plausible(data: bytes, at: int, lengths: Sequence[int]) -> int | None:
    """Where the record that may begin here would end; null if none can begin here."""
    if at + 36 > len(data):
        return None
    size, ref, pos, name_len, _, _, n_ops, _, length, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    fixed = 32 + name_len + 4 * n_ops + (length + 1) // 2 + length
    if not (name_len > 1 and 0 <= length and fixed <= size < 1 << 28 and -1 <= ref < len(lengths) and -1 <= mate < len(lengths) and -1 <= mate_pos):
        return None
    if not (-1 <= pos and (ref < 0 or pos <= lengths[ref])):
        return None
    name = data[at + 36 : at + 36 + name_len]
    if len(name) == name_len and (name[-1] != 0 or not all(33 <= b <= 126 for b in name[:-1])):
        return None
    ops = data[at + 36 + name_len : at + 36 + name_len + 4 * n_ops]
    return at + 4 + size if all(b & 15 <= 9 for b in ops[::4]) else None


def first_block(file, start: int, size: int) -> int | None:
    """The first block at or after a place in the file; another block or the end follows it."""
    raw = file.read_at(2 * BLOCK_BYTES + 18, start)
    at = raw.find(b"\x1f\x8b\x08\x04")
    while at >= 0:
        own = block_size(raw[at : at + 512])
        if own is not None:
            after = file.read_at(18, start + at + own)
            if start + at + own == size or block_size(after) is not None:
                return start + at
        at = raw.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


def first_record(file, block: int, lengths: Sequence[int]) -> Cursor | None:
    """A cursor at the first record that begins in this block or a later one.

    A record is where CHAIN of them follow one another, or as many as there are bytes to look at.
    """
    source, blocks, data = Cursor(file, block), [], b""
    while len(data) < LOOK_BYTES and source.here() is not None:
        blocks.append((len(data), source.block))
        data += source.take(len(source.data) - source.within)
    ended = source.here() is None
    for at in range(max(0, len(data) - 35)):
        end, seen = plausible(data, at, lengths), 0
        while end is not None and seen < CHAIN and end + 36 <= len(data):
            end, seen = plausible(data, end, lengths), seen + 1
        if end is not None and (seen >= CHAIN or not ended or end == len(data)):
            first, place = max(b for b in blocks if b[0] <= at)
            return Cursor(file, place, at - first)
    if not ended:
        raise ValueError(f"no record begins within {LOOK_BYTES} bytes")
    return None


def tags(data: bytes) -> dict:
    out, at = {}, 0
    while at < len(data):
        name, kind, at = data[at : at + 2].decode(), chr(data[at + 2]), at + 3
        if kind in "ZH":
            end = data.index(0, at)
            out[name], at = data[at:end].decode(), end + 1
        elif kind == "B":
            of, n = SIZES[chr(data[at])], struct.unpack_from("<i", data, at + 1)[0]
            out[name] = list(struct.unpack_from(f"<{n}{of}", data, at + 5))
            at += 5 + n * struct.calcsize(of)
        else:
            (out[name],) = struct.unpack_from(f"<{SIZES[kind]}", data, at)
            at += struct.calcsize(SIZES[kind])
    return out


def decoded(body: bytes) -> dict:
    """One record's columns; ref is the number of its reference sequence."""
    ref, pos, name_len, mapq, _, n_ops, flag, length = struct.unpack_from("<iiBBHHHi", body)
    at = 32
    name, at = body[at : at + name_len - 1].decode(), at + name_len
    cigar, at = [(x & 15, x >> 4) for x in struct.unpack_from(f"<{n_ops}I", body, at)], at + 4 * n_ops
    packed, at = np.frombuffer(body, np.uint8, (length + 1) // 2, at), at + (length + 1) // 2
    seq = _PAIRS[packed].reshape(-1)[:length].tobytes().decode()
    qual, at = body[at : at + length], at + length
    found = tags(body[at:])
    ec = float(found["ec"]) if "ec" in found else None
    return {"ref": ref, "pos": pos, "flag": flag, "mapq": mapq, "cigar": cigar, "seq": seq, "qual": None if qual[:1] == b"\xff" else np.frombuffer(qual, np.uint8).astype(np.int32), "qname": name, "nm": found.get("NM"), "ec": ec, "zm": found.get("zm"), "sm": found.get("sm")}


def position(body: bytes) -> tuple[int, int, int]:
    """(reference sequence, start, end) of a record, without decoding the rest; one base where nothing is aligned."""
    ref, pos, name_len, _, _, n_ops = struct.unpack_from("<iiBBHH", body)
    span = sum(x >> 4 for x in struct.unpack_from(f"<{n_ops}I", body, 32 + name_len) if x & 15 in _REFERENCE_OPS)
    return ref, pos, pos + max(1, span)


# Binning index


def overlapping_bins(start: int, end: int) -> set[int]:
    """Bins that a record overlapping [start, end) may be in."""
    return {first + k for first, shift in BINS for k in range(start >> shift, (max(start + 1, end) - 1 >> shift) + 1)}


class Index:
    """A file's binning index: for each reference sequence, stretches of the file by bin, and the least place by window."""

    def __init__(self, data: bytes):
        if data[:4] != b"BAI\1":
            raise ValueError("not a binning index")
        at, self.bins, self.windows = 8, [], []
        for _ in range(struct.unpack_from("<i", data, 4)[0]):
            (n, at), bins = (struct.unpack_from("<i", data, at)[0], at + 4), {}
            for _ in range(n):
                number, chunks = struct.unpack_from("<Ii", data, at)
                ends = struct.unpack_from(f"<{2 * chunks}Q", data, at + 8)
                bins[number], at = list(zip(ends[::2], ends[1::2], strict=True)), at + 8 + 16 * chunks
            (n,) = struct.unpack_from("<i", data, at)
            self.windows.append(struct.unpack_from(f"<{n}Q", data, at + 4))
            self.bins.append(bins)
            at += 4 + 8 * n

    def stretches(self, ref: int, start: int, end: int) -> list[tuple[int, int]]:
        """Virtual offsets (from, to) that hold every record overlapping [start, end) of a reference sequence."""
        bins, windows, place = self.bins[ref], self.windows[ref], start >> LINEAR_SHIFT
        least = windows[place] if place < len(windows) else windows[-1] if windows else 0
        asked = overlapping_bins(start, end)
        number = (number for number in bins if number in asked) if len(asked) > len(bins) else (n for n in asked if n in bins)
        return merged([(max(a, least), b) for n in number for a, b in bins[n] if b > least])


def merged(stretches: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that overlap or touch made one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def header_contigs(spark: SparkSession, path: str) -> DataFrame:
    """contig, length, idx of the reference sequences that a file's header names, in its order (as many rows as sequences)."""
    with opened(path) as file:
        source = Stream(file) if block_size(file.read_at(512, 0)) is None else Cursor(file, 0)
        rows = [(name, length, k) for k, (name, length) in enumerate(header(source))]
    return spark.createDataFrame(rows, "contig string, length long, idx int")


# Data source


@dataclass
class Share(InputPartition):
    """What one task reads of a file. kind: 'bytes' (owns the records of blocks in [a, b)), 'stretch' (virtual offsets, a at a record), or 'stream'."""

    path: str
    kind: str = "stream"
    a: int = 0
    b: int = 0
    regions: dict = field(default_factory=dict)  # contig -> [(start, end)]; empty: all records

    def __post_init__(self):
        super().__init__(None)


def shares(path: str, regions: dict, split_bytes: int) -> list[Share]:
    """A file's tasks."""
    with opened(path) as file:
        size = file.size()
        if block_size(file.read_at(512, 0)) is None:
            return [Share(path, "stream", 0, 0, regions)]
        if regions and exists(f"{path}.bai"):
            with opened(f"{path}.bai") as f:
                index = Index(f.read())
            names = {name: k for k, (name, _) in enumerate(header(Cursor(file, 0)))}
            found = merged([s for name, spans in regions.items() if name in names for start, end in spans for s in index.stretches(names[name], start, end)])
            return [part for a, b in found for part in divided(index, path, a, b, regions, split_bytes)]
    n = max(1, -(-size // split_bytes))
    return [Share(path, "bytes", size * k // n, size * (k + 1) // n, regions) for k in range(n)]


def divided(index: Index, path: str, a: int, b: int, regions: dict, split_bytes: int) -> list[Share]:
    """A long stretch in parts that begin at records the index knows of."""
    known = sorted({x for bins in index.bins for chunks in bins.values() for x, _ in chunks if a < x < b} | {x for w in index.windows for x in w if a < x < b})
    cuts = [a]
    for x in known:
        if (x >> 16) - (cuts[-1] >> 16) >= split_bytes:
            cuts.append(x)
    return [Share(path, "stretch", x, y, regions) for x, y in zip(cuts, [*cuts[1:], b], strict=True)]


def records(share: Share, file) -> Iterator[tuple[int, str | None, bytes]]:
    """(place in the file, contig, body) of the records that a share owns and its regions hold."""
    if share.kind == "stream":
        source = Stream(file)
        contigs, ends = header(source), None
    else:
        source = Cursor(file, 0)
        contigs, ends = header(source), share.b << 16 if share.kind == "bytes" else share.b
        if share.kind == "stretch":
            source = Cursor(file, share.a >> 16, share.a & 0xFFFF)
        elif share.a > 0:
            block, lengths = first_block(file, share.a, file.size()), [n for _, n in contigs]
            # a share may lie within the header's blocks
            start, found = source.here(), None
            if block is not None and block < share.b:
                found = first_record(file, block, lengths) if start is not None and block > start >> 16 else source
            if found is None:
                return
            source = found
    names = [name for name, _ in contigs]
    wanted = {k: share.regions[name] for k, name in enumerate(names) if name in share.regions}
    while (place := source.here()) is not None and (ends is None or place < ends):
        if share.kind == "bytes" and place >> 16 < share.a:  # begins in an earlier share's block
            source.take(struct.unpack("<i", source.take(4))[0])
            continue
        body = source.take(struct.unpack("<i", source.take(4))[0])
        if share.regions:
            ref, start, end = position(body)
            if not any(start < to and end > at for at, to in wanted.get(ref, ())):
                continue
        ref = struct.unpack_from("<i", body)[0]
        yield place, names[ref] if ref >= 0 else None, body


def batches(share: Share, file) -> Iterator[pa.RecordBatch]:
    """The rows of a share as Arrow batches."""
    sample = share.path.rsplit("/", 1)[-1].split(".", 1)[0]
    kinds = {"cigar": pa.list_(pa.struct([("op", pa.int32()), ("len", pa.int32())])), "seq": pa.string(), "qual": pa.list_(pa.int32()), "qname": pa.string(), "nm": pa.int32(), "ec": pa.float64(), "zm": pa.int64(), "sm": pa.list_(pa.int32())}
    numbers = {"pos": pa.int32(), "flag": pa.int32(), "mapq": pa.int32()}
    order = ["sample", "contig", *numbers, *kinds, "input_ord"]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        columns = {"sample": pa.array([sample] * len(rows)), "contig": pa.array([r["contig"] for r in rows], pa.string()), "input_ord": pa.array([r["input_ord"] for r in rows], pa.int64())}
        for name, kind in (numbers | kinds).items():
            columns[name] = pa.array([[{"op": o, "len": n} for o, n in r["cigar"]] for r in rows] if name == "cigar" else [r[name] for r in rows], kind)
        return pa.RecordBatch.from_arrays([columns[c] for c in order], names=order)

    rows, held = [], 0
    for place, contig, body in records(share, file):
        rows.append(decoded(body) | {"contig": contig, "input_ord": place})
        held += len(body)
        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
            yield batch(rows)
            rows, held = [], 0
    if rows:
        yield batch(rows)


def parsed_regions(text: str) -> dict[str, list[tuple[int, int]]]:
    """'c1,c2:100-200' -> contig: [(start, end)], half-open from 0; a name alone is the whole contig."""
    out: dict[str, list[tuple[int, int]]] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        name, _, span = part.rpartition(":")
        start, dash, end = span.partition("-")
        if name and dash and start.isdigit() and end.isdigit():
            if int(start) >= int(end):
                raise ValueError(f"empty region {part}")
            out.setdefault(name, []).append((int(start), int(end)))
        else:
            out.setdefault(part, []).append((0, 1 << 29))
    return out


class AlignmentReader(DataSourceReader):
    def __init__(self, paths: list[str], regions: dict, split_bytes: int):
        self.paths, self.regions, self.split_bytes = paths, regions, split_bytes

    def partitions(self):
        return [s for p in self.paths for s in shares(p, self.regions, self.split_bytes)] or [Share("")]

    def read(self, partition):
        if partition.path:
            with opened(partition.path) as file:
                yield from batches(partition, file)


class FilteredAlignmentReader(AlignmentReader):
    """Turns filters on contig and pos into regions. Spark checks all filters again."""

    def pushFilters(self, filters):
        names, start, end = None, 0, 1 << 29
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("contig",) and isinstance(f, (EqualTo, In)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                names = own if names is None else names & own
            elif column == ("pos",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                start = max(start, f.value + isinstance(f, GreaterThan))
            elif column == ("pos",) and isinstance(f, (LessThan, LessThanOrEqual)):
                end = min(end, f.value + isinstance(f, LessThanOrEqual))
            elif column == ("pos",) and isinstance(f, EqualTo):
                start, end = max(start, f.value), min(end, f.value + 1)
            yield f
        if names is not None:
            asked = {n: [(start, end)] for n in names if n is not None and start < end}
            if self.regions:
                asked = {n: [(max(a, start), min(b, end)) for a, b in self.regions.get(n, ()) if max(a, start) < min(b, end)] for n in asked}
            self.regions, self.paths = asked, self.paths if any(asked.values()) else []


class AlignmentSource(DataSource):
    """spark.dataSource.register(AlignmentSource); spark.read.format("alignments").option("paths", "a.bam,b.bam").load()

    Options: regions ("c1,c2:100-200": records that overlap any of them), split_bytes (a
    task's share of a file), push_filters ("true": filters on contig and pos become regions; needs
    spark.sql.python.filterPushdown.enabled). An index is looked for as the file's name with .bai; without one
    a region's records are picked from all. input_ord grows along a file.

    With push_filters a loaded frame is for one set of filters: Spark keeps what was pushed into a
    frame, and a later use of the same frame without filters would be given the same rows. Load
    it again, or name regions.
    """

    @classmethod
    def name(cls) -> str:
        return "alignments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> AlignmentReader:
        kind = FilteredAlignmentReader if self.options.get("push_filters", "").lower() == "true" else AlignmentReader
        return kind([p for p in self.options["paths"].split(",") if p], parsed_regions(self.options.get("regions", "")), int(self.options.get("split_bytes", SPLIT_BYTES)))
