"""Media columns: Matroska (EBML) files held in a binary column.

`packets` turns files into a packet table with timestamps, tracks, lacing
and byte ranges; `cues` lists their seek points. `store` writes payloads as
Matroska PCM audio, `digests` reads stored files back through their packets.
Every row is handled on its own, so nothing shuffles.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Element ids of the Matroska specification (RFC 9559, RFC 8794).
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B, 0x114D9B74, 0x1254C367, 0x1043A770, 0x1941A469
TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID, DEFAULT_DURATION, AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE_BLOCK = 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION, CUE_RELATIVE_POSITION = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1, 0xF0
EBML_VERSION, EBML_READ_VERSION, EBML_MAX_ID, EBML_MAX_SIZE, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ_VERSION = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
LACINGS = ("none", "xiph", "fixed", "ebml")
TOP_LEVEL = frozenset((EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, TAGS, CHAPTERS, ATTACHMENTS))

#: Samples of a unit of stored payload: 24 ms at 8 kHz, one byte each.
UNIT, RATE = 192, 8000
FRAMES_PER_BLOCK, BLOCKS_PER_CLUSTER = 8, 32


class Malformed(ValueError):
    pass


# -- reading ---------------------------------------------------------------


def read_vint(data, at: int, keep_marker: bool = False) -> tuple[int, int]:
    """A variable-length integer at `at`: (value, next position); value -1 means unknown size."""
    if at >= len(data):
        raise Malformed("cut off in a variable-length integer")
    first = data[at]
    width = 9 - first.bit_length()
    if width > 8 or at + width > len(data):
        raise Malformed("bad variable-length integer")
    value = int.from_bytes(data[at : at + width], "big")
    if keep_marker:
        return value, at + width
    value &= (1 << (7 * width)) - 1
    return (-1 if value == (1 << (7 * width)) - 1 else value), at + width


def elements(data, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, start of body, end of body) of the elements in [at, end).

    An element of unknown size reaches to `end`; whoever walks it stops at
    the first element that can't be its child.
    """
    while at < end:
        ident, at = read_vint(data, at, keep_marker=True)
        size, at = read_vint(data, at)
        stop = end if size < 0 else at + size
        if stop > end:
            raise Malformed(f"element {ident:#x} is longer than its parent")
        yield ident, at, stop
        at = stop


def _uint(data, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def _float(data, a: int, b: int) -> float:
    return {0: 0.0, 4: lambda: struct.unpack(">f", data[a:b])[0], 8: lambda: struct.unpack(">d", data[a:b])[0]}[b - a]() if b > a else 0.0


@dataclass
class Track:
    number: int = 0
    kind: int = 0
    codec: str = ""
    default_ns: int = 0
    rate: float = 8000.0
    channels: int = 1
    bits: int = 0

    def pcm_ns(self, size: int) -> int | None:
        """Duration of `size` bytes, if they are uncompressed samples."""
        if self.codec.startswith("A_PCM/") and self.bits and self.rate:
            return round(size * 8 * 1e9 / (self.bits * self.channels * self.rate))
        return None


@dataclass
class Parsed:
    scale: int = 1_000_000
    duration: float = 0.0
    tracks: dict[int, Track] = field(default_factory=dict)
    #: (packet, track, timestamp_ns, duration_ns, cluster, block, lace, lacing, keyframe, offset, size)
    packets: list[tuple] = field(default_factory=list)
    #: (cue, timestamp_ns, track, cluster_offset)
    cues: list[tuple] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    blocks: int = 0
    error: str | None = None


def lace_sizes(data, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    """Frame sizes of a block's body and where the first frame starts."""
    if lacing == 0:
        return [end - at], at
    if at >= end:
        raise Malformed("laced block without a frame count")
    count, at = data[at] + 1, at + 1
    if lacing == 2:
        if (end - at) % count:
            raise Malformed("fixed lacing of unequal frames")
        return [(end - at) // count] * count, at
    sizes: list[int] = []
    for k in range(count - 1):
        if lacing == 1:
            size = 0
            while True:
                if at >= end:
                    raise Malformed("cut off in Xiph lacing")
                size, at, more = size + data[at], at + 1, data[at] == 255
                if not more:
                    break
        else:
            start = at
            value, at = read_vint(data, at)
            if value < 0:  # all ones is an ordinary value in a lace
                value = (1 << 7 * (at - start)) - 1
            size = value if k == 0 else sizes[-1] + value - ((1 << (7 * (at - start) - 1)) - 1)
        if size < 0:
            raise Malformed("negative frame size")
        sizes.append(size)
    last = end - at - sum(sizes)
    if last < 0:
        raise Malformed("frames longer than their block")
    return [*sizes, last], at


def _block(out: Parsed, data, a: int, b: int, cluster_time: int, simple: bool, key: bool, duration: int | None) -> None:
    number, at = read_vint(data, a)
    if at + 3 > b:
        raise Malformed("block without a header")
    relative, flags = int.from_bytes(data[at : at + 2], "big", signed=True), data[at + 2]
    lacing = (flags >> 1) & 3
    sizes, at = lace_sizes(data, at + 3, b, lacing)
    track = out.tracks.get(number) or Track(number)
    ts = (cluster_time + relative) * out.scale
    for k, size in enumerate(sizes):
        length = track.pcm_ns(size) or track.default_ns or (duration * out.scale // len(sizes) if duration else 0)
        out.packets.append((len(out.packets), number, ts, length, len(out.clusters) - 1, out.blocks, k, LACINGS[lacing], bool(flags & 0x80) if simple else key, at, size))
        ts, at = ts + length, at + size
    out.blocks += 1


def _cluster(out: Parsed, data, a: int, b: int) -> int:
    """Where the cluster ends: its stated end, or the first element that isn't its child."""
    time, at = 0, a
    while at < b:
        began = at
        ident, at = read_vint(data, at, keep_marker=True)
        if ident in TOP_LEVEL:
            return began
        size, at = read_vint(data, at)
        stop = b if size < 0 else at + size
        if stop > b:
            raise Malformed("element longer than its cluster")
        if ident == TIMESTAMP:
            time = _uint(data, at, stop)
        elif ident == SIMPLE_BLOCK:
            _block(out, data, at, stop, time, True, True, None)
        elif ident == BLOCK_GROUP:
            body, duration, key = None, None, True
            for x, i, j in elements(data, at, stop):
                if x == BLOCK:
                    body = (i, j)
                elif x == BLOCK_DURATION:
                    duration = _uint(data, i, j)
                elif x == REFERENCE_BLOCK:
                    key = False
            if body:
                _block(out, data, *body, time, False, key, duration)
        at = stop
    return at


def _track(data, a: int, b: int) -> Track:
    t = Track()
    for x, i, j in elements(data, a, b):
        if x == TRACK_NUMBER:
            t.number = _uint(data, i, j)
        elif x == TRACK_TYPE:
            t.kind = _uint(data, i, j)
        elif x == CODEC_ID:
            t.codec = bytes(data[i:j]).rstrip(b"\0").decode("latin-1")
        elif x == DEFAULT_DURATION:
            t.default_ns = _uint(data, i, j)
        elif x == AUDIO:
            for y, k, m in elements(data, i, j):
                if y == SAMPLING_FREQUENCY:
                    t.rate = _float(data, k, m)
                elif y == CHANNELS:
                    t.channels = _uint(data, k, m)
                elif y == BIT_DEPTH:
                    t.bits = _uint(data, k, m)
    return t


def parse(data: bytes | None) -> Parsed:
    """Packets, cues and tracks of one file. What is malformed ends the walk; what came before it is kept."""
    out = Parsed()
    if not data:
        out.error = "empty"
        return out
    try:
        ident, at = read_vint(data, 0, keep_marker=True)
        if ident != EBML:
            raise Malformed("not EBML")
        size, at = read_vint(data, at)
        at += max(size, 0)
        ident, at = read_vint(data, at, keep_marker=True)
        if ident != SEGMENT:
            raise Malformed("no segment")
        size, at = read_vint(data, at)
        base, end = at, len(data) if size < 0 else at + size
        if end > len(data):
            raise Malformed("segment is cut off")
        while at < end:
            began = at
            ident, at = read_vint(data, at, keep_marker=True)
            size, at = read_vint(data, at)
            stop = end if size < 0 else at + size
            if stop > end:
                raise Malformed(f"element {ident:#x} is longer than its parent")
            if ident == INFO:
                for x, i, j in elements(data, at, stop):
                    if x == TIMESTAMP_SCALE:
                        out.scale = _uint(data, i, j)
                    elif x == DURATION:
                        out.duration = _float(data, i, j)
            elif ident == TRACKS:
                for x, i, j in elements(data, at, stop):
                    if x == TRACK_ENTRY:
                        t = _track(data, i, j)
                        out.tracks[t.number] = t
            elif ident == CLUSTER:
                out.clusters.append(began - base)
                stop = _cluster(out, data, at, stop)
            elif ident == CUES:
                for x, i, j in elements(data, at, stop):
                    time, places = 0, []
                    for y, k, m in elements(data, i, j) if x == CUE_POINT else ():
                        if y == CUE_TIME:
                            time = _uint(data, k, m)
                        elif y == CUE_TRACK_POSITIONS:
                            place = {z: _uint(data, p, q) for z, p, q in elements(data, k, m)}
                            places.append((place.get(CUE_TRACK, 0), base + place.get(CUE_CLUSTER_POSITION, 0)))
                    out.cues += [(len(out.cues) + n, time * out.scale, *p) for n, p in enumerate(places)]
            at = stop
    except (Malformed, KeyError, struct.error, IndexError) as error:
        out.error = str(error) or type(error).__name__
    return out


# -- writing ---------------------------------------------------------------


def vint(value: int, width: int = 0) -> bytes:
    while not width or value >= (1 << 7 * width) - 1:
        width += 1
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes], lacing: int) -> bytes:
    """The body of a block after its header."""
    if lacing == 0:
        return frames[0]
    sizes = [len(f) for f in frames]
    head = bytes([len(frames) - 1])
    if lacing == 1:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif lacing == 3:
        for k, n in enumerate(sizes[:-1]):
            if k == 0:
                head += vint(n)
            else:
                step, width = n - sizes[k - 1], 1
                while not -(1 << 7 * width - 1) + 1 <= step < (1 << 7 * width - 1):
                    width += 1
                head += (step + (1 << 7 * width - 1) - 1 | 1 << 7 * width).to_bytes(width, "big")
    return head + b"".join(frames)


def block(track: int, relative: int, lacing: int, frames: list[bytes], key: bool = True) -> bytes:
    return vint(track) + relative.to_bytes(2, "big", signed=True) + bytes([(0x80 if key else 0) | lacing << 1]) + laced(frames, lacing)


_HEADER = element(EBML, b"".join((uint(EBML_VERSION, 1), uint(EBML_READ_VERSION, 1), uint(EBML_MAX_ID, 4), uint(EBML_MAX_SIZE, 8), element(DOC_TYPE, b"matroska"), uint(DOC_TYPE_VERSION, 4), uint(DOC_TYPE_READ_VERSION, 2))))
_TRACKS = element(
    TRACKS,
    element(TRACK_ENTRY, b"".join((uint(TRACK_NUMBER, 1), uint(TRACK_UID, 1), uint(TRACK_TYPE, 2), uint(FLAG_LACING, 1), element(CODEC_ID, b"A_PCM/INT/LIT"), element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", RATE)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))))),
)


def _blocks(payload: bytes) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first unit, lacing, frames): the lacings take turns; Xiph and EBML lace frames of one, two and three units."""
    units, at, turn = len(payload) // UNIT, 0, 0
    while at < units:
        began, lacing, frames = at, (2, 1, 3, 0)[turn % 4], []
        for k in range(1 if lacing == 0 else FRAMES_PER_BLOCK):
            n = min(units - at, 1 if lacing in (0, 2) else 1 + k % 3)
            if n:
                frames.append(payload[at * UNIT : (at + n) * UNIT])
                at += n
        yield began, lacing if len(frames) > 1 else 0, frames
        turn += 1


def write(payload: bytes) -> bytes:
    """payload (a multiple of UNIT bytes) as 8-bit PCM in Matroska, with clusters and cues."""
    ms = UNIT * 1000 // RATE
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)) + element(MUXING_APP, b"strandweave") + element(WRITING_APP, b"strandweave"))
    body, cues = [info, _TRACKS], []
    size, held, start = len(info) + len(_TRACKS), [], 0

    def close() -> None:
        nonlocal size, held
        if held:
            cluster = element(CLUSTER, uint(TIMESTAMP, start * ms) + b"".join(held))
            cues.append(element(CUE_POINT, uint(CUE_TIME, start * ms) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, size))))
            body.append(cluster)
            size += len(cluster)
            held = []

    for unit, lacing, frames in _blocks(payload):
        if len(held) == BLOCKS_PER_CLUSTER:
            close()
        if not held:
            start = unit
        held.append(element(SIMPLE_BLOCK, block(1, (unit - start) * ms, lacing, frames)))
    close()
    body.append(element(CUES, b"".join(cues)))
    return _HEADER + element(SEGMENT, b"".join(body))


# -- columns ---------------------------------------------------------------

PACKETS = "packet int, track int, timestamp_ns long, duration_ns long, cluster int, block int, lace int, lacing string, keyframe boolean, offset long, size long"
CUES_SCHEMA = "cue int, timestamp_ns long, track int, cluster_offset long"
DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_tracks int, n_clusters int, n_packets int, n_cues int, error string"
#: Arrow batches are sent on when they hold so many bytes.
FLUSH = 16 << 20


def payload_of(text: bytes) -> bytes:
    """text and spaces up to a positive multiple of UNIT."""
    return text + b" " * ((-len(text)) % UNIT if text else UNIT)


def store(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """ident, n_bytes, media: each whole text in UTF-8, padded, as a Matroska file.

    Null is empty; texts of any length are stored whole, a file each. Repeated rows and null
    idents give rows of their own, no rows give none. Other columns are not touched, whatever their names.
    """
    narrow = docs.select(F.col(ident).alias("__id"), F.col(text).cast("string").alias("__text"))

    def run(batches):
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            at, held, media, sizes = 0, 0, [], []
            for k in range(len(batch)):
                raw = texts[k].as_py() or b""
                media.append(write(payload_of(raw)))
                sizes.append(len(raw))
                held += len(media[-1])
                if held >= FLUSH or k + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(media)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["__id", "n_bytes", "media"])
                    at, held, media, sizes = k + 1, 0, [], []

    return narrow.mapInArrow(run, f"__id {narrow.schema['__id'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("__id", ident)


def _exploded(files: DataFrame, media: str, ident: str, schema: str, rows_of) -> DataFrame:
    narrow = files.select(F.col(ident).alias("__id"), F.col(media).cast("binary").alias("__media"))
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):  # a batch a file: files can be long
                rows = rows_of(batch.column(1)[k].as_py())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * len(rows), batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=["__id", *names])

    return narrow.mapInArrow(run, f"__id {narrow.schema['__id'].dataType.simpleString()}, {schema}").withColumnRenamed("__id", ident)


def packets(files: DataFrame, media: str = "media", ident: str = "doc_id") -> DataFrame:
    """The packet table: one row per frame, with its byte range in the file.

    Null, empty and foreign files have no packets; a damaged file has those
    before the damage. Repeated rows give repeated packets. Files are walked whole, one at
    a time. Other columns are not touched, whatever their names.
    """
    return _exploded(files, media, ident, PACKETS, lambda data: parse(data).packets)


def cues(files: DataFrame, media: str = "media", ident: str = "doc_id") -> DataFrame:
    """The seek points: cue, timestamp, track and the cluster's place in the file."""
    return _exploded(files, media, ident, CUES_SCHEMA, lambda data: parse(data).cues)


def feature(payload: bytes, found: Parsed) -> str:
    """Level, crossings and entropy of the samples, and the shape of the stream."""
    samples = np.frombuffer(payload, np.uint8)
    if not len(samples):
        return "none"
    share = np.bincount(samples, minlength=256) / len(samples)
    share = share[share > 0]
    centred = samples.astype(np.int16) - 128
    rms, crossings = math.sqrt(float(np.mean(np.square(centred, dtype=np.int64)))), int(np.count_nonzero((centred[1:] < 0) != (centred[:-1] < 0)))
    laces = "/".join(str(sum(p[7] == x for p in found.packets)) for x in LACINGS)
    return f"rms={rms:.4f};zc={crossings};entropy={-float((share * np.log2(share)).sum()):.4f};packets={laces};clusters={len(found.clusters)};cues={len(found.cues)};ms={sum(p[3] for p in found.packets) // 1_000_000}"


def digests(files: DataFrame, media: str = "media", ident: str = "doc_id", n_bytes: str = "n_bytes") -> DataFrame:
    """One row per file: hashes of the payload read back through its packets, and features.

    A file that isn't Matroska has an empty payload and says why in error; so do null and
    empty ones. Files of any length are read whole. Repeated rows give repeated rows, no rows
    none. Other columns are not touched, whatever their names.
    """
    narrow = files.select(F.col(ident).alias("__id"), F.col(n_bytes).cast("long").alias("__n"), F.col(media).cast("binary").alias("__media"))

    def one(data: bytes | None) -> tuple:
        data = data or b""
        found = parse(data)
        payload = b"".join(data[p[9] : p[9] + p[10]] for p in found.packets)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature(payload, found), len(found.tracks), len(found.clusters), len(found.packets), len(found.cues), found.error

    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = ["__id", *(c.split()[0] for c in DIGEST.split(", "))]

    def run(batches):
        for batch in batches:
            rows = [one(batch.column(2)[k].as_py()) for k in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=names)

    return narrow.mapInArrow(run, f"__id {narrow.schema['__id'].dataType.simpleString()}, {DIGEST}").withColumnRenamed("__id", ident)
