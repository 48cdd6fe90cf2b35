import hashlib
import random
import struct
import zlib

import pytest

from strandweave.llm import matroska as m

from .helpers import docs


@pytest.mark.parametrize("size", [0, 1, 191, 192, 193, 5000, 250_000])
def test_round_trip(size):
    payload = m.payload_of(random.Random(size).randbytes(size))
    assert len(payload) % m.UNIT == 0 and len(payload) >= m.UNIT
    data = m.write(payload)
    found = m.parse(data)
    assert found.error is None and b"".join(data[p[9] : p[9] + p[10]] for p in found.packets) == payload
    times = [p[2] for p in found.packets]
    assert times == sorted(times) and times[0] == 0 and sum(p[3] for p in found.packets) == len(payload) * 1_000_000_000 // m.RATE
    assert len(found.cues) == len(found.clusters)
    assert all(data[c[3] : c[3] + 4] == m.CLUSTER.to_bytes(4, "big") for c in found.cues)
    assert [c[1] for c in found.cues] == [next(p[2] for p in found.packets if p[4] == k) for k in range(len(found.clusters))]


@pytest.mark.parametrize("lacing", [1, 2, 3])
def test_lacing(lacing):
    rng = random.Random(lacing)
    for _ in range(50):
        n = rng.randint(2, 20)
        sizes = [rng.choice([3, 255, 256, 300, 5000]) if lacing != 2 else 40 for _ in range(n)]
        frames = [rng.randbytes(s) for s in sizes]
        body = m.laced(frames, lacing)
        got, at = m.lace_sizes(body, 0, len(body), lacing)
        assert got == sizes and body[at:] == b"".join(frames)


def test_integers():
    for value in (0, 1, 126, 127, 128, 16_382, 16_383, 1 << 30, (1 << 56) - 2):
        data = m.vint(value)
        assert m.read_vint(data, 0) == (value, len(data))
    assert m.read_vint(b"\xff", 0)[0] == -1
    with pytest.raises(m.Malformed):
        m.read_vint(b"\x00", 0)


def test_unknown_sizes_groups_and_damage():
    frames = [b"abc", b"defg"]
    group = m.element(m.BLOCK_GROUP, m.element(m.BLOCK, m.block(2, -5, 1, frames, False)) + m.uint(m.BLOCK_DURATION, 40) + m.uint(m.REFERENCE_BLOCK, 1))
    cluster = m.CLUSTER.to_bytes(4, "big") + b"\xff" + m.uint(m.TIMESTAMP, 100) + group
    track = m.element(m.TRACKS, m.element(m.TRACK_ENTRY, m.uint(m.TRACK_NUMBER, 2) + m.uint(m.TRACK_TYPE, 1) + m.element(m.CODEC_ID, b"V_X")))
    data = m._HEADER + m.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + track + cluster + cluster
    found = m.parse(data)
    assert found.error is None and len(found.clusters) == 2 and len(found.packets) == 4
    assert [(p[1], p[2], p[3], p[8], p[10]) for p in found.packets[:2]] == [(2, 95_000_000, 20_000_000, False, 3), (2, 115_000_000, 20_000_000, False, 4)]
    whole = m.write(b"x" * m.UNIT * 700)
    cut = m.parse(whole[: len(whole) // 2])
    assert cut.error and m.parse(b"junk").error and m.parse(None).error and m.parse(whole[:3]).error
    damaged = m.element(m.SEGMENT, track + m.element(m.CLUSTER, m.uint(m.TIMESTAMP, 0) + group) + b"\x1f\x43\xb6\x75\x10\x7f\xff\xff")
    found = m.parse(m._HEADER + damaged)
    assert found.error and len(found.packets) == 2
    assert struct.pack(">d", found.duration) == struct.pack(">d", 0.0)


BY_HAND = bytes.fromhex(
    "1A45DFA3 84 42868101"  # EBML, 4 bytes: EBMLVersion 1
    "18538067 01FFFFFFFFFFFFFF"  # Segment of unknown size
    "1549A966 87 2AD7B1830F4240"  # Info: TimestampScale 1,000,000
    "1654AE6B 90 AE 8E D78101 838102 23E38384 01312D00"  # Tracks: number 1, audio, DefaultDuration 20 ms
    "1F43B675 B8 E78203E8"  # Cluster at 1000
    "A386 81 000A 80 4142"  # SimpleBlock at +10, keyframe, no lacing: AB
    "A38D 81 001E 02 02 02 01 616162636363"  # at +30, Xiph lacing, 3 frames of 2, 1 and the rest: aa b ccc
    "A390 81 0050 06 02 83 BE 7878787979 7A7A7A7A"  # at +80, EBML lacing, 3 frames of 3, 3 - 1 and the rest: xxx yy zzzz
    "A389 81 FFF6 04 01 6D6D6E6E"  # at -10, fixed lacing, 2 frames: mm nn
    "1C53BB6B 8E BB 8C B38203E8 B7 86 F78101 F18121"  # Cues: 1000, track 1, cluster 33 bytes into the segment
)


def test_bytes_by_hand_from_the_specification(spark):
    """Not by the writer of this module: every byte is told by the published format."""
    want = [
        (1010, 0, 0, "none", True, b"AB"),
        (1030, 1, 0, "xiph", False, b"aa"), (1050, 1, 1, "xiph", False, b"b"), (1070, 1, 2, "xiph", False, b"ccc"),
        (1080, 2, 0, "ebml", False, b"xxx"), (1100, 2, 1, "ebml", False, b"yy"), (1120, 2, 2, "ebml", False, b"zzzz"),
        (990, 3, 0, "fixed", False, b"mm"), (1010, 3, 1, "fixed", False, b"nn"),
    ]
    files = spark.createDataFrame([(1, BY_HAND, "x"), (2, BY_HAND[:120], "x"), (3, None, "x"), (4, b"", "x")], "doc_id long, media binary, packet string")
    got = m.packets(files).where("doc_id = 1").orderBy("packet").collect()
    assert [(r.timestamp_ns // 10**6, r.block, r.lace, r.lacing, r.keyframe, BY_HAND[r.offset : r.offset + r.size]) for r in got] == want
    assert all((r.track, r.cluster, r.duration_ns) == (1, 0, 20_000_000) for r in got)
    (cue,) = m.cues(files).where("doc_id = 1").collect()
    assert (cue.cue, cue.timestamp_ns, cue.track) == (0, 10**9, 1) and BY_HAND[cue.cluster_offset : cue.cluster_offset + 4] == bytes.fromhex("1F43B675")
    assert m.packets(files).where("doc_id = 2").count() == 9 and m.packets(files).where("doc_id > 2").count() == 0
    told = {r.doc_id: r for r in m.digests(files.selectExpr("doc_id", "media", "3L as n_bytes", "packet as feature")).collect()}
    body = b"".join(w[-1] for w in want)
    assert told[1].payload_sha256 == hashlib.sha256(body).hexdigest() and told[1].tail_crc32 == zlib.crc32(body[-16:]) and told[1].error is None and told[4].error and told[2].error


def test_feature_by_a_plain_loop():
    import math

    payload = m.payload_of("Some plain text, é.\n".encode() * 90)
    data = m.write(payload)
    found = m.parse(data)
    centred = [b - 128 for b in payload]
    share = [payload.count(bytes([b])) / len(payload) for b in set(payload)]
    crossings = sum((x < 0) != (y < 0) for x, y in zip(centred, centred[1:], strict=False))
    kinds = "/".join(str(sum(p[7] == k for p in found.packets)) for k in ("none", "xiph", "fixed", "ebml"))
    want = f"rms={math.sqrt(sum(x * x for x in centred) / len(centred)):.4f};zc={crossings};entropy={-sum(s * math.log2(s) for s in share):.4f};packets={kinds};clusters={len(found.clusters)};cues={len(found.cues)};ms={len(payload) // 8}"
    assert m.feature(payload, found) == want


def test_columns(spark):
    rows = [(1, None), (2, ""), (3, "héllo"), (3, "héllo"), (None, "x" * 400_000), (4, " " * 192)]
    stored = m.store(docs(spark, rows))
    got = m.digests(stored).collect()
    assert len(got) == 6
    for r in got:
        text = dict(rows).get(r.doc_id) or ""
        raw = text.encode()
        payload = raw + b" " * ((-len(raw)) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.error) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), None)
    by = {r.doc_id: r for r in got}
    assert by[1].media_sha256 == by[2].media_sha256 and by[1].feature == by[2].feature
    table = m.packets(stored.where("doc_id = 4")).collect()
    assert len(table) == 1 and table[0].lacing == "none" and table[0].size == 192 and m.cues(stored.where("doc_id = 4")).count() == 1
    assert m.digests(m.store(docs(spark, []))).count() == 0 and m.packets(m.store(docs(spark, []))).count() == 0
