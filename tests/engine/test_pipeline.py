import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from strandweave.operators import kmers, pairing, walk
from strandweave.plans import preprocess, somatic
from strandweave.sources import sinks, tables
from strandweave.sources.alignments import AlignmentSource
from strandweave.streaming.pairing import pair_stream

READS = "sample string, contig string, pos int, flag int, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual array<int>, qname string, nm int, ec double, zm bigint, input_ord bigint"
REFERENCE = "ACGTTGCAAC" * 12
OPTIONS = preprocess.Options(min_qlen=10, trim=0, indel_pad=2, mismatch_window=3, min_identity=0.5, max_softclip=0.5)


def read(sample, zm, side, changes=(), pos=0, length=120, mapq=60, bq=93, ordinal=0):
    seq = list(REFERENCE[pos : pos + length])
    for at, base in changes:
        seq[at - pos] = base
    return (sample, "c", pos, 0, mapq, [(0, length)], "".join(seq), [bq] * length, f"m/{zm}/{side}", len(changes), 20.0, zm, ordinal)


@pytest.fixture(scope="module")
def world(spark):
    dnm, grm, single = (50, "T"), (70, "G"), (90, "G")
    assert all(REFERENCE[at] != base for at, base in (dnm, grm, single))
    rows = []
    for sample in ("s1", "s2"):
        for zm in range(1, 5):
            extra = [grm] if zm == 1 else []
            if sample == "s1" and zm == 2:
                extra.append(dnm)
            one = [*extra, single] if sample == "s1" and zm == 3 else extra
            rows += [read(sample, zm, "fwd", one), read(sample, zm, "rev", extra)]
        rows += [read(sample, 9, "fwd"), read(sample, 8, "fwd", mapq=3), read(sample, 8, "rev")]
    reads = spark.createDataFrame(rows, READS)
    reference = kmers.position_contexts(spark.createDataFrame([("c", REFERENCE)], "contig string, seq string"))
    contigs = spark.createDataFrame([("c", len(REFERENCE), 0)], "contig string, length long, idx int")
    return reads, reference, contigs


def test_calls_changes_and_rates(spark, world):
    reads, reference, contigs = world
    called = preprocess.calls(reads, reference, OPTIONS).cache()
    kinds = {(r["sample"], r.zm, r.pos): (r.kind, r.callable) for r in called.where("kind is not null").collect()}
    assert kinds == {("s1", 1, 70): ("x", True), ("s2", 1, 70): ("x", True), ("s1", 2, 50): ("x", True), ("s1", 3, 90): ("m", False)}
    lost = {r.pos for r in called.where("sample = 's1' and zm = 3 and not callable").collect()}
    assert lost == set(range(87, 94))
    report = {(r["sample"], r.reason): r.n for r in preprocess.read_report(reads, OPTIONS).collect()}
    assert report["s1", "mapq"] == 1 and report["s1", "kept"] == 10
    assert {r.zm for r in preprocess.lacking_a_strand(reads, OPTIONS).collect()} == {8, 9}
    mask = spark.createDataFrame([("s1", "c", 0, 5), ("s2", "c", 0, 5)], "sample string, contig string, start int, end int")
    context = preprocess.context(called, reference, mask, OPTIONS).cache()
    assert context.where("sample = 's1'").count() == 120 - 5 - 1 and context.where("start = 50 and sample = 's1'").first().depth == 4
    assert context.where("start = 90 and sample = 's1'").first().depth == 3
    changes = preprocess.changes(called, mask, OPTIONS).cache()
    rows = somatic.annotated(changes, somatic.shared_context(context)).cache()
    assert {(r["sample"], r.pos): r.annotation for r in rows.collect()} == {("s1", 50): "DNM", ("s1", 70): "GRM", ("s2", 70): "GRM", ("s1", 90): "MSM"}
    samples = spark.createDataFrame([("s1", 0), ("s2", 1)], "sample string, ord int")
    told = somatic.checked(rows, reads, samples)
    (dnm,) = told.where("annotation = 'DNM'").collect()
    assert dnm.pos == 50 and dnm.counts[0]["T"] == 0 and sum(dnm.counts[0]) > 0
    rates = {r["sample"]: r for r in somatic.rates(told, context).collect()}
    assert rates["s1"].tot_muts == 1 and rates["s2"].tot_muts == 0 and rates["s2"].poisson_ci_lo == 0
    assert rates["s1"].mut_rate == pytest.approx(1 / rates["s1"].tot_bps) and rates["s1"].poisson_ci_hi == pytest.approx(5.571643 / rates["s1"].tot_bps, rel=1e-6)
    other = reads.where("zm <> 1 or sample <> 's1'").unionByName(spark.createDataFrame([read("s2", 20, "fwd", [(50, "T")])], READS))
    assert somatic.checked(rows, other, samples).where("pos = 50").first().annotation == "FPD"


def test_raw_coverage_and_collapsed(spark, world):
    reads, reference, contigs = world
    raw = {r["sample"]: r for r in preprocess.raw_coverage(reads, contigs, OPTIONS).collect()}
    assert raw["s1"].raw_coverage == 10.0 and raw["s1"].max_depth == 22.65
    assert preprocess.high_coverage(reads, contigs, OPTIONS).count() == 0
    options = preprocess.Options(**{**OPTIONS.__dict__, "collapsed": True})
    called = preprocess.calls(reads, reference, options)
    assert called.where("kind = 'x'").count() == 7 and called.where("kind = 'm'").count() == 0


def test_masked_qualities(spark):
    def masked(ops, length, trim, pad):
        row = spark.createDataFrame([(ops, [9] * length)], "cigar array<struct<op:int,len:int>>, qual array<int>")
        out = row.select(walk.masked_qualities(F.col("qual"), walk.placed_ops(F.col("cigar")), trim, pad).alias("q")).first().q
        return [k for k, q in enumerate(out) if q == 0]

    assert masked([(0, 20), (1, 2), (0, 18)], 40, 0, 10) == list(range(10, 33))
    assert masked([(0, 20), (2, 5), (0, 20)], 40, 0, 10) == list(range(10, 31))
    assert masked([(0, 20), (1, 2), (0, 18)], 40, 0, 0) == [20, 21, 22]
    assert len(masked([(0, 400)], 400, 0.001, 0)) == 400 and masked([(0, 10)], 10, 2, 0) == [0, 1, 8, 9]


def bam_bytes(records):
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 2) + b"c\0" + struct.pack("<i", 120)
    body = b""
    for name, pos, flag, cigar, seq, qual, zm in records:
        packed = bytes("=ACMGRSVTWYHKDBN".index(a) << 4 | ("=ACMGRSVTWYHKDBN".index(b) if b else 0) for a, b in zip(seq[::2], [*seq[1::2], *([""] * (len(seq) % 2))], strict=True))
        tags = b"zmi" + struct.pack("<i", zm) + b"ecf" + struct.pack("<f", 7.5) + b"NMC\2" + b"smBS" + struct.pack("<i2H", 2, 3, 4) + b"rgZab\0"
        one = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | op) for op, n in cigar) + packed + bytes(qual) + tags
        body += struct.pack("<i", len(one)) + one
    whole = head + body
    return b"".join(gzip.compress(whole[k : k + 37]) for k in range(0, len(whole), 37)) + gzip.compress(b"")


def test_alignment_source(spark, tmp_path):
    path = tmp_path / "s1.x.bam"
    path.write_bytes(bam_bytes([("a/1/fwd", 5, 0, [(0, 3), (1, 1), (0, 1)], "ACGTN", [30, 31, 32, 33, 34], 1), ("a/1/rev", 6, 16, [(0, 4)], "GGCC", [255] * 4, 1)]))
    spark.dataSource.register(AlignmentSource)
    one, two = spark.read.format("alignments").option("paths", str(path)).load().orderBy("input_ord").collect()
    assert (one["sample"], one.contig, one.pos, one.seq, one.qual, one.zm, one.nm, one.ec, one.sm) == ("s1", "c", 5, "ACGTN", [30, 31, 32, 33, 34], 1, 2, 7.5, [3, 4])
    assert [tuple(c) for c in one.cigar] == [(0, 3), (1, 1), (0, 1)] and two.qual is None and two.flag == 16 and two.qname == "a/1/rev"


def test_text_sources_and_sinks(spark, tmp_path):
    with gzip.open(tmp_path / "m.bed.gz", "wt") as f:
        f.write("# c\ntrack x\nc\t1\t5\tz\r\nd\t7\t7\n")
    assert [tuple(r) for r in tables.intervals(spark, str(tmp_path / "m.bed.gz")).collect()] == [("c", 1, 5), ("d", 7, 7)]
    (tmp_path / "bad.bed").write_text("c\t5\t1\n")
    with pytest.raises(Exception, match="ends before"):
        tables.intervals(spark, str(tmp_path / "bad.bed")).collect()
    (tmp_path / "r.fa").write_text(">c one\nACgt\nAC\n>d\nNN\n")
    assert {tuple(r) for r in tables.sequences(spark, str(tmp_path / "r.fa")).collect()} == {("c", "ACGTAC"), ("d", "NN")}
    (tmp_path / "r.fai").write_text("c\t6\t7\t4\t5\nd\t2\t20\t2\t3\n")
    assert [tuple(r) for r in tables.sequence_index(spark, str(tmp_path / "r.fai")).collect()] == [("c", 6, 0), ("d", 2, 1)]
    line = "c\t3\t4\t9\tACG\tC\tT:9:1\t.\t0\t0\tx \t7"
    (tmp_path / "s1.muts.bed").write_text("##read_mode=collapsed\n" + line + "\n")
    (row,) = tables.changes(spark, str(tmp_path / "s1.muts.bed")).collect()
    assert (row["sample"], row.pos, row.alt, row.kind, row.depth, row.line) == ("s1", 3, "T", "x", 7, line) and tables.is_collapsed(spark, str(tmp_path / "s1.muts.bed"))
    (tmp_path / "s1.context.bed").write_text("c\t3\t4\tACG\t7\n")
    assert tables.contexts(spark, str(tmp_path / "s1.context.bed")).first().depth == 7
    (tmp_path / "g.tsv").write_text("# x\na.bam\ts1\tg1\nb.bam\ts2\n")
    samples = spark.createDataFrame([("s1",), ("s2",)], "sample string")
    with pytest.raises(Exception, match="no group for sample s2"):
        tables.groups(spark, str(tmp_path / "g.tsv"), samples).collect()
    (tmp_path / "g.tsv").write_text("a.bam\ts1\t g1\nb.bam\ts2\tg2\n")
    assert {tuple(r) for r in tables.groups(spark, str(tmp_path / "g.tsv"), samples).collect()} == {("s1", "g1"), ("s2", "g2")}
    (tmp_path / "g.tsv").write_text("a.bam\ts1\nb.bam\ts2\n")
    assert {tuple(r) for r in tables.groups(spark, str(tmp_path / "g.tsv"), samples).collect()} == {("s1", "all"), ("s2", "all")}
    out = spark.createDataFrame([("c", 2, None), ("c", 1, "x")], "contig string, start int, note string")
    sinks.as_text(out, f"{tmp_path}/out", ["contig", "start", "note"], ["contig", "start"])
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ["c\t1\tx", "c\t2\t"]
    sinks.as_table(out, f"{tmp_path}/table", ["contig", "start"])
    assert spark.read.parquet(f"{tmp_path}/table").count() == 2


def test_streamed_pairs(spark, tmp_path):
    rows = [(1, "fwd", "2024-01-01 00:00:00", 5), (1, "rev", "2024-01-01 00:03:00", 6), (2, "fwd", "2024-01-01 00:00:00", 7), (2, "rev", "2024-01-01 01:00:00", 8)]
    spark.createDataFrame(rows, "zm int, side string, t string, pos int").withColumn("t", F.to_timestamp("t")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("zm int, side string, t timestamp, pos int").parquet(f"{tmp_path}/in")
    query = pair_stream(stream, ["zm"], "side", "fwd", "rev", "t", ["pos"]).writeStream.format("memory").queryName("pairs").outputMode("append").start()
    try:
        query.processAllAvailable()
        assert [(r.zm, r.pos_1, r.pos_2) for r in spark.sql("select * from pairs").collect()] == [(1, 5, 6)]
    finally:
        query.stop()


def test_strands_pair_in_input_order(spark):
    """Against the rule told as a loop over the reads of each key, on random orders of strands."""
    rng = random.Random(4)
    rows = [(key, rng.choice(["fwd", "rev"]), at) for key in range(120) for at in rng.sample(range(50), rng.randint(1, 9))]
    want = set()
    for key in range(120):
        waiting = {}
        for _, side, at in sorted((r for r in rows if r[0] == key), key=lambda r: r[2]):
            waiting[side] = at
            if len(waiting) == 2:
                want.add((key, waiting["fwd"], waiting["rev"]))
                waiting = {}
    numbered = pairing.in_order(spark.createDataFrame(rows, "zm int, strand string, at int"), ["zm"], "strand", "at")
    got = pairing.pair(numbered, ["zm", "mol"], "strand", "fwd", "rev", ["at"]).collect()
    assert {(r.zm, r.at_1, r.at_2) for r in got} == want and len(got) == len(want)
    for key in range(120):
        numbers = [r.mol for r in sorted(got, key=lambda r: max(r.at_1, r.at_2)) if r.zm == key]
        assert numbers == list(range(1, len(numbers) + 1))
