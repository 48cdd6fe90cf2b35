"""Change tables, the table of 96 types and reports, written as text and read back."""

import json

import pytest
from pyspark.sql import functions as F

from strandweave.functions.genomes import PRESETS, preset
from strandweave.operators import kmers, pairing
from strandweave.plans import corrected, preprocess, somatic
from strandweave.sources import sinks, tables
from tests.engine.test_pipeline import OPTIONS, READS, REFERENCE, read, world  # noqa: F401

READS_SM = READS + ", sm array<int>"


@pytest.fixture(scope="module")
def called(spark):
    rows = []
    for sample in ("s1", "s2"):
        for zm in (1, 2, 3):
            extra = [(50, "T")] if sample == "s1" and zm < 3 else []
            rows += [(*read(sample, zm, side, extra, ordinal=k), [k + 3] * 120) for k, side in enumerate(("fwd", "rev"))]
    reads = spark.createDataFrame(rows, READS_SM)
    reference = kmers.position_contexts(spark.createDataFrame([("c", REFERENCE)], "contig string, seq string"))
    calls = preprocess.calls(reads, reference, OPTIONS)
    mask = spark.createDataFrame([], "sample string, contig string, start int, end int")
    return reads, reference, calls, preprocess.changes(calls, mask, OPTIONS), preprocess.context(calls, reference, mask, OPTIONS)


def test_change_table_round_trip(spark, called, tmp_path):
    _, _, _, changes, context = called
    rows = somatic.annotated(changes, somatic.shared_context(context))
    line = sinks.change_rows(changes.where("zm = 1")).drop("sample").first()
    strand = "T:93:50:20:{}:120:0.992:93.0:0.0"
    assert tuple(line) == ("c", 50, 51, "1", REFERENCE[49:52], REFERENCE[50], strand.format(3), strand.format(4), 0, 0, "x", 3)
    out = sinks.shared_rows(rows).where("sample = 's1'")
    sinks.as_headed_text(out, f"{tmp_path}/s1.shared.bed", ["##sample=s1", "#CONTIG\tSTART"], tables.SHARED_COLUMNS, ["contig", "start", "zm"])
    text = [r.value for r in spark.read.text(f"{tmp_path}/s1.shared.bed").collect()]
    assert text[:2] == ["##sample=s1", "#CONTIG\tSTART"] and len(text) == 4
    back = tables.changes(spark, f"{tmp_path}/s1.shared.bed")
    got = [(r.pos, r.zm, r.alt, r.strand_2, r.kind, r.depth, r.shared, r.annotation, r.counts) for r in back.orderBy("zm").collect()]
    assert got == [(50, str(zm), "T", strand.format(4), "x", 3, "0", "DNM", ".") for zm in (1, 2)]
    somatic_rows = corrected.somatic_changes(back)
    table = corrected.table96(somatic_rows, context.where("sample = 's1'"), preset(spark, "GRCm39"))
    found = {r.sbs96: r for r in table.collect()}
    assert len(found) == 96 and sum(r.counts for r in found.values()) == 1  # two molecules of one change
    assert sum(r.normfrac for r in found.values()) == pytest.approx(1) and {r.human_tri_count for r in found.values()} == set(PRESETS["GRCh38"].values())
    corrected.write(table, f"{tmp_path}/s1.norm.tsv", "# made by a test")
    lines = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/s1.norm.tsv").collect()]
    assert lines[1] == list(corrected.COLUMNS) and [x[2] for x in lines[2:]] == [r.sbs96 for r in table.orderBy("ord").collect()]
    spectra = {r.sbs96: r.value for r in tables.spectra(spark, f"{tmp_path}/s1.norm.tsv").collect()}
    assert spectra == {k: r.normcounts for k, r in found.items()}
    with pytest.raises(ValueError):
        corrected.write(table, f"{tmp_path}/x", "no remark")


def test_tables_without_annotation_and_second_strands(spark, tmp_path):
    short = "c\t3\t4\t9\tACG\tC\tT:9\t.\t0\t0\tx\t7\tDNM"
    second = "c\t3\t4\t9\tACG\tC\t.\tA:9\t0\t0\tx\t7\t0\tDNM"
    other = "c\t5\t6\t9\tACG\tC\tA:9\t.\t0\t0\tx\t7\t1\tGRM\t."
    (tmp_path / "s.bed").write_text("\n".join([short, second, other]) + "\n")
    assert [(r.start, r.alt) for r in corrected.somatic_changes(tables.changes(spark, str(tmp_path / "s.bed"))).collect()] == [(3, "A")]


def test_corrected_values(spark):
    """Two contexts by hand: ACA seen in 3 of 4 called bases, TCT in 1 of 4; a genome half and half."""
    changes = spark.createDataFrame([("c", 1, 2, "C", "T", "ACA"), ("c", 5, 6, "G", "A", "AGA")], "contig string, start int, end int, ref string, alt string, tri string")
    context = spark.createDataFrame([("ACA", 3), ("TCT", 1), ("NNA", 9)], "tri string, depth int")
    genome = spark.createDataFrame([("ACA", 50), ("TCT", 50)], "tri string, n long")
    rows = {r.sbs96: r.asDict() for r in corrected.table96(changes, context, genome).collect()}
    one, two = rows["A[C>T]A"], rows["T[C>T]T"]
    assert (one["normcounts"], two["normcounts"]) == pytest.approx((0.5 / 0.75, 0.5 / 0.25)) and one["frac"] == 0.5
    assert (one["normcounts_new"], one["freq_G(c)_new/freq_C(c)"], one["freq_C(c)"]) == pytest.approx((0.5 / 0.75, 0.5 / 0.75, 0.75))
    total = sum(PRESETS["GRCh38"].values())
    assert one["Human_normcounts"] == pytest.approx(PRESETS["GRCh38"]["ACA"] / total / 0.75)
    assert rows["A[C>T]C"]["normcounts"] == 0 and rows["A[C>T]C"]["freq_G/freq_C(c)"] == 0 and one["sub"] == "C>T" and one["duplex_callable_tri_count"] == 3


def test_presets(spark):
    assert {r.tri: r.n for r in preset(spark, "GRCm39").collect()} == PRESETS["GRCm39"] and all(len(p) == 32 for p in PRESETS.values())
    assert sum(PRESETS["GRCh38"].values()) == 3_136_815_317
    with pytest.raises(ValueError, match="GRCh38"):
        preset(spark, "T2T")


def test_metrics(spark, world):  # noqa: F811
    reads, reference, contigs = world
    reads = reads.withColumn("input_ord", F.monotonically_increasing_id())
    called = preprocess.calls(reads, reference, OPTIONS)
    report = preprocess.metrics(reads, called, contigs, OPTIONS)
    row = report.where("sample = 's1'").first()
    assert (row.num_reads, row.num_zmw, row.num_discarded, row.disc_mapq_qual, row.disc_lack_compl) == (11, 4, 3, 1, 2)
    assert (row.pct_zmw, row.pct_discarded, row.pct_mapq_qual, row.pct_lack_compl) == (72.72, 27.27, 33.33, 66.67)
    assert row.coverage == round(row.callable_bps / 120, 2) and row.total_length_ref == 120
    told = json.loads(preprocess.metrics_json(report).where("sample = 's1'").first().json)
    assert told["num_zmw"] == 4 and told["sample"] == "s1"
    (lines,) = [sinks.report_lines(report.where("sample = 's2'"))]
    assert any(x.split() == ["num_zmw", "4"] for x in lines)
    empty = preprocess.metrics(reads.limit(0), called.limit(0), contigs, OPTIONS)
    assert empty.count() == 0


def test_collapsed_change_rows(spark, called):
    reads, reference, _, _, _ = called
    options = preprocess.Options(**{**OPTIONS.__dict__, "collapsed": True})
    calls = preprocess.calls(reads.drop("sm"), reference, options)
    mask = spark.createDataFrame([], "sample string, contig string, start int, end int")
    row = sinks.change_rows(preprocess.changes(calls, mask, options)).orderBy("zm").first()
    assert (row.zm, row.strand_1, row.strand_2, row.nob, row.n_mis) == ("m/1/fwd", "T:93:50:20:.:120:0.992:93.0:0.0", ".", 0, 0)


def test_still_waiting(spark):
    rows = [(1, "fwd", 1), (1, "rev", 2), (2, "fwd", 1), (3, "fwd", 1), (3, "rev", 2), (3, "rev", 3), (4, "fwd", 1), (4, "fwd", 2), (4, "rev", 3)]
    got = pairing.still_waiting(spark.createDataFrame(rows, "zm int, side string, at int"), ["zm"], "side", "at").collect()
    assert {r.zm for r in got} == {2, 3}


def test_sequences_in_pieces(spark, tmp_path):
    """Pieces of any size give the composition and the contexts of whole contigs."""
    contigs = {"c": REFERENCE + "NacgtRYAC", "d": "AC", "e": "G" * 31 + "T" * 29}
    body, index = "", ""
    for name, seq in contigs.items():
        body += f">{name} x\n"
        index += f"{name}\t{len(seq)}\t{len(body)}\t10\t11\n"
        body += "".join(seq[k : k + 10] + "\n" for k in range(0, len(seq), 10))
    (tmp_path / "r.fa").write_text(body)
    (tmp_path / "r.fa.fai").write_text(index)
    whole = tables.sequences(spark, f"{tmp_path}/r.fa")
    want = {tuple(r) for r in kmers.position_contexts(whole).collect()}
    counted = {tuple(r) for r in kmers.composition(whole).collect()}
    for size, path in ((2, f"{tmp_path}/r.fa"), (7, f"file://{tmp_path}/r.fa"), (1000, f"{tmp_path}/r.fa")):
        pieces = tables.sequence_chunks(spark, path, f"{tmp_path}/r.fa.fai", size, 8)
        got = kmers.position_contexts(pieces).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) == sum(map(len, contigs.values()))
        assert {tuple(r) for r in kmers.chunk_composition(pieces).collect()} == counted
    with pytest.raises(ValueError):
        tables.sequence_chunks(spark, "x", f"{tmp_path}/r.fa.fai", 1)


def test_manifest(spark):
    rows = tables.manifest(spark, ["/x/b.muts.bed", "/x/a.muts.bed", "/x/b.muts.bed"], ["b.bam", "a.bam", "b.bam"]).collect()
    assert [tuple(r) for r in rows] == [("b", 0, "/x/b.muts.bed", "b.bam"), ("a", 1, "/x/a.muts.bed", "a.bam")]
    assert tables.manifest(spark, ["/x/b.bed"]).first().alignments is None
    for bad in ((["a.bed"], []), (["a.bed", "a.bed"], ["a.bam", "b.bam"])):
        with pytest.raises(ValueError):
            tables.manifest(spark, *bad)
