"""From aligned reads to callable positions and classified base changes.

Everything is a column expression or a join: reads explode to their aligned
bases, the two strands of a molecule meet on the reference position, and
one CASE classifies what they say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dna import round_half_even
from .band import within
from .filters import EQ, I, D, M, N, S, X, identity
from .pairing import in_order, pair, strand

QUERY_OPS, REFERENCE_OPS, BLOCK_OPS = (M, I, S, EQ, X), (M, D, N, EQ, X), (M, EQ, X)


def placed_ops(cigar: Column) -> Column:
    """array<struct<op,len,r,q>>: each operation with its offset on the reference and in the query."""
    start = F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.array().cast("array<struct<op:int,len:int,r:int,q:int>>").alias("out"))

    def step(state, o):
        grown = F.concat(state["out"], F.array(F.struct(o["op"].cast("int").alias("op"), o["len"].cast("int").alias("len"), state["r"].alias("r"), state["q"].alias("q"))))
        return F.struct(
            (state["r"] + F.when(o["op"].isin(*REFERENCE_OPS), o["len"]).otherwise(0)).cast("int").alias("r"),
            (state["q"] + F.when(o["op"].isin(*QUERY_OPS), o["len"]).otherwise(0)).cast("int").alias("q"),
            grown.alias("out"),
        )

    return F.aggregate(cigar, start, step, lambda s: s["out"])


def trimmed_bases(length: Column, trim: float) -> Column:
    """How many bases the end trim takes; null if all of them (a share that rounds to none)."""
    if trim < 0:
        raise ValueError("trim is not negative")
    if trim == 0:
        return F.lit(0)
    if trim >= 1:
        return F.lit(int(trim))
    share = F.rint(length * F.lit(float(trim))).cast("int")
    return F.when(share > 0, share)


def masked_qualities(qual: Column, ops: Column, trim: float = 50, indel_pad: int = 10) -> Column:
    """Base qualities with zeros at the read's ends and around insertions and deletions (bounds included)."""
    n = trimmed_bases(F.size(qual), trim)
    indels = F.filter(ops, lambda o: o["op"].isin(I, D))

    def masked(q, i):
        at_end = F.coalesce((i < n) | (i >= F.size(qual) - n), F.lit(True))
        near = F.exists(indels, lambda o: (i >= o["q"] - indel_pad) & (i <= o["q"] + indel_pad + F.when(o["op"] == I, o["len"]).otherwise(0)))
        return F.when(at_end | near, F.lit(0)).otherwise(q)

    return F.transform(qual, masked)


def aligned_bases(reads: DataFrame, keep: list[str], trim: float = 50, indel_pad: int = 10, window: int = 20) -> DataFrame:
    """keep, pos, base, bq, qpos, bq_mean, bq_sd, qlen, sim, sm, start, end: a row for each base aligned to the reference.

    bq_mean and bq_sd are over the masked qualities within `window` of the
    base in the read, rounded to 2 places. sim is the read's identity, sm the passes
    that support the base; null for reads without nm or sm.
    """
    prepared = reads.withColumn("__ops", placed_ops(F.col("cigar"))).withColumn("__bq", masked_qualities(F.col("qual"), F.col("__ops"), trim, indel_pad))
    span = F.aggregate(F.filter("cigar", lambda o: o["op"].isin(*REFERENCE_OPS)), F.lit(0), lambda t, o: t + o["len"])
    prepared = prepared.withColumn("start", F.col("pos")).withColumn("end", F.col("pos") + span).withColumn("qlen", F.length("seq")).withColumn("__bases", F.split("seq", ""))
    prepared = prepared.withColumn("sim", identity() if "nm" in reads.columns else F.lit(None).cast("double"))
    prepared = prepared.withColumn("__sm", F.col("sm").cast("array<int>") if "sm" in reads.columns else F.lit(None).cast("array<int>"))
    blocks = prepared.select(*keep, "start", "end", "qlen", "sim", "__sm", "__bq", "__bases", F.explode(F.filter("__ops", lambda o: o["op"].isin(*BLOCK_OPS))).alias("o"))
    bases = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("o.len") - 1)).alias("k")).where("o.len > 0").withColumn("qpos", F.col("o.q") + F.col("k"))
    around = F.slice(F.col("__bq"), F.greatest(F.col("qpos") - window, F.lit(0)) + 1, F.least(F.col("qpos") + window, F.col("qlen") - 1) - F.greatest(F.col("qpos") - window, F.lit(0)) + 1)
    total = F.aggregate(around, F.lit(0.0), lambda t, q: t + q)
    squares = F.aggregate(around, F.lit(0.0), lambda t, q: t + q * q)
    mean = total / F.size(around)
    deviation = F.sqrt(F.greatest(squares / F.size(around) - mean * mean, F.lit(0.0)))
    return bases.select(
        *keep,
        "start",
        "end",
        "qlen",
        "sim",
        F.get("__sm", F.col("qpos")).alias("sm"),
        (F.col("start") + F.col("o.r") + F.col("k")).alias("pos"),
        F.element_at("__bases", F.col("qpos") + 1).alias("base"),
        F.element_at("__bq", F.col("qpos") + 1).alias("bq"),
        "qpos",
        round_half_even(mean, 2).alias("bq_mean"),
        round_half_even(deviation, 2).alias("bq_sd"),
    )


def duplex_bases(reads: DataFrame, reference: DataFrame, trim: float = 50, indel_pad: int = 10, window: int = 20) -> DataFrame:
    """Bases that both strands of a molecule align to one position, with ref and tri (null at a contig's edges).

    reads: sample, contig, zm, qname, input_ord and the alignment columns,
    already filtered. Reads pair in input order (`pairing.in_order`): a zm
    may have several molecules, numbered by mol.
    reference: contig, pos, ref, tri.
    """
    sided = in_order(reads.withColumn("strand", strand(F.col("qname"))), ["sample", "contig", "zm"], "strand", "input_ord")
    bases = aligned_bases(sided, ["sample", "contig", "zm", "mol", "strand", "ec"], trim, indel_pad, window)
    met = pair(bases, ["sample", "contig", "zm", "mol", "pos"], "strand", "fwd", "rev", ["base", "bq", "qpos", "bq_mean", "bq_sd", "qlen", "sim", "sm", "start", "end", "ec"])
    return met.join(reference.select("contig", "pos", "ref", "tri"), ["contig", "pos"])


def classify_duplex(bases: DataFrame, min_bq: int = 93, window: int = 20, z_share: int = 0) -> DataFrame:
    """bases with kind (x, m, z or null), callable, n_mis, nob.

    x: both strands agree on a change. m: one strand disagrees with the
    reference. z: one reference position in z_share, picked by a hash, so the
    same ones in every run. Positions within `window` of an m of their
    molecule are not callable; records there stay, with n_mis > 0.
    """
    good = (F.least("bq_1", "bq_2") >= min_bq) if min_bq else F.lit(True)
    one, two = F.col("base_1") == F.col("ref"), F.col("base_2") == F.col("ref")
    picked = (F.pmod(F.xxhash64("sample", "contig", "zm", "pos"), F.lit(z_share)) == 0) if z_share else F.lit(False)
    agreed = good & ~one & ~two & (F.col("base_1") == F.col("base_2")) & (F.col("ref") != "N")
    kind = F.when(good & (one != two), "m").when(agreed, "x").when(good & one & two & picked, "z")
    marked = bases.withColumn("kind", kind).withColumn("__context", (good & one & two) | agreed)
    near = within(F.col("kind") == "m", ["sample", "contig", "zm", "mol"], F.col("pos"), window)
    marked = marked.withColumn("__near", near)
    return marked.select(
        *bases.columns,
        "kind",
        (F.col("__context") & (F.col("__near") == 0)).alias("callable"),
        (F.col("__near") - F.when((F.col("kind") == "m") & F.lit(window >= 0), 1).otherwise(0)).alias("n_mis"),
        (F.abs(F.col("start_1") - F.col("start_2")) + F.abs(F.col("end_1") - F.col("end_2"))).alias("nob"),
    )


def classify_collapsed(reads: DataFrame, reference: DataFrame, min_bq: int = 93, trim: float = 50, indel_pad: int = 10, window: int = 20, z_share: int = 0) -> DataFrame:
    """The same from reads that stand for both strands: no m, nothing blacklisted, n_mis and nob 0."""
    bases = aligned_bases(reads, ["sample", "contig", "zm", "qname", "ec"], trim, indel_pad, window)
    met = bases.join(reference.select("contig", "pos", "ref", "tri"), ["contig", "pos"])
    good = F.col("bq") >= min_bq
    same = F.col("base") == F.col("ref")
    changed = good & ~same & (F.col("base") != "N") & (F.col("ref") != "N")
    picked = (F.pmod(F.xxhash64("sample", "contig", "qname", "pos"), F.lit(z_share)) == 0) if z_share else F.lit(False)
    kind = F.when(changed, "x").when(good & same & picked, "z")
    return met.withColumn("kind", kind).withColumn("callable", changed | (good & same)).withColumn("n_mis", F.lit(0).cast("long")).withColumn("nob", F.lit(0))


def strand_call(suffix: str = "") -> Column:
    """What one strand says at a position, as a struct in the order of a change table's sub-fields."""
    fields = {"alt": "base", "qual": "bq", "qpos": "qpos", "ec": "ec", "sm": "sm", "qlen": "qlen", "sim": "sim", "mean": "bq_mean", "sd": "bq_sd"}
    return F.struct(*[(F.col(c + suffix).cast("int") if name == "ec" else F.col(c + suffix)).alias(name) for name, c in fields.items()])


def bq_histogram(bases: DataFrame) -> DataFrame:
    """bq, n: the lesser quality of positions where both strands match the reference, ungated."""
    return bases.where("base_1 = ref and base_2 = ref").groupBy(F.least("bq_1", "bq_2").alias("bq")).agg(F.count(F.lit(1)).alias("n"))


def depth(calls: DataFrame) -> DataFrame:
    """sample, contig, pos, depth: molecules callable at each position."""
    return calls.where("callable").groupBy("sample", "contig", "pos").agg(F.count(F.lit(1)).cast("int").alias("depth"))


