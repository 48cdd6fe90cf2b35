"""Registered queries of the variant engine and their DuckDB oracles.

The test tables hold no reads, so each operator runs over a table of the
same relational shape, whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import dna, stats
from ..functions.genomes import PRESETS, preset
from ..operators import annotate, attribution, band, bitmaps, complexity, filters, intervals, kmers, molecules, pairing, pileup, setops, spectrum
from ..session import dealt, durable, tasks_for
from . import corrected

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp"))


def day(col):
    return F.unix_date(F.to_date(col)).cast("long")


_DAY = "date_diff('day', DATE '1970-01-01', l_shipdate::DATE)"


def _line_reason():
    return filters.cascade([("quantity_low", F.col("l_quantity") < 5), ("quantity_high", F.col("l_quantity") > 45), ("discount", F.col("l_discount") >= 0.09), ("tax", F.col("l_tax") < 0.01)])


@query("""
    SELECT coalesce(CASE WHEN l_quantity < 5 THEN 'quantity_low' WHEN l_quantity > 45 THEN 'quantity_high'
                         WHEN l_discount >= 0.09 THEN 'discount' WHEN l_tax < 0.01 THEN 'tax' END, 'kept') AS reason, count(*) AS n
    FROM lineitem GROUP BY 1""")
def filter_cascade(spark, sf_dir):
    """First failure of a filter cascade, counted."""
    return filters.tally(table(spark, sf_dir, "lineitem"), _line_reason())


_SIDED = """
    sided AS (SELECT l_orderkey, l_linenumber, l_linestatus, max(l_partkey) AS partkey
              FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus)"""


def _sided(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_linestatus").agg(F.max("l_partkey").alias("partkey"))


@query(f"""
    WITH {_SIDED}
    SELECT a.l_orderkey, a.l_linenumber, a.partkey AS partkey_1, b.partkey AS partkey_2
    FROM sided a JOIN sided b USING (l_orderkey, l_linenumber) WHERE a.l_linestatus = 'F' AND b.l_linestatus = 'O'""")
def pair_strands(spark, sf_dir):
    """Molecules with both sides."""
    return pairing.pair(_sided(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_linestatus", "F", "O", ["partkey"])


@query("""
    WITH reads AS (SELECT l_partkey, l_orderkey * 10 + l_linenumber AS ord, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2),
    marked AS (SELECT *, CASE WHEN l_linestatus IS DISTINCT FROM lag(l_linestatus) OVER w AND lag(l_linestatus) OVER w IS NOT NULL THEN 0 ELSE 1 END AS fresh
               FROM reads WINDOW w AS (PARTITION BY l_partkey ORDER BY ord)),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY l_partkey ORDER BY ord) AS run FROM marked),
    placed AS (SELECT *, (row_number() OVER (PARTITION BY l_partkey, run ORDER BY ord) - 1) // 2 AS k FROM runs)
    SELECT l_partkey, max(ord) FILTER (l_linestatus = 'F') AS ord_1, max(ord) FILTER (l_linestatus = 'O') AS ord_2
    FROM placed GROUP BY l_partkey, run, k HAVING count(*) = 2""")
def pair_strands_in_order(spark, sf_dir):
    """Molecules of reads that pair in input order, where strands repeat."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_linestatus")
    reads = dealt(lines, tasks_for(lines), "l_partkey").groupBy("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord")).agg(F.min("l_linestatus").alias("l_linestatus"))
    numbered = pairing.in_order(reads, ["l_partkey"], "l_linestatus", "ord")
    return pairing.met(numbered, ["l_partkey", "mol"], "l_linestatus", "F", "O", ["ord"]).drop("mol")


@query(f"""
    WITH {_SIDED}
    SELECT * FROM sided s WHERE (SELECT count(DISTINCT l_linestatus) FROM sided t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber) = 1""")
def unpaired_strands(spark, sf_dir):
    """Sides whose molecule lacks the other."""
    return pairing.unpaired(_sided(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_linestatus")


@query("""
    SELECT l_orderkey, l_linenumber, l_linestatus, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_linestatus ORDER BY l_partkey * 10000000 + l_suppkey * 100 + l_quantity DESC) = 1""")
def latest_of_strand(spark, sf_dir):
    """Of repeated reads of a strand the last in input order."""
    order = F.col("l_partkey") * 10_000_000 + F.col("l_suppkey") * 100 + F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_partkey", order.alias("input_ord"))
    return pairing.latest(rows, ["l_orderkey", "l_linenumber"], "l_linestatus", "input_ord").drop("input_ord")


@query("SELECT l_suppkey, l_partkey, count(*) AS depth FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2")
def position_depth(spark, sf_dir):
    """Molecules to a position, where there are enough."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("depth")).where("depth >= 2")


def _spans(spark, sf_dir):
    first = day(F.col("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_partkey", first.alias("start"), (first + F.col("l_quantity").cast("long")).alias("end"))


#: Days of a bin of the two-level scans.
DAYS = 64
_SPANS = f"spans AS (SELECT l_suppkey, l_linenumber, l_returnflag, l_partkey, {_DAY} AS s, {_DAY} + l_quantity::BIGINT AS e FROM lineitem)"


def _islands(source: str, keys: str = "l_suppkey") -> str:
    return f"""
    once AS (SELECT {keys}, s, max(e) AS e FROM {source} GROUP BY {keys}, s),
    reach AS (SELECT *, max(e) OVER (PARTITION BY {keys} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM once),
    flags AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s ROWS UNBOUNDED PRECEDING) AS g FROM reach),
    merged AS (SELECT {keys}, min(s) AS "start", max(e) AS "end" FROM flags GROUP BY {keys}, g)"""


#: Whole spans of one supplier nearly tile the years; those of one line number and flag don't.
FINE = ["l_suppkey", "l_linenumber", "l_returnflag"]
_FINE = ", ".join(FINE)


@query(f"""
    WITH {_SPANS}, {_islands("spans", _FINE)}
    SELECT {_FINE}, "start", "end" FROM merged""")
def merge_intervals(spark, sf_dir):
    """Overlapping and book-ended intervals made one, by supplier, line number and flag."""
    spans = _spans(spark, sf_dir)
    return intervals.merge(spans, FINE, bin_width=DAYS, tasks=tasks_for(spans))


@query(f"""
    WITH {_SPANS},
    steps AS (SELECT l_suppkey, s AS pos, 1 AS step FROM spans UNION ALL SELECT l_suppkey, e, -1 FROM spans),
    summed AS (SELECT l_suppkey, pos, sum(step) AS step FROM steps GROUP BY 1, 2)
    SELECT l_suppkey, pos, lead(pos) OVER (PARTITION BY l_suppkey ORDER BY pos) AS next_pos,
           sum(step) OVER (PARTITION BY l_suppkey ORDER BY pos)::BIGINT AS depth FROM summed""")
def depth_sweep(spark, sf_dir):
    """Depth between all breakpoints, by supplier."""
    spans = _spans(spark, sf_dir)
    return intervals.depth_steps(spans, ["l_suppkey"], bin_width=DAYS, tasks=tasks_for(spans, 2))


@query(f"""
    WITH {_SPANS},
    steps AS (SELECT l_suppkey, s AS pos, 1 AS step FROM spans UNION ALL SELECT l_suppkey, e, -1 FROM spans),
    summed AS (SELECT l_suppkey, pos, sum(step) AS step FROM steps GROUP BY 1, 2),
    runs AS (SELECT l_suppkey, pos AS s, lead(pos) OVER w AS e, sum(step) OVER w AS depth FROM summed WINDOW w AS (PARTITION BY l_suppkey ORDER BY pos)),
    means AS (SELECT l_suppkey, round(sum(e - s) / 2600.0::DOUBLE, 2) AS m FROM spans GROUP BY 1),
    caps AS (SELECT l_suppkey, CASE WHEN c <= 1 THEN 2.0 ELSE c END AS cap FROM (SELECT l_suppkey, round_even((m + 4 * sqrt(m)) * 100, 0) / 100 AS c FROM means)),
    high AS (SELECT l_suppkey, s, e FROM runs JOIN caps USING (l_suppkey) WHERE depth >= cap AND e IS NOT NULL), {_islands("high")}
    SELECT l_suppkey, "start", "end" FROM merged""")
def highcov_intervals(spark, sf_dir):
    """Where depth reaches the supplier's cap, mean + 4 sqrt(mean)."""
    spans = _spans(spark, sf_dir)
    mean = F.round(F.sum(F.col("end") - F.col("start")) / F.lit(2600.0), 2)
    caps = spans.groupBy("l_suppkey").agg(intervals.depth_cap(mean, 1).alias("cap"))
    return intervals.at_least(spans, caps, ["l_suppkey"], bin_width=DAYS, tasks=tasks_for(spans, 2))


@query(f"""
    WITH {_SPANS}, {_islands("spans", _FINE)}
    SELECT {_FINE}, l_partkey, e AS pos FROM spans p
    WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.l_suppkey = p.l_suppkey AND m.l_linenumber = p.l_linenumber AND m.l_returnflag = p.l_returnflag AND p.e >= m."start" AND p.e < m."end")""")
def mask_anti_join(spark, sf_dir):
    """Ends of spans outside the merged mask of all spans of their key."""
    spans = _spans(spark, sf_dir)
    tasks = tasks_for(spans)
    return intervals.unmasked(spans.select(*FINE, "l_partkey", F.col("end").alias("pos")), intervals.merge(spans, FINE, bin_width=DAYS, tasks=tasks), FINE, bin_width=64, tasks=tasks)


def _short_spans(spark, sf_dir):
    """Spans of one to three days, so that those of all rows of a supplier don't tile."""
    return _spans(spark, sf_dir).withColumn("stop", F.col("end")).withColumn("end", F.col("start") + 1 + F.floor((F.col("stop") - F.col("start")) / 25))


_SHORT = f"short AS (SELECT l_suppkey, l_partkey, s, s + 1 + (e - s) // 25 AS e, e AS stop FROM ({_SPANS.removeprefix('spans AS (')})"


@query(f"""
    WITH {_SHORT}, {_islands("short")}
    SELECT l_suppkey, "start", "end" FROM merged""")
def merge_intervals_whole(spark, sf_dir):
    """Overlapping and book-ended intervals made one, by supplier, of all rows."""
    spans = _short_spans(spark, sf_dir)
    return intervals.merge(spans, ["l_suppkey"], bin_width=DAYS, tasks=tasks_for(spans))


@query(f"""
    WITH {_SHORT}, {_islands("short")}
    SELECT l_suppkey, l_partkey, stop AS pos FROM short p
    WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.l_suppkey = p.l_suppkey AND p.stop >= m."start" AND p.stop < m."end")""")
def mask_anti_join_whole(spark, sf_dir):
    """Positions of all rows outside the merged mask of all rows."""
    spans = _short_spans(spark, sf_dir)
    tasks = tasks_for(spans)
    return intervals.unmasked(spans.select("l_suppkey", "l_partkey", F.col("stop").alias("pos")), intervals.merge(spans, ["l_suppkey"], bin_width=DAYS, tasks=tasks), ["l_suppkey"], bin_width=64, tasks=tasks)


@query("""
    SELECT event_id, coalesce((SELECT count(*) FROM events e WHERE e.event_type = 'error' AND e.user_id = v.user_id AND abs(epoch_us(e.ts) - epoch_us(v.ts)) <= 3600000000), 0)
           - CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS n_near FROM events v""")
def band_count(spark, sf_dir):
    """Marked events of the same user within an hour, the event itself left out."""
    rows = table(spark, sf_dir, "events").withColumn("us", micros("ts"))
    near = band.within(F.col("event_type") == "error", ["user_id"], F.col("us"), 3_600_000_000)
    return rows.select("event_id", (near - F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("n_near"))


@query("""
    SELECT event_id FROM events v
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.user_id = v.user_id AND abs(epoch_us(e.ts) - epoch_us(v.ts)) <= 3600000000)""")
def band_anti_join(spark, sf_dir):
    """Events with no marked event of their user within an hour."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", micros("ts").alias("us"))
    return band.away_from(rows, F.col("event_type") == "error", ["user_id"], F.col("us"), 3_600_000_000).select("event_id")


@query("""
    WITH space AS (SELECT user_id, ts::DATE AS d FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events))
    SELECT user_id, CAST(d AS VARCHAR) AS d, round(sum(value), 4) AS total, count(*) AS n FROM (SELECT user_id, ts::DATE AS d, value FROM events) JOIN space USING (user_id, d) GROUP BY 1, 2""")
def shared_space(spark, sf_dir):
    """Keys that all samples have, and sums over them."""
    rows = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    space = setops.shared_space(rows, "event_type", ["user_id", "d"])
    return setops.in_space(rows, space, ["user_id", "d"]).groupBy("user_id", F.col("d").cast("string").alias("d")).agg(F.round(F.sum("value"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


_PRIVATE = """
    keys AS (SELECT DISTINCT l_returnflag AS sample, l_partkey, l_quantity FROM lineitem),
    shared AS (SELECT sample, l_partkey, l_quantity, count(*) OVER (PARTITION BY l_partkey, l_quantity) - 1 AS shared FROM keys)"""


def _shared_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "sample")
    key = ["l_partkey", "l_quantity"]
    return setops.shared_with_others(rows.select("sample", *key).distinct(), setops.samples_holding(rows, "sample", key), rows.select("sample", *key), "sample", key)


@query(f"WITH {_PRIVATE} SELECT sample, shared, count(*) AS n FROM shared GROUP BY 1, 2")
def private_calls(spark, sf_dir):
    """Keys by how many other samples hold them."""
    return _shared_keys(spark, sf_dir).groupBy("sample", "shared").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {_PRIVATE}, rows AS (
        SELECT l_orderkey, l_returnflag, shared, CASE WHEN l_linenumber <= 4 THEN 'x' WHEN l_linenumber <= 6 THEN 'm' ELSE 'z' END AS kind, CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END AS n_mis
        FROM lineitem l JOIN shared s ON s.sample = l.l_returnflag AND s.l_partkey = l.l_partkey AND s.l_quantity = l.l_quantity),
    first AS (SELECT *, CASE kind WHEN 'm' THEN 'MSM' WHEN 'z' THEN 'RDM' ELSE CASE WHEN shared >= 1 THEN 'GRM' WHEN n_mis > 0 THEN 'FPD' ELSE 'DNM' END END AS a FROM rows),
    told AS (SELECT CASE WHEN a = 'DNM' AND count(*) FILTER (WHERE a = 'DNM') OVER (PARTITION BY l_returnflag, l_orderkey) >= 3 THEN 'FPD' ELSE a END AS annotation FROM first)
    SELECT annotation, count(*) AS n FROM told GROUP BY 1""")
def annotate_calls(spark, sf_dir):
    """The ordered annotation: shared, mismatches nearby, crowded molecules."""
    kind = F.when(F.col("l_linenumber") <= 4, "x").when(F.col("l_linenumber") <= 6, "m").otherwise("z")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("sample"), "l_partkey", "l_quantity", kind.alias("kind"), F.when(F.col("l_tax") > 0.07, 1).otherwise(0).alias("n_mis"))
    tasks = tasks_for(lines)
    rows = setops.with_shared(dealt(lines, tasks, "l_partkey"), "sample", ["l_partkey", "l_quantity"])
    first = rows.select("sample", "l_orderkey", annotate.first_annotation(F.col("kind"), F.col("shared"), F.col("n_mis")).alias("annotation"))
    return annotate.flag_crowded(dealt(first, tasks, "sample", "l_orderkey"), ["sample", "l_orderkey"], 3).groupBy("annotation").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS n_marked FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_linestatus = 'F') >= 3")
def molecule_outliers(spark, sf_dir):
    """Molecules that hold too many changes."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("n_marked")).where("n_marked >= 3")


@query("""
    WITH points AS (SELECT user_id, floor(epoch(ts))::BIGINT AS pos, event_type FROM events WHERE event_type <> 'purchase'),
    spans AS (SELECT user_id, floor(epoch(ts))::BIGINT AS s, floor(epoch(ts))::BIGINT + floor(value * 3600)::BIGINT AS e FROM events WHERE event_type = 'purchase')
    SELECT p.user_id, s.s AS site, count(*) FILTER (WHERE event_type = 'view') AS n_view, count(*) FILTER (WHERE event_type = 'error') AS n_error, count(*) AS n
    FROM points p JOIN spans s ON p.user_id = s.user_id AND pos >= s AND pos < e GROUP BY 1, 2""")
def pileup_counts(spark, sf_dir):
    """Points inside intervals, counted by kind: a range join and a pivot."""
    rows = table(spark, sf_dir, "events").withColumn("pos", F.floor(micros("ts") / 1_000_000))
    spans = rows.where("event_type = 'purchase'").select("user_id", F.col("pos").alias("site"), F.col("pos").alias("start"), (F.col("pos") + F.floor(F.col("value") * 3600)).alias("end"))
    met = intervals.range_join(rows.where("event_type <> 'purchase'").select("user_id", "pos", "event_type"), spans, ["user_id"], bin_width=86_400)
    return met.groupBy("user_id", "site").agg(F.count_if(F.col("event_type") == "view").alias("n_view"), F.count_if(F.col("event_type") == "error").alias("n_error"), F.count(F.lit(1)).alias("n"))


_TRI = """
    chars AS (SELECT doc_id, lang, coalesce(n_chars, 0) AS n_chars, string_split({body}, '') AS c FROM documents),
    tri AS (SELECT doc_id, lang, n_chars, unnest(list_transform(range(1, greatest(len(c) - 1, 1)), lambda i: c[i] || c[i + 1] || c[i + 2])) AS t FROM chars),
    good AS (SELECT *, CASE WHEN t[2] IN ('A', 'G') THEN translate(reverse(t), 'ACGT', 'TGCA') ELSE t END AS f FROM tri WHERE regexp_full_match(t, '[ACGT]{{3}}'))"""
_ALL32 = """
    dims AS (SELECT a || c || b AS tri FROM (VALUES ('A'), ('C'), ('G'), ('T')) x(a), (VALUES ('C'), ('T')) y(c), (VALUES ('A'), ('C'), ('G'), ('T')) z(b))"""


@query(f"WITH {_TRI.format(body='upper(text)')}, {_ALL32} SELECT tri, count(f) AS n FROM dims LEFT JOIN good ON f = tri GROUP BY tri")
def kmer_composition(spark, sf_dir):
    """Folded 3-mers of all texts, all 32."""
    return kmers.completed(kmers.composition(table(spark, sf_dir, "documents"), "text")).select("tri", "n")


@query(f"WITH {_TRI.format(body='upper(text)')} SELECT lang, f AS tri, count(*) AS positions, sum(n_chars)::BIGINT AS total_depth FROM good GROUP BY 1, 2")
def context_tally(spark, sf_dir):
    """Rows and summed depth by folded context and language."""
    return kmers.tally(table(spark, sf_dir, "documents"), "text", "n_chars", by=("lang",))


_BASES = "['A','C','G','T']"


def _changes(spark, sf_dir):
    """Changes made of line items: bases by their keys."""
    base = lambda c: F.element_at(F.array(*[F.lit(b) for b in dna.BASES]), (F.col(c) % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", base("l_partkey").alias("ref"), base("l_suppkey").alias("alt"), F.concat(base("l_orderkey"), base("l_partkey"), base("l_linenumber")).alias("tri"))
    return rows


_CHANGES = f"""
    changes AS (SELECT DISTINCT l_partkey, {_BASES}[(l_partkey % 4 + 1)::INT] AS ref, {_BASES}[(l_suppkey % 4 + 1)::INT] AS alt,
                {_BASES}[(l_orderkey % 4 + 1)::INT] || {_BASES}[(l_partkey % 4 + 1)::INT] || {_BASES}[(l_linenumber % 4 + 1)::INT] AS t FROM lineitem),
    labelled AS (SELECT *, CASE WHEN t[2] IN ('A', 'G') THEN translate(reverse(t), 'ACGT', 'TGCA') ELSE t END AS f FROM changes WHERE ref <> alt),
    types AS (SELECT f[1] || '[' || (CASE WHEN ref IN ('A', 'G') THEN translate(ref, 'ACGT', 'TGCA') || '>' || translate(alt, 'ACGT', 'TGCA') ELSE ref || '>' || alt END) || ']' || f[3] AS sbs96 FROM labelled),
    all96 AS (SELECT tri, tri[1] || '[' || tri[2] || '>' || x || ']' || tri[3] AS sbs96 FROM dims, (VALUES ('A'), ('C'), ('G'), ('T')) v(x) WHERE x <> tri[2]),
    counted AS (SELECT a.sbs96, a.tri, count(t.sbs96) AS counts FROM all96 a LEFT JOIN types t USING (sbs96) GROUP BY 1, 2)"""


@query(f"WITH {_ALL32}, {_CHANGES} SELECT sbs96, tri, counts FROM counted")
def spectrum_counts(spark, sf_dir):
    """Distinct changes by the 96 types."""
    return spectrum.counts96(_changes(spark, sf_dir), ["l_partkey", "ref", "alt", "tri"]).select("sbs96", "tri", "counts")


@query(f"""
    WITH {_TRI.format(body='upper(text)')}, {_ALL32}, {_CHANGES},
    tally AS (SELECT tri, count(f) AS positions, coalesce(sum(n_chars), 0)::DOUBLE AS depth FROM dims LEFT JOIN good ON f = tri GROUP BY tri),
    freq AS (SELECT tri, CASE WHEN sum(depth) OVER () > 0 THEN depth / sum(depth) OVER () ELSE 0 END AS fc, CASE WHEN sum(positions) OVER () > 0 THEN positions / (sum(positions) OVER ())::DOUBLE ELSE 0 END AS fg FROM tally),
    norm AS (SELECT sbs96, counts, CASE WHEN fc > 0 THEN counts * fg / fc ELSE 0 END AS normcounts FROM counted JOIN freq USING (tri))
    SELECT sbs96, counts, round(counts / (sum(counts) OVER ())::DOUBLE, 8) AS frac, round(normcounts, 4) AS normcounts,
           round(CASE WHEN sum(normcounts) OVER () > 0 THEN normcounts / sum(normcounts) OVER () ELSE 0 END, 8) AS normfrac FROM norm""")
def spectrum_normalise(spark, sf_dir):
    """The spectrum corrected for how often each context could be seen."""
    tally = kmers.completed(kmers.tally(table(spark, sf_dir, "documents"), "text", "n_chars"), "positions").na.fill(0, ["total_depth"])
    counts = spectrum.counts96(_changes(spark, sf_dir), ["l_partkey", "ref", "alt", "tri"])
    out = spectrum.normalise(counts, tally)
    return out.select("sbs96", "counts", F.round("frac", 8).alias("frac"), F.round("normcounts", 4).alias("normcounts"), F.round("normcounts_frac", 8).alias("normfrac"))


_HUMAN = ", ".join(f"('{tri}', {n})" for tri, n in PRESETS["GRCh38"].items())
_ROUNDED = {"frac": 8, "normcounts": 4, "normfrac": 8, "normcounts_new": 4, "normfrac_new": 8, "freq_C(c)": 10, "freq_G(c)": 10, "freq_G(c)_new": 10, "freq_G/freq_C(c)": 6, "freq_G(c)_new/freq_C(c)": 6, "Human_normcounts": 4, "Human_normfrac": 8, "freq_G_human": 10}


@query(f"""
    WITH {_TRI.format(body='upper(text)')}, {_ALL32}, {_CHANGES},
    tally AS (SELECT tri, count(f) AS positions, coalesce(sum(n_chars), 0)::BIGINT AS depth FROM dims LEFT JOIN good ON f = tri GROUP BY tri),
    freq AS (SELECT tri, positions, depth, human, depth / (sum(depth) OVER ())::DOUBLE AS fc, positions / (sum(positions) OVER ())::DOUBLE AS fg, human / (sum(human) OVER ())::DOUBLE AS fh
             FROM tally JOIN (VALUES {_HUMAN}) h(tri, human) USING (tri)),
    norm AS (SELECT *, CASE WHEN fc > 0 THEN counts * fg / fc ELSE 0 END AS ng, CASE WHEN fc > 0 THEN counts * fh / fc ELSE 0 END AS nh, CASE WHEN fc > 0 THEN fg / fc ELSE 0 END AS gc FROM counted JOIN freq USING (tri))
    SELECT sbs96[3:5] AS sub, tri, sbs96, counts, round(counts / (sum(counts) OVER ())::DOUBLE, 8) AS frac, round(ng, 4) AS normcounts, round(ng / sum(ng) OVER (), 8) AS normfrac,
           round(ng, 4) AS normcounts_new, round(ng / sum(ng) OVER (), 8) AS normfrac_new, round(fc, 10) AS "freq_C(c)", round(fg, 10) AS "freq_G(c)", round(fg, 10) AS "freq_G(c)_new",
           round(gc, 6) AS "freq_G/freq_C(c)", round(gc, 6) AS "freq_G(c)_new/freq_C(c)", positions AS genome_tri_count, positions AS ref_callable_tri_count, depth AS duplex_callable_tri_count,
           round(nh, 4) AS "Human_normcounts", round(nh / sum(nh) OVER (), 8) AS "Human_normfrac", round(fh, 10) AS freq_G_human, human::BIGINT AS human_tri_count FROM norm""")
def spectrum_table(spark, sf_dir):
    """All 21 columns of the corrected spectrum."""
    tally = kmers.completed(kmers.tally(table(spark, sf_dir, "documents"), "text", "n_chars"), "positions").na.fill(0, ["total_depth"])
    counts = spectrum.counts96(_changes(spark, sf_dir), ["l_partkey", "ref", "alt", "tri"])
    out = corrected.named(spectrum.normalise(counts, tally, human=preset(spark, "GRCh38")))
    return out.select(*[F.round(F.col(c), _ROUNDED[c]).alias(c) if c in _ROUNDED else F.col(c) for c in corrected.COLUMNS])


@query("""
    WITH h AS (SELECT l_quantity::INT AS bq, count(*) AS n FROM lineitem GROUP BY 1), bins AS (SELECT unnest(range(0, 94)) AS bq),
    full_h AS (SELECT bins.bq::INT AS bq, coalesce(n, 0) AS n FROM bins LEFT JOIN h ON h.bq = bins.bq)
    SELECT bq, n, round(sum(n) OVER (ORDER BY bq DESC) / (sum(n) OVER ())::DOUBLE, 6) AS frac_ge FROM full_h""")
def bq_histogram(spark, sf_dir):
    """A quality histogram over all bins with the share at or above each."""
    counted = table(spark, sf_dir, "lineitem").groupBy(F.col("l_quantity").cast("int").alias("bq")).agg(F.count(F.lit(1)).alias("n"))
    bins = spark.range(94).select(F.col("id").cast("int").alias("bq"))
    return band.reverse_cumulative(bins.join(counted, "bq", "left").na.fill(0, ["n"]), "bq", "n")


@query("""
    SELECT event_id, round(avg(value) OVER w, 6) AS mean_value, round(stddev_pop(value) OVER w, 6) AS sd_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def window_stats(spark, sf_dir):
    """Mean and deviation over the rows on either side."""
    mean, deviation = band.sliding(F.col("value"), ["user_id"], F.struct("ts", "event_id"), 2)
    return table(spark, sf_dir, "events").select("event_id", F.round(mean, 6).alias("mean_value"), F.round(deviation, 6).alias("sd_value"))


@query("""
    WITH found AS (SELECT user_id, event_type, avg(value) > 0 AND count(*) >= 2 AS detected, user_id % 4 AS g FROM events GROUP BY 1, 2),
    sizes AS (SELECT user_id % 4 AS g, count(DISTINCT user_id) AS n_samples FROM events GROUP BY 1)
    SELECT g AS "group", event_type AS signature, count(*) FILTER (WHERE detected) AS n_samples_detected, n_samples, count(*) FILTER (WHERE detected) >= 30 AS validated
    FROM found JOIN sizes USING (g) GROUP BY 1, 2, 4""")
def group_validation(spark, sf_dir):
    """Signatures found in enough samples of a group."""
    rows = table(spark, sf_dir, "events")
    found = rows.groupBy(F.col("user_id").alias("sample"), F.col("event_type").alias("signature")).agg(((F.avg("value") > 0) & (F.count(F.lit(1)) >= 2)).alias("detected"))
    groups = rows.select(F.col("user_id").alias("sample"), (F.col("user_id") % 4).alias("group")).distinct()
    return attribution.validated(found, groups, 30)


@query("SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.025), 6) AS lo95, round(quantile_cont(l_extendedprice, 0.975), 6) AS hi95, count(*) AS n FROM lineitem GROUP BY 1")
def percentile_ci(spark, sf_dir):
    """Percentile intervals by key."""
    low, high = stats.percentile_interval(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(low, 6).alias("lo95"), F.round(high, 6).alias("hi95"), F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment AS sample, c_nationkey AS ord, sum(c_custkey)::DOUBLE AS value FROM customer GROUP BY 1, 2")
def group_pool(spark, sf_dir):
    """Spectra summed by group."""
    rows = table(spark, sf_dir, "customer")
    spectra = rows.select(F.col("c_custkey").alias("sample"), F.col("c_nationkey").alias("ord"), F.col("c_custkey").cast("double").alias("value"))
    return attribution.pooled(spectra, rows.select(F.col("c_custkey").alias("sample"), F.col("c_mktsegment").alias("group")))


@query("""
    WITH o AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus = 'O'), l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
    SELECT 'both' AS what, count(*) AS n, coalesce(sum(k), 0)::BIGINT AS total FROM (SELECT k FROM o INTERSECT SELECT k FROM l)
    UNION ALL SELECT 'orders', count(*), coalesce(sum(k), 0)::BIGINT FROM (SELECT k FROM o EXCEPT SELECT k FROM l)
    UNION ALL SELECT 'either', count(*), coalesce(sum(k), 0)::BIGINT FROM (SELECT k FROM o UNION SELECT k FROM l)
    UNION ALL SELECT 'all', count(*), coalesce(sum(k), 0)::BIGINT FROM (SELECT k FROM o UNION ALL SELECT k FROM l)""")
def set_ops(spark, sf_dir):
    """Intersection, difference and unions of key sets."""
    one = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("k")).distinct()
    two = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")).distinct()
    sets = {"both": one.intersect(two), "orders": one.exceptAll(two), "either": one.union(two).distinct(), "all": one.union(two)}
    out = None
    for name, rows in sets.items():
        part = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("total")).select(F.lit(name).alias("what"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
    SELECT c_custkey, c_nationkey, coalesce(n_regionkey, (SELECT max(n_regionkey) + 1 FROM nation WHERE n_nationkey < 20)) AS contig_rank
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON n_nationkey = c_nationkey""")
def contig_order_sort(spark, sf_dir):
    """Rows in reference order; what the reference lacks comes last."""
    contigs = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("idx"))
    return setops.ranked(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), contigs, "c_nationkey").orderBy("contig_rank", "c_custkey")


@query("""
    SELECT l_suppkey, sum(greatest(0, least(e, 9500) - least(greatest(s, 0), 9500)))::BIGINT AS bases
    FROM (SELECT l_suppkey, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS s, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + l_quantity::BIGINT AS e FROM lineitem) GROUP BY 1""")
def raw_coverage(spark, sf_dir):
    """Covered bases, clipped to the contig."""
    return _spans(spark, sf_dir).groupBy("l_suppkey").agg(F.sum(intervals.covered(F.col("start"), F.col("end"), F.lit(9500))).cast("long").alias("bases"))


@query("""
    SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_quantity, l_linestatus) AS n FROM lineitem) WHERE l_linestatus <> 'F' OR n >= 3""")
def supported_alone(spark, sf_dir):
    """Rows of one kind stay if enough others share their site."""
    rows = table(spark, sf_dir, "lineitem").withColumn("kind", F.when(F.col("l_linestatus") == "F", "x").otherwise("o"))
    return annotate.supported_alone(rows, ["l_suppkey", "l_quantity"], 3).select("l_orderkey", "l_partkey", "l_quantity")


@query()
def poisson_rates(spark, sf_dir):
    """Rates with exact Poisson limits, by nation."""
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count_if(F.col("c_acctbal") < 0).alias("k"), F.count(F.lit(1)).alias("n"))
    told = rows.withColumn("ci", stats.poisson_interval("k"))
    return told.select("c_nationkey", "k", "n", dna.ratio(F.col("k"), F.col("n")).alias("rate"), (F.col("ci.lower") / F.col("n")).alias("lower"), (F.col("ci.upper") / F.col("n")).alias("upper"))


@query()
def bootstrap_attribution(spark, sf_dir):
    """Embeddings as spectra fitted by the mean vectors of their labels, with bootstrap intervals."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("ord", "x"))
    signatures = rows.groupBy(F.col("label").cast("string").alias("signature"), "ord").agg(F.avg(F.abs("x")).alias("weight"))
    spectra = rows.groupBy((F.col("label") % 3).cast("string").alias("sample"), "ord").agg(F.sum(F.abs("x")).alias("value"))
    return attribution.intervals(attribution.fit(spectra, signatures))


@query("SELECT l_returnflag AS sample, l_linestatus AS base, count(*) AS n, count(*) OVER (PARTITION BY l_returnflag) AS kinds FROM lineitem GROUP BY 1, 2")
def group_size_back(spark, sf_dir):
    """A group's size on each of its rows."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_linestatus").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("kinds", F.count(F.lit(1)).over(Window.partitionBy("sample")))


@query("""
    WITH held AS (SELECT l_suppkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) = (SELECT count(DISTINCT l_returnflag) FROM lineitem))
    SELECT l_suppkey, l_partkey, count(*) AS n, sum(l_linenumber)::BIGINT AS total FROM lineitem JOIN held USING (l_suppkey, l_partkey) GROUP BY 1, 2""")
def shared_positions(spark, sf_dir):
    """Positions that all samples hold, told by bitmaps, and sums over their rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_partkey", "l_linenumber")
    tasks = tasks_for(rows)
    found = bitmaps.shared_words(rows, "l_returnflag", ["l_suppkey"], "l_partkey", tasks=tasks)
    held = bitmaps.holding_words(rows, found, ["l_suppkey"], "l_partkey", tasks)
    return held.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("total"))


# Reads made of orders: a molecule an order, 40 bases on one of 5 contigs of 4,000. Its forward
# read is 40M, its reverse one 20M 2D 18M; keys decide where strands differ from the reference.
CONTIGS, CONTIG_BASES, READ_BASES = 5, 4000, 40
_BASE_SQL = "(({p}) * ({p}) + 3 * ({p}) * ({k}) + ({p}) // 7) % 4"
_CHANGED_SQL = "CASE WHEN (o_orderkey * 3 + ({p})) % 61 = 0 THEN 2 WHEN (o_orderkey * {mul} + ({p}) * 13 + ({p}) * ({p})) % 53 = 0 THEN 1 ELSE 0 END"
_QUALITY_SQL = "CASE WHEN (o_orderkey + {s} * ({p})) % 29 = 0 THEN 50 ELSE 93 END"


def genome(spark) -> DataFrame:
    """contig, seq of the contigs that the reads lie on."""
    base = F.expr(f"substring('ACGT', cast({_BASE_SQL.format(p='p', k='k').replace('//', 'div')} + 1 as int), 1)")
    rows = spark.range(CONTIGS).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CONTIG_BASES - 1).cast("long"))).alias("p")).select("k", "p", base.alias("b"))
    listed = F.sort_array(F.collect_list(F.struct("p", "b")))  # one contig
    return rows.groupBy("k").agg(F.array_join(F.transform(listed, lambda x: x["b"]), "").alias("seq")).select(F.concat(F.lit("c"), F.col("k")).alias("contig"), "seq")


def order_reads(spark, sf_dir) -> DataFrame:
    """Two reads of every order."""
    key = F.col("o_orderkey").cast("long")
    orders = table(spark, sf_dir, "orders").select(key.alias("key"), (F.col("o_custkey") % CONTIGS).cast("long").alias("k"), (key * 7 % (CONTIG_BASES - READ_BASES)).alias("start")).where("key is not null and k is not null")
    sides = [("fwd", 1, 5, [(0, 40)], [*range(40)]), ("rev", 2, 11, [(0, 20), (2, 2), (0, 18)], [*range(20), *range(22, 40)])]

    def run(batches):
        for batch in batches:
            key, k, start = (batch.column(c).to_numpy() for c in range(3))
            n, text = len(batch), batch.column(0).cast(pa.string())
            for side, s, mul, cigar, offsets in sides:
                p, o = start[:, None] + np.array(offsets), key[:, None]
                changed = np.where((o * 3 + p) % 61 == 0, 2, np.where((o * mul + p * 13 + p * p) % 53 == 0, 1, 0))
                base = (p * p + 3 * p * k[:, None] + p // 7 + changed) % 4
                quality = np.where((o + s * p) % 29 == 0, 50, 93).astype(np.int32)
                ends = lambda each: pa.array(np.arange(n + 1, dtype=np.int32) * each)
                ops = pa.StructArray.from_arrays([pa.array(np.tile(np.array(x, np.int32), n)) for x in zip(*cigar, strict=True)], names=["op", "len"])
                seq = pa.Array.from_buffers(pa.string(), n, [None, ends(len(offsets)).buffers()[1], pa.py_buffer(np.frombuffer(b"ACGT", np.uint8)[base])])
                same = lambda x, kind: pa.repeat(pa.scalar(x, kind), n)
                columns = {
                    "sample": same("s", pa.string()), "contig": pc.binary_join_element_wise("c", batch.column(1).cast(pa.string()), ""), "pos": batch.column(2).cast(pa.int32()), "flag": same(0, pa.int32()), "mapq": same(60, pa.int32()),
                    "cigar": pa.ListArray.from_arrays(ends(len(cigar)), ops), "seq": seq, "qual": pa.ListArray.from_arrays(ends(len(offsets)), pa.array(quality.ravel())), "qname": pc.binary_join_element_wise("m", text, side, "/"),
                    "nm": same(1, pa.int32()), "ec": same(20.0, pa.float64()), "zm": batch.column(0), "input_ord": pa.array(key * 2 + s),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return orders.mapInArrow(run, "sample string, contig string, pos int, flag int, mapq int, cigar array<struct<op:int,len:int>>, seq string, qual array<int>, qname string, nm int, ec double, zm bigint, input_ord bigint")


_WALK = f"""
    reads AS (SELECT o_orderkey, o_custkey % {CONTIGS} AS k, (o_orderkey * 7) % {CONTIG_BASES - READ_BASES} AS start FROM orders),
    spread AS (SELECT *, start + o AS p FROM (SELECT *, unnest(range(0, {READ_BASES})) AS o FROM reads)),
    bases AS (
        SELECT *, {_BASE_SQL.format(p='p', k='k')} AS ref, {_CHANGED_SQL.format(p='p', mul=5)} AS d1, {_CHANGED_SQL.format(p='p', mul=11)} AS d2,
               {_QUALITY_SQL.format(p='p', s=1)} AS raw1, {_QUALITY_SQL.format(p='p', s=2)} AS raw2, o AS q1, CASE WHEN o < 20 THEN o WHEN o >= 22 THEN o - 2 END AS q2 FROM spread)"""


@query(f"""
    WITH {_WALK},
    met AS (
        SELECT *, CASE WHEN q1 < 3 OR q1 >= 37 THEN 0 ELSE raw1 END AS bq1, CASE WHEN q2 < 3 OR q2 >= 35 OR q2 BETWEEN 18 AND 22 THEN 0 ELSE raw2 END AS bq2 FROM bases WHERE q2 IS NOT NULL),
    kinds AS (SELECT *, least(bq1, bq2) >= 93 AS good, CASE WHEN least(bq1, bq2) < 93 THEN NULL WHEN (d1 = 0) <> (d2 = 0) THEN 'm' WHEN d1 > 0 AND d1 = d2 THEN 'x' END AS kind FROM met),
    near AS (SELECT *, count(*) FILTER (kind = 'm') OVER (PARTITION BY o_orderkey ORDER BY p RANGE BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS n_mis FROM kinds)
    SELECT 'c' || k AS contig, p AS pos, substr('ACGT', (any_value(ref) + 1)::INT, 1) AS ref, count(*) FILTER (n_mis = 0 AND (kind = 'x' OR (good AND d1 = 0 AND d2 = 0))) AS depth,
           count(*) FILTER (kind = 'x') AS n_x, count(*) FILTER (kind = 'm') AS n_m, coalesce(sum(n_mis) FILTER (kind = 'x'), 0)::BIGINT AS x_near
    FROM near GROUP BY k, p HAVING count(*) FILTER (kind IS NOT NULL) > 0""")
def molecule_walk(spark, sf_dir):
    """Molecules walked as arrays: records by position with the depth of callable molecules there."""
    tiles = molecules.reference_tiles(genome(spark), 512)
    reads = order_reads(spark, sf_dir)
    rules = molecules.Rules(mismatch_window=4, quality_window=5, trim=3, indel_pad=2)
    found = durable(molecules.walked(reads, tiles, rules, size=512, tasks=tasks_for(reads, 4)))
    records = molecules.records(found).groupBy("sample", "contig", "pos", "ref").agg(
        F.count_if(F.col("kind") == "x").alias("n_x"), F.count_if(F.col("kind") == "m").alias("n_m"), F.coalesce(F.sum(F.when(F.col("kind") == "x", F.col("n_mis"))), F.lit(0)).alias("x_near")
    )
    runs = molecules.depth_runs(found, 512)
    spans = runs.select("sample", "contig", F.col("start").alias("a"), F.col("end").alias("b"), F.col("depth").cast("long").alias("depth"))
    deep = intervals.range_join(records.select("sample", "contig", "pos"), spans, ["sample", "contig"], "pos", "a", "b", 512)
    return records.join(deep, ["sample", "contig", "pos"], "left").select("contig", F.col("pos").cast("long").alias("pos"), "ref", F.coalesce("depth", F.lit(0)).alias("depth"), "n_x", "n_m", "x_near")


@query(f"""
    WITH {_WALK},
    seen AS (SELECT k, p, ref, d1 AS d, raw1 AS bq FROM bases UNION ALL SELECT k, p, ref, d2, raw2 FROM bases WHERE q2 IS NOT NULL)
    SELECT 'c' || k AS contig, p AS pos, {", ".join(f"count(*) FILTER ((ref + d) % 4 = {i}) AS {b}" for i, b in enumerate("ACGT"))}
    FROM seen WHERE bq >= 70 AND p % CASE WHEN k % 2 = 0 THEN 3 ELSE 97 END = 0 GROUP BY k, p""")
def allele_pileup(spark, sf_dir):
    """Alleles at sites of all reads: contigs with many sites are counted into arrays, the others site by site."""
    step = F.when(F.col("k") % 2 == 0, 3).otherwise(97)
    sites = spark.range(CONTIGS).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(CONTIG_BASES - 1))).alias("pos")).where(F.col("pos") % step == 0)
    sites = sites.select(F.lit("s").alias("sample"), F.concat(F.lit("c"), F.col("k")).alias("contig"), "pos")
    counts = pileup.count_alleles(order_reads(spark, sf_dir), sites, bin_width=1024)
    return counts.select("contig", F.col("pos").cast("long").alias("pos"), *dna.BASES)


@query()
def low_complexity(spark, sf_dir):
    """Low-complexity intervals of all texts, their letters taken for bases."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    bases = F.translate(F.lower("text"), letters, "".join(dna.BASES[k % 4] for k in range(len(letters))))
    return complexity.of_sequences(table(spark, sf_dir, "documents").select("doc_id", bases.alias("seq")), "doc_id", "seq")


@query()
def two_tier_attribution(spark, sf_dir):
    """Line items as spectra of samples in two groups: a second fit with the signatures that enough samples of a group show.

    Suppliers are of six kinds, each with quantities that it weighs more; a sample holds the kinds of its group.
    """
    kind, weight = F.col("l_suppkey") % 6, F.when(F.col("l_quantity") % 6 == F.col("l_suppkey") % 6, 5.0).otherwise(1.0)
    rows = table(spark, sf_dir, "lineitem").select(kind.alias("kind"), (F.col("l_orderkey") % 8).alias("s"), F.col("l_quantity").cast("int").alias("ord"), weight.alias("w"))
    signatures = rows.groupBy(F.col("kind").cast("string").alias("signature"), "ord").agg(F.sum("w").alias("weight"))
    sample, group = F.col("s").cast("string").alias("sample"), (F.col("s") % 2).cast("string").alias("group")
    spectra = rows.where("kind % 2 = s % 2").groupBy(sample, "ord").agg(F.sum("w").alias("value"))
    return attribution.attribute(spectra, signatures, rows.select(sample, group).distinct())[1]
