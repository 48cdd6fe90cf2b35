"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate, its target share of the corpus over
its present share. A document's count is the inverse of the Poisson
distribution with that mean at a uniform number made from a keyed hash of
its id, so it is the same in every run and on every executor. Documents are
exploded by their counts and dealt out by another keyed hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, cut

#: A larger mean is drawn as a sum of equal parts of at most this mean.
PART = 16.0
#: Terms of the distribution that are tabled; beyond, less than 2^-52 is left for a mean of PART.
TERMS = 80
#: Sources whose tables (700 bytes each) may be broadcast after they have been counted.
MOST_SOURCES = 20_000


def uniform(ident: Column, seed: int, part: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 keyed by seed and part."""
    text = F.concat_ws(":", F.lit(str(seed)), part.cast("string"), F.coalesce(ident.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def rates(sizes: DataFrame, source: str, weights: dict[str, float] | None, temperature: float, epochs: float) -> DataFrame:
    """source -> parts, cdf: from total sizes by source.

    weights: target shares by source; sources not named get none. Without
    it, shares follow the present ones to the power `temperature`.
    """
    if weights is None:
        share = sizes.withColumn("__want", F.when(F.col("__size") > 0, F.pow(F.col("__size").cast("double"), F.lit(temperature))).otherwise(0.0))
    else:
        named = sizes.sparkSession.createDataFrame([(str(k), float(v)) for k, v in weights.items()], f"`{source}` string, __want double")
        share = sizes.join(F.broadcast(named), source, "left").fillna(0.0, ["__want"])
    want = F.round(F.col("__want"), 6)
    everything, wants = share.agg(F.sum("__size").cast("double"), F.sum(want.cast("decimal(38,6)")).cast("double")).first()  # one row
    mean = F.when((F.col("__size") > 0) & F.lit(bool(wants)), F.lit(epochs) * want / F.lit(wants or 1.0) * F.lit(everything or 0.0) / F.col("__size")).otherwise(0.0)
    table = share.withColumn("rate", mean)
    table = table.withColumn("__parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
    table = table.withColumn("__mean", F.col("rate") / F.col("__parts"))
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-F.col("__mean")).alias("p"), F.array(F.exp(-F.col("__mean"))).alias("cdf")),
        lambda s, k: F.struct((s["p"] * F.col("__mean") / k).alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * F.col("__mean") / k)).alias("cdf")),
        lambda s: s["cdf"],
    )
    return table.select(source, "rate", "__parts", step.alias("__cdf"))


def counted(docs: DataFrame, ident: str, source: str, size: Column, weights: dict[str, float] | None, temperature: float, epochs: float, seed: int) -> DataFrame:
    """docs with rate and n_copies; all other columns as they are."""
    sizes = cut(docs.select(F.col(source).cast("string").alias(source), size.cast("long").alias("__size")).groupBy(source).agg(F.sum("__size").alias("__size")))
    table = rates(sizes, source, weights, temperature, epochs)
    table = table.withColumnRenamed(source, "__source")
    # the numbers below each draw's place in the table: drawn once a part, compared with all of it
    draws = F.transform(F.sequence(F.lit(1), F.col("__parts")), lambda k: uniform(F.col("__ident"), seed, k))
    drawn = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(F.col("__cdf"), lambda c: c <= u)))
    # the row travels as one column, so that none of its names clash
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(ident).alias("__ident"), F.col(source).cast("string").alias("__key"))
    joined = packed.join(bounded(table, sizes.count(), MOST_SOURCES), F.col("__key").eqNullSafe(F.col("__source")))
    return joined.select("__row", "rate", drawn.alias("n_copies")).select("__row.*", "rate", "n_copies")


def mix(
    docs: DataFrame,
    ident: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: int = 20_240_601,
) -> DataFrame:
    """Every row of docs, repeated by its count, plus copy (from 0), n_copies, rate, shuffle_key; globally shuffled.

    Columns of docs with one of these four names give way to them.

    Sizes are characters of the whole texts (null: 0). A null source is a
    source of its own. Sources of no text are not repeated. Rows repeated
    with the same ident get the same count each. Very long texts count whole.
    An empty table stays empty. Columns of other names are kept, whatever they are.
    """
    clash = {"copy", "n_copies", "rate", "shuffle_key"} & set(docs.columns)
    docs = docs.drop(*clash)
    size = F.coalesce(F.length(F.col(text)), F.lit(0))
    many = counted(docs, ident, source, size, weights, temperature, epochs, seed)
    key = F.substring(F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.col("copy").cast("string"), F.coalesce(F.col(ident).cast("string"), F.lit("null"))).cast("binary")), 1, 16)
    copies = many.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1))).withColumn("shuffle_key", key)
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
