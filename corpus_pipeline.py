"""The corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on everything its
predecessor kept. All but the last return the columns of documents, so each
can be written as Parquet and read again in between.

All stages take null and empty texts and null idents, texts of any length,
repeated rows and further columns of any names; from no rows they make
none. Null and empty texts score the model's bias, are exact copies of one
another, have no near copies, and are packed as their end id. Of exact
copies the row with the largest doc_id stays (any one, where that is repeated), of near ones
the row with the smallest; rows without doc_id have no near copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm import exact_dedup, mixing, near_dup, packing, toxicity
from strandweave.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; learned from the labels that aren't held out."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z case, the row with the largest doc_id."""
    return exact_dedup.distinct_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word shingle sets that are 80 % alike."""
    return near_dup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated towards the square root of their size, globally shuffled."""
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # no name clashes with what mixing adds
    named = dict(zip(docs.columns, plain.columns, strict=True))
    return mixing.mix(plain, named["doc_id"], named["source"], named["text"]).select(*plain.columns).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; workers that have run four stages before remember fewer words."""
    return packing.pack(docs, memory_bytes=20_000_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut(docs), sf_dir)
    return docs
