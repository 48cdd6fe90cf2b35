import random

import corpus_pipeline
from pyspark.sql import functions as F

from strandweave.llm.catalogue import QUERIES

from .helpers import copies, docs, prose


def test_stages_keep_the_columns_and_drop_what_they_should(spark, tmp_path):
    rng = random.Random(11)
    rows = copies(rng, 6, 5, 2)
    n = len(rows)
    toxic = [(n + i, " ".join([*prose(rng, 20), "vile", *prose(rng, 10)])) for i in range(200)]
    clean = [(n + 200 + i, " ".join(prose(rng, 30))) for i in range(300)]
    rows = [*rows, *toxic, *clean, (900, None), (901, ""), (902, clean[0][1].upper())]
    table = docs(spark, rows).withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, str(tmp_path))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == table.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert not seen[0] & {i for i, _ in toxic} and len(seen[0]) == n + 303
    assert 902 in seen[1] and clean[0][0] not in seen[1] and len(seen[1] & {900, 901}) == 1
    assert len(seen[2]) < len(seen[1]) and {i for i, _ in clean[1:]} <= seen[2]
    assert seen[3] and seen[3] == seen[4]
    assert kept.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 2048


def test_run_on_the_smallest_tables(spark):
    assert QUERIES["pipeline"](spark, "/root/testdata/sf0.001").count() > 100


def test_stages_on_empty_tables_and_clashing_names(spark, tmp_path):
    """Every stage keeps columns named like its own, and makes nothing of nothing."""
    rows = [(i, " ".join(prose(random.Random(i), 20))) for i in range(30)] + [(5, "again"), (None, None), (31, "word " * 20_000)]
    table = docs(spark, rows).withColumns({c: F.lit(c) for c in ("score", "__score", "__row", "c0", "n", "copy", "keep_id", "kept")})
    spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (table, table.where("false")):
        kept = start
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, str(tmp_path))
            if name != "packing":
                assert kept.columns == table.columns, name
                assert kept.where("score <> 'score' or __row <> '__row' or copy <> 'copy'").isEmpty()
        assert (kept.count() == 0) == start.isEmpty()
