"""Queries of the deduplication operators."""

from __future__ import annotations

from . import exact_dedup, near_dup, passages
from .common import LOWER, UPPER, table


def op3_exact_dedup(spark, sf_dir):
    """Which documents are exact copies, and which copy stays."""
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark, sf_dir):
    """Components of documents whose 3-word shingle sets are 85 % alike or more."""
    return near_dup.decisions(table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_compact_windows(spark, sf_dir):
    """Spans of at least 50 words that other documents repeat, exactly or nearly."""
    return passages.repeated(table(spark, sf_dir, "documents"))


QUERIES = {"op2_compact_windows": op2_compact_windows, "op3_exact_dedup": op3_exact_dedup, "op7_minhash_near_dedup": op7_minhash_near_dedup}

ORACLES = {
    "op3_exact_dedup": f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM t"""
}
