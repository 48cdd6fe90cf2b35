"""Queries of the mixing and packing operators."""

from __future__ import annotations

from . import cutting, mixing, packing
from .common import table


def op4_poisson_mixing(spark, sf_dir):
    """Sources re-weighted to the square root of their present size, globally shuffled."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_concatenate_and_cut(spark, sf_dir):
    """The stream of all documents' tokens, cut into sequences of 4096."""
    return cutting.cut(table(spark, sf_dir, "documents"))


QUERIES = {"op4_poisson_mixing": op4_poisson_mixing, "op5_best_fit_packing": op5_best_fit_packing, "op11_concatenate_and_cut": op11_concatenate_and_cut}

ORACLES = {
    "op4_poisson_mixing": """
        WITH RECURSIVE sizes AS (
            SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
        want AS (
            SELECT source, size, CASE WHEN size > 0 THEN round(pow(size::DOUBLE, 0.5), 6) ELSE 0 END AS want FROM sizes),
        total AS (SELECT sum(size) AS all_size, sum(want::DECIMAL(38,6))::DOUBLE AS wants FROM want),
        rates AS (
            SELECT source, CASE WHEN size > 0 THEN 1.0::DOUBLE * want / wants * all_size::DOUBLE / size::DOUBLE ELSE 0 END AS rate
            FROM want, total),
        parts AS (SELECT source, rate, greatest(1, ceil(rate / 16.0))::INT AS parts, rate / greatest(1, ceil(rate / 16.0)) AS mean FROM rates),
        cdf(source, k, p, c) AS (
            SELECT source, 0, exp(-mean), exp(-mean) FROM parts
            UNION ALL
            SELECT f.source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf f JOIN parts USING (source) WHERE k < 80),
        draws AS (
            SELECT d.doc_id, d.source, rate,
                   ('0x' || substr(md5('20240601:' || j || ':' || d.doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
            FROM documents d JOIN parts p USING (source), LATERAL (SELECT unnest(range(1, p.parts + 1)) AS j)),
        counts AS (
            SELECT doc_id, any_value(rate) AS rate, sum((SELECT count(*) FROM cdf WHERE cdf.source = draws.source AND c <= u))::INT AS n_copies
            FROM draws GROUP BY doc_id)
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, rate, n_copies, k::INT AS copy,
               substr(md5('order20240601:' || k || ':' || d.doc_id), 1, 16) AS shuffle_key
        FROM documents d JOIN counts USING (doc_id), LATERAL (SELECT unnest(range(0, n_copies)) AS k)"""
}
