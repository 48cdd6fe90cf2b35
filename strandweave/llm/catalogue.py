"""Registered corpus queries and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline

from . import queries_columns, queries_corpus, queries_dedup, queries_mixing

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLES: dict = {"pipeline": corpus_pipeline.ORACLE_SQL}

for _module in (queries_columns, queries_corpus, queries_dedup, queries_mixing):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
