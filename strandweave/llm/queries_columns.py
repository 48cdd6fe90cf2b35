"""Queries of the operators that work on each document by itself."""

from __future__ import annotations

from . import matroska, token_counts, toxicity
from .common import table


def op1_matroska(spark, sf_dir):
    """Every text stored as Matroska PCM, read back through its packet table."""
    return matroska.digests(matroska.store(table(spark, sf_dir, "documents")))


def op8_ftrl_toxicity(spark, sf_dir):
    """Every document scored by a model learned from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.verdicts(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_token_attribution(spark, sf_dir):
    """Tokens of every line of every document; a token that crosses lines counts where most of it lies."""
    return token_counts.attribute(table(spark, sf_dir, "documents"))


QUERIES = {"op1_matroska": op1_matroska, "op8_ftrl_toxicity": op8_ftrl_toxicity, "op10_token_attribution": op10_token_attribution}

ORACLES: dict = {}
