"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from __future__ import annotations


def registry():
    """(queries, oracle SQL) of all operators here."""
    from . import bpe, chat, decontaminate, maxent, pii, shingle_join, simple8b, tiff, token_counts, toxicity

    modules = (decontaminate, toxicity, bpe, chat, maxent, shingle_join, pii, token_counts, simple8b, tiff)
    queries = {k: f for m in modules for k, f in m.QUERIES.items()}
    oracles = {k: s for m in modules for k, s in m.ORACLES.items()}
    return queries, oracles
