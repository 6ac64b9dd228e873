"""The queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from . import byte_bpe, language_id, line_dedup, manifest, mixing, ngram_join, periodic_runs, pieces, quality_classifier, quality_rules, spotsigs, token_counts, toxicity

MODULES = (quality_rules, pieces, token_counts, quality_classifier, mixing, spotsigs, line_dedup, language_id, toxicity, ngram_join, periodic_runs, byte_bpe, manifest)


def queries():
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
