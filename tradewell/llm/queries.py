"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from tradewell.llm import (cross_polytope, decontamination, hard_negatives, language_id, mixing, ngram_join, pii, quality_classifier,  # noqa: F401
                            quality_rules, sharding, token_counts, warc_revisits, whitening)
from tradewell.llm.common import ORACLE, QUERIES  # noqa: F401
