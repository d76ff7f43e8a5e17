"""Operators for preparing training data.  Importing the subpackage fills ``QUERIES`` and ``ORACLES``."""
from millrace.llm import (  # noqa: F401  each module adds its query
    bpe, decontaminate, identifiers, licences, line_dedup, neighbours, phrases, quality_gam, repeats, robust_rules, simhash,
    toxicity, turns,
)
from millrace.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
