from millrace.plans import (  # noqa: F401  each module adds its queries to the registry
    aggregates, audits, exchanges, expressions, filters, joins, scans, sorts_and_sets, streams, windows,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
