"""Imports every section so that its queries register."""

import checks.base_sql  # noqa: F401  (declares the shared SQL tables first)
from checks import q_augment, q_facts, q_features, q_planning, q_reports, q_series, q_sources  # noqa: F401
from checks.registry import ORACLES, QUERIES

QUICK = list(QUERIES)
import checks.q_models  # noqa: E402, F401  (after the others: its queries take minutes)

__all__ = ["ORACLES", "QUERIES", "QUICK"]
