"""All registered queries."""

from ledgerloom.plans import q_analysis, q_cleaning, q_matching, q_models  # noqa: F401
from ledgerloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
