"""All registered queries."""

from tabulon.plans import q_evaluate, q_models, q_prepare, q_profile, q_relate, q_sources  # noqa: F401
from tabulon.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
