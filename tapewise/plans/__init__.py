"""Registered queries and their DuckDB oracles (imported for their side effect)."""

from tapewise.plans import q_assoc, q_curves, q_models, q_profile, q_returns, q_split, q_tape  # noqa: F401
from tapewise.plans.registry import ORACLES, QUERIES  # noqa: F401
