"""Import every query module so the registry is complete."""

from dimwright.plans import q_checks, q_dq, q_ingest, q_scd, q_state, q_warehouse  # noqa: F401
from dimwright.plans.registry import ORACLES, QUERIES  # noqa: F401
