"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from tickforge.plans import q_bars, q_drift, q_features, q_flows, q_incremental, q_io, q_model, q_silver, q_sketch, q_stream, q_telemetry  # noqa: F401
from tickforge.plans.q_features import flagship  # noqa: F401
from tickforge.plans.registry import REGISTRY


def queries():
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql():
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
