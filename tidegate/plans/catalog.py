"""All registered queries and their SQL twins."""

from __future__ import annotations

from tidegate.plans import (
    delivery_queries,
    failure_queries,
    manifest_queries,
    monitoring_queries,
    routing_queries,
    streaming_queries,
    task_queries,
)

_MODULES = (
    delivery_queries,
    task_queries,
    routing_queries,
    failure_queries,
    monitoring_queries,
    manifest_queries,
    streaming_queries,
)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
