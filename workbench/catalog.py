"""All registered queries and their SQL."""

from workbench import (  # noqa: F401
    enrich_queries, flow_queries, parse_queries, path_queries, scalar_queries, session_queries, sink_queries,
    user_queries,
)
from workbench.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
