"""All registered queries."""

from . import (  # noqa: F401
    batching_queries,
    consume_queries,
    live_queries,
    log_queries,
    metric_queries,
    produce_queries,
    record_queries,
    routing_queries,
    stream_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
