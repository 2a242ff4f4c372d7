"""All registered queries."""

from sparkrec.plans import (  # noqa: F401
    gold_queries, ingest_queries, monitoring_queries, ranking_queries, streaming_queries, training_queries,
)
from sparkrec.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
