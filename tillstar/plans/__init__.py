"""Whole pipelines built from the operators, and the query registry."""

from tillstar.plans import (  # noqa: F401
    queries_analysis,
    queries_described,
    queries_layered,
    queries_layers,
    queries_metrics,
    queries_models,
    queries_sources,
)
from tillstar.plans.registry import QUERIES, run

__all__ = ["QUERIES", "run"]
