"""All registered queries."""

from __future__ import annotations

from minegrain.plans import cluster_queries, factor_queries, file_queries, letor_queries, linear_queries, link_queries, rating_queries, text_model_queries, text_queries  # noqa: F401
from minegrain.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
