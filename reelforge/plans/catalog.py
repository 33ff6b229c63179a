"""All queries, by name."""

from reelforge.plans import (  # noqa: F401  (importing a module registers its queries)
    feature_queries, hygiene_queries, join_queries, model_queries, profile_queries, stream_queries, text_queries, time_queries,
)
from reelforge.plans.registry import QUERIES

__all__ = ["QUERIES"]
