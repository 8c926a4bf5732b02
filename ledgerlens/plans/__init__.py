"""Query catalogue: importing this package registers every query."""

from ledgerlens.plans import analytics_queries, cleaning_queries, load_queries, text_ml_queries  # noqa: F401
from ledgerlens.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
