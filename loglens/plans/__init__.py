"""Named queries over the driver's tables, and their SQL oracles."""

from . import baseline_queries, forecast_queries, io_queries, log_queries, model_queries  # noqa: F401  (register queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
