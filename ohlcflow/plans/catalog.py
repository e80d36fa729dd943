"""All registered queries (imports register them)."""

from . import q_forecast, q_bars, q_text, q_ml, q_model, q_stream  # noqa: F401
from .registry import REGISTRY, oracle_of, rounded  # noqa: F401
