"""All registered queries; importing a module registers its queries."""

from kandela.plans import window_queries  # noqa: F401
from kandela.plans import table_queries  # noqa: F401
from kandela.plans import stat_queries  # noqa: F401
from kandela.plans import stream_queries  # noqa: F401
from kandela.plans import model_queries  # noqa: F401  (the slow ones last)
from kandela.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
