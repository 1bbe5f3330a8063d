"""All named queries and their SQL."""

from tidemark.plans import basics, boards, lake, models
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "basics", "boards", "lake", "models"]
