"""The registered queries, each with the SQL that must give the same rows."""

from larkspur.plans import learning, preparing, recommending, relational, scans  # noqa: F401
from larkspur.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
