"""The operators bound to the test tables."""

from sheafline.plans.queries import QUERIES

__all__ = ["QUERIES"]
