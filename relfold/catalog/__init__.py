"""The runnable queries: each operator and feature block on the star-schema tables, with the same thing in SQL."""

from relfold.catalog import rows, folds, shapes, learning, blocks  # noqa: F401, I001
from relfold.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
