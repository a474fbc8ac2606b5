"""All registered queries."""

from . import evaluation, files, modelling, preparation, recommender, relational, scalars, statistics, texts  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
