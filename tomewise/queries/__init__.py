"""Registered queries with the SQL each is checked against."""

from . import (  # noqa: F401  (importing registers)
    cleaning_queries,
    fit_queries,
    model_queries,
    numeric_queries,
    run_queries,
    scoring_queries,
    similarity_queries,
    source_queries,
    text_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
