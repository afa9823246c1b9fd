"""Queries on the shared test tables, one or more per operator."""

from . import catalog_queries, metadata_queries, source_queries, text_queries, work_queries
from .registry import ORACLES, QUERIES

flagship = QUERIES["planned_units"]

__all__ = ["ORACLES", "QUERIES", "flagship"]
