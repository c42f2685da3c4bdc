"""Operators of a training-data pipeline and their queries. Nothing outside this folder imports it."""

from skygrid.llm import queries as _queries  # noqa: F401
from skygrid.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
