"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

from .queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
