"""Queries over the test tables, and the SQL each must agree with."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
