"""Registered queries over the given tables, each with its oracle SQL."""

from . import q_functions, q_inject, q_loads, q_models, q_quality, q_reports, q_sources, q_streaming  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
