"""Registered queries: every operator over the given tables, with its SQL twin."""

from __future__ import annotations

from . import cleaning, coding, layout, loading, quality, questions, reporting  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
