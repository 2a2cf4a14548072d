"""Imports every query module so the registry is complete."""

from __future__ import annotations

from holdfast.plans import delay_queries, ring_queries, store_queries, stream_queries  # noqa: F401
from holdfast.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
