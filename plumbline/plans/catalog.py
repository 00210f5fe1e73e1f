"""Registered queries and their SQL oracles."""

from __future__ import annotations

from plumbline.plans import feeds, funnel, queues, records, repair, rollups, search, vectors, writes
from plumbline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "feeds", "funnel", "queues", "records", "repair", "rollups", "search", "vectors", "writes"]
