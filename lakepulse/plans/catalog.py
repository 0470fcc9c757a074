"""All registered queries of the library."""

from __future__ import annotations

from . import alerts, checks, extra, features, frame, lake, layers, models, monitoring, more, players, scorecards, survival  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
