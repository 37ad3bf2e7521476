"""All registered queries and oracles."""

from __future__ import annotations

from aerolith.driver import groups, rows, serving, storage, streams  # noqa: F401  (registration)
from aerolith.driver.binding import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
