"""Every query of the library, by name, with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}
