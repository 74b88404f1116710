"""The operators as queries over the driver tables, each next to its SQL.

A query takes a session and a folder of tables and returns a frame; its SQL
gives the same rows from the same tables in another engine.
"""

from __future__ import annotations

from flowkit.catalog import frames, models, parsing, skewed, streams, texts
from flowkit.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "frames", "models", "parsing", "skewed", "streams", "texts"]
