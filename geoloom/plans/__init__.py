"""Queries over the domain tables, each with its DuckDB twin. Importing this package registers them all."""

from . import grids, matching, metrics, report, stream, tiles  # noqa: F401
