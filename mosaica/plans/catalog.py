"""Named queries over the driver tables with their DuckDB SQL."""

from __future__ import annotations

from mosaica.plans import queries_files, queries_joins, queries_models, queries_points, queries_rasters, queries_sheets, queries_space, queries_tables

QUERIES: dict = {}
ORACLE: dict = {}
for _module in (queries_tables, queries_joins, queries_rasters, queries_models, queries_sheets, queries_space, queries_files, queries_points):
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
