"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = ["fingerprints", "simhash", "exact_dedup", "pieces", "substring", "quality", "packing", "secrets", "urls", "pii", "length_packing", "spelling", "merkle"]


def load() -> tuple[dict, dict]:
    queries, oracle = {}, {}
    for name in MODULES:
        module = importlib.import_module(f"mosaica.llm.{name}")
        queries |= module.QUERIES
        oracle |= module.ORACLE
    return queries, oracle
