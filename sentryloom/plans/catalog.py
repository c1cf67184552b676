"""All queries of the library by name, with their DuckDB SQL."""

from __future__ import annotations

from . import q_content, q_ingest, q_records, q_reports, q_scalar, q_sources, q_windows

MODULES = (q_scalar, q_windows, q_reports, q_content, q_sources, q_records, q_ingest)
QUERIES: dict = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
