"""SQL that DuckDB runs on the same tables to check the registered queries."""

from __future__ import annotations

from oracle import batch, reports, streams

SQL: dict[str, str] = {**batch.SQL, **reports.SQL, **streams.SQL}
