"""Compare a query with its SQL text run by DuckDB over the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normal(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, as text, sorted."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in rows)


def both(spark, con, query, sql: str, sf_dir: str):
    got = query(spark, sf_dir)
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    return (sorted(got.columns), normal(got.columns, got.collect())), (
        sorted(want_columns),
        normal(want_columns, want.fetchall()),
    )
