"""Compare queries with their SQL on the same tables, as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    sql_columns = con.sql(sql).columns
    if sorted(sql_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(sql_columns)}"
    columns = sorted(df.columns)
    ours = df.select(*columns).toArrow()
    theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").to_arrow_table()
    for name, a, b in zip(columns, ours.schema.types, theirs.schema.types):
        if str(a).replace("large_", "") != str(b).replace("large_", ""):
            return f"type of {name}: {a} against {b}"
    left = Counter(zip(*(ours[c].to_pylist() for c in columns)))
    right = Counter(zip(*(theirs[c].to_pylist() for c in columns)))
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} rows against {sum(right.values())}; "
        f"extra {list(only_left.items())[:3]}, missing {list(only_right.items())[:3]}"
    )
