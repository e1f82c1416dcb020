"""Compare Spark rows with the rows DuckDB gives for the same question."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return format(value, ".9g")
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    cursor = con.execute(sql)
    duck_names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    ours = df.collect()
    if sorted(n.lower() for n in df.columns) != sorted(n.lower() for n in duck_names):
        return f"columns {sorted(df.columns)} != {sorted(duck_names)}"
    a, b = _bag(df.columns, ours), _bag(duck_names, theirs)
    if a != b:
        return f"{len(ours)} rows, {len(theirs)} expected; extra {list((a - b).items())[:2]}, missing {list((b - a).items())[:2]}"
    return None if ours else "no rows"
