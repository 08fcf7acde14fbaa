"""Compare a Spark result with a DuckDB result as bags of rows."""

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(_plain(value)).__name__


def spark_rows(df):
    order = sorted(df.columns)
    return order, [tuple(_plain(r[c]) for c in order) for r in df.collect()]


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    at = [names.index(n) for n in sorted(names)]
    return sorted(names), [tuple(_plain(row[i]) for i in at) for row in cursor.fetchall()]


def difference(df, connection, sql) -> str | None:
    """None if equal, else a short description."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(connection, sql)
    if left_names != right_names:
        return f"columns {left_names} against {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    missing, extra = Counter(right) - Counter(left), Counter(left) - Counter(right)
    if missing or extra:
        return (f"{sum(missing.values())} rows differ: spark {list(extra)[:2]} "
                f"oracle {list(missing)[:2]} of {left_names}")
    for i, name in enumerate(left_names):
        kinds = [{_kind(r[i]) for r in rows if r[i] is not None} for rows in (left, right)]
        if kinds[0] != kinds[1]:
            return f"types of {name}: {kinds}"
    return None
