"""Differential check of a Spark result against a DuckDB text on the same Parquet tables.

Rows are compared as an order-insensitive multiset over name-sorted columns, with values
normalised to text (floats to 9 significant digits, decimals without trailing zeros).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


# Spark simple type name -> DuckDB type name (decimals print alike in both).
TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER",
              "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "date": "DATE",
              "boolean": "BOOLEAN"}


def compare(df, con, sql: str) -> tuple[bool, str]:
    """(equal, message) for a Spark DataFrame against a DuckDB query: column names, column
    types and the multiset of rows."""
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    ocols = list(rel.columns)
    otypes = dict(zip(ocols, [str(t) for t in rel.types]))
    orows = rel.fetchall()
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns differ: {sorted(df.columns)} vs {sorted(ocols)}"
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if otypes[f.name] != TYPE_NAMES.get(t, t.upper()):
            return False, f"type of {f.name}: spark {t}, oracle {otypes[f.name]}"
    a, b = multiset(df.columns, srows), multiset(ocols, orows)
    if a != b:
        return False, (f"rows differ ({len(srows)} vs {len(orows)}): "
                       f"only spark {list((a - b).elements())[:3]}, "
                       f"only oracle {list((b - a).elements())[:3]}")
    return True, f"{len(srows)} rows"
