"""K1/K2/K3/K6 for a JDBC database (PostgreSQL dialect), when results must live there.

* ``append``: parallel batched inserts (``batchsize`` rows per round trip, at most
  ``max_connections`` tasks writing at once); failed tasks are retried by Spark
  (``spark.task.maxFailures``).
* ``upsert``: executors bulk-load a staging table of this call's own in parallel, then one
  ``INSERT .. SELECT .. ON CONFLICT (key) DO UPDATE`` statement merges it inside the
  database. No row passes through the driver; the driver only issues the statement.

Needs the database's JDBC driver on the classpath (not installed here, so this module is
not exercised by the tests; the Parquet sinks are the tested path).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def append(df: DataFrame, url: str, table: str, properties: dict[str, str],
           batchsize: int = 500, max_connections: int = 16) -> None:
    (df.repartition(max_connections).write.format("jdbc").mode("append")
       .option("url", url).option("dbtable", table).option("batchsize", int(batchsize))
       .options(**properties).save())


def _execute(spark: SparkSession, url: str, properties: dict[str, str], sql: str) -> None:
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        stmt.executeUpdate(sql)
        stmt.close()
    finally:
        conn.close()


def upsert_sql(table: str, staging: str, columns: Sequence[str], key: Sequence[str]) -> str:
    cols = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in key)
    return (f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} "
            f"ON CONFLICT ({', '.join(key)}) DO UPDATE SET {updates}")


def upsert(spark: SparkSession, df: DataFrame, url: str, table: str, key: Sequence[str],
           properties: dict[str, str], staging: str | None = None, batchsize: int = 500,
           max_connections: int = 16) -> None:
    """Keyed upsert; ``df`` must hold one row per key (see ``sinks.tables.latest_by_key``)."""
    staging = staging or f"{table}_staging_{uuid.uuid4().hex[:12]}"
    (df.repartition(max_connections).write.format("jdbc").mode("overwrite")
       .option("truncate", "true").option("url", url).option("dbtable", staging)
       .option("batchsize", int(batchsize)).options(**properties).save())
    _execute(spark, url, properties, upsert_sql(table, staging, df.columns, key))
    _execute(spark, url, properties, f"DROP TABLE {staging}")
