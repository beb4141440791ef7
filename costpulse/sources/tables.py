"""S7-S9 + K9: readers of the stored tables with range pruning.

Tables are Parquet, partitioned by a ``dt`` date column derived from their time column and
sorted by (model, time) within files. A trailing range ``time >= since`` becomes two
predicates: ``dt >= date(since)`` prunes whole directories at planning time, and
``time >= since`` is pushed into the Parquet reader to skip row groups by min/max stats.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse import schemas
from costpulse.functions import timefn
from costpulse.operators.rollups import SKETCH
from costpulse.sinks import keyindex
from costpulse.sinks.tables import latest_by_key, partition_dates, read_deliveries, table_exists

TIME_COLUMN = {"events": "ts", "rollups": "window_start", "anomalies": "detected_at"}


def read_ranged(spark: SparkSession, path: str, time_col: str,
                since: dt.datetime | None = None, date_col: str = "dt",
                schema: T.StructType | None = None,
                extra: tuple[T.StructField, ...] = ()) -> DataFrame:
    """The stored rows of the range; a table nothing was written to yet has ``schema``, the
    ``extra`` columns (null where not stored) and no rows."""
    if schema is not None and not table_exists(spark, path):
        return spark.createDataFrame([], T.StructType([*extra, *schema.fields]))
    df = read_deliveries(spark, path, extra)
    if since is not None:
        df = df.where((F.col(date_col) >= F.lit(since.date()))
                      & (F.col(time_col) >= timefn.ntz_lit(since)))
    return df


MERGE_COLUMNS = ("batch_id", "arrival_key")
EVENT_INDEX = keyindex.KeyIndex(("event_id",), "ts")


def _stored(schema: T.StructType, *numbers: str) -> T.StructType:
    """``schema`` with nullable columns and the folder columns of a stored table."""
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in numbers),
                         T.StructField("dt", T.DateType())])


def events(spark: SparkSession, path: str, since: dt.datetime | None = None,
           latest: bool = True) -> DataFrame:
    """Landed events in the ``llm_events`` shape.

    A merge-on-read table (it has ``batch_id``) holds every delivery; ``latest`` keeps the
    newest per event_id (the last batch, then the last arrival) with one aggregate over the
    range read; an event whose newest delivery lies before the range is not in it, which the
    table's key index tells without opening data outside the range. An upserted table is
    already one row per event_id.
    """
    return _latest(spark, read_ranged(spark, path, "ts", since,
                                      schema=_stored(schemas.LLM_EVENTS)), path, ["event_id"],
                   list(MERGE_COLUMNS), latest, since, EVENT_INDEX)


def _latest(spark: SparkSession, df: DataFrame, path: str, key: list[str], order: list[str],
            latest: bool, since: dt.datetime | None = None,
            index: keyindex.KeyIndex | None = None) -> DataFrame:
    """Merge-on-read: one row per key over all dates read, compacted or not (a key re-sent
    under another date is resolved across them), without the bookkeeping columns. ``index``
    resolves a range against the deliveries before it."""
    if "batch_id" not in df.columns:
        return df.drop("dt")
    if latest:
        df = latest_by_key(df, key, order)
        if since is not None and index is not None:
            df = keyindex.current(spark, path, df, since, index)
    return df.drop("dt", *[c for c in order if c in df.columns])


def rollups(spark: SparkSession, path: str, since: dt.datetime | None = None,
            latest: bool = True, sketches: bool = False) -> DataFrame:
    """Stored rollups; for an appended table the last batch per key (see ``events``). With
    ``sketches`` the latency sketch comes along (null where none was stored); a key's window
    start fixes its date, so a range never separates deliveries of one key."""
    extra = (T.StructField(SKETCH, T.BinaryType()),) if sketches else ()
    found = read_ranged(spark, path, "window_start", since, schema=_stored(schemas.COST_ROLLUPS),
                        extra=extra)
    if not sketches:
        found = found.drop(SKETCH)
    return _latest(spark, found, path, list(schemas.ROLLUP_KEY), ["batch_id"], latest)


def newest_time(spark: SparkSession, path: str, time_col: str) -> dt.datetime | None:
    """The newest ``time_col`` of a stored table, from its newest date alone."""
    dates = partition_dates(spark, path)
    if not dates:
        return None
    newest = read_deliveries(spark, path).where(F.col("dt") == F.lit(dates[-1]).cast("date"))
    return newest.agg(F.max(time_col)).first()[0]


def anomalies(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Stored anomalies (append-only; ``batch_id`` kept for audit)."""
    return read_ranged(spark, path, "detected_at", since,
                       schema=_stored(schemas.ANOMALY_EVENTS, "batch_id")).drop("dt")


def window_levels(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Stored window statistics of every length (``minutes``); each window is stored once."""
    fields = ("minutes int, window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "total_requests long, avg_latency_ms double, error_rate double, "
              "total_cost_usd decimal(28,6), batch_id long, dt date")
    return read_ranged(spark, path, "window_start", since,
                       schema=T.StructType.fromDDL(fields)).drop("dt", "batch_id")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """T5: messages that came after their window was closed, stored so far."""
    more = [T.StructField(n, T.TimestampNTZType()) for n in ("event_time", "window_end", "watermark")]
    schema = T.StructType([*schemas.QUARANTINE.fields, T.StructField("event_id", T.StringType()), *more,
                           T.StructField("batch_id", T.LongType()), T.StructField("dt", T.DateType())])
    return read_ranged(spark, path, "event_time", schema=schema).drop("dt")


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """K7: the dead letters stored so far."""
    return read_ranged(spark, path, "arrival_time", schema=_stored(schemas.QUARANTINE, "batch_id"))


def jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
         partition_column: str | None = None, lower: int | None = None,
         upper: int | None = None, partitions: int = 8) -> DataFrame:
    """A table from a JDBC database (driver jar required), read in ``partitions``
    parallel ranges of ``partition_column`` when given. Errors propagate."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", partitions))
    return reader.load()
