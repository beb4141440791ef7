"""The dashboard refresh (R1-R12) over the stored tables, one consistent ``as_of``.

Each panel is a lazily planned DataFrame; nothing is collected here. The five per-minute
panels share one aggregate definition, so a caller that wants all of them can ``persist``
``minute_stats`` once and derive the panels from it.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from costpulse.functions import timefn
from costpulse.operators import reports
from costpulse.sources import tables
from costpulse.streaming.jobs import Paths


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def panels(spark: SparkSession, paths: Paths, range_: str = timefn.DEFAULT_RANGE,
           as_of: dt.datetime | None = None) -> dict[str, DataFrame]:
    as_of = as_of or utc_now()
    start = timefn.range_start(as_of, range_)
    events = tables.events(spark, paths.events, since=start)
    rollups = tables.rollups(spark, paths.rollups, since=start)
    anomalies = tables.anomalies(spark, paths.anomalies, since=start)
    minute = reports.minute_model_stats(events, as_of, range_)
    return {
        "kpis": reports.kpis(events, as_of, range_),
        "active_anomalies": reports.active_anomalies(anomalies, as_of, range_),
        "minute_stats": minute,
        "event_rate": reports.event_rate(minute),
        "error_rate": reports.error_rate(minute),
        "latency_by_minute": reports.latency_by_minute(minute),
        "tokens_by_minute": reports.tokens_by_minute(minute),
        "cost_by_minute": reports.cost_by_minute(minute),
        "cost_by_model": reports.cost_by_model(rollups, as_of, range_),
        "recent_anomalies": reports.recent_anomalies(anomalies, as_of, range_),
        "live_feed": reports.live_feed(events, as_of, range_),
    }


def all_ranges(spark: SparkSession, paths: Paths, as_of: dt.datetime | None = None) -> DataFrame:
    """The KPI row (R1-R4) of every range offered, for a range picker: one scan of each table."""
    as_of = as_of or utc_now()
    widest = min(timefn.range_start(as_of, r) for r in timefn.ALLOWED_RANGES)
    return reports.kpis_by_range(tables.events(spark, paths.events, since=widest), as_of,
                                 tables.anomalies(spark, paths.anomalies, since=widest))


def refresh(spark: SparkSession, paths: Paths, range_: str = timefn.DEFAULT_RANGE,
            as_of: dt.datetime | None = None) -> dict:
    """One dashboard refresh: every panel as a pandas frame (Arrow transfer).

    The ranged, de-duplicated events are read once and kept for the refresh, and the
    per-minute aggregate is computed once for its five panels. Panel sizes are bounded by
    the range (minutes x models) or by the top-k, never by the table size.
    """
    as_of = as_of or utc_now()
    start = timefn.range_start(as_of, range_)
    events = tables.events(spark, paths.events, since=start).persist(StorageLevel.MEMORY_AND_DISK)
    minute = reports.minute_model_stats(events, as_of, range_).persist()
    try:
        rollups = tables.rollups(spark, paths.rollups, since=start)
        anomalies = tables.anomalies(spark, paths.anomalies, since=start)
        frames = {
            "kpis": reports.kpis(events, as_of, range_),
            "active_anomalies": reports.active_anomalies(anomalies, as_of, range_),
            "event_rate": reports.event_rate(minute),
            "error_rate": reports.error_rate(minute),
            "latency_by_minute": reports.latency_by_minute(minute),
            "tokens_by_minute": reports.tokens_by_minute(minute),
            "cost_by_minute": reports.cost_by_minute(minute),
            "cost_by_model": reports.cost_by_model(rollups, as_of, range_),
            "recent_anomalies": reports.recent_anomalies(anomalies, as_of, range_),
            "live_feed": reports.live_feed(events, as_of, range_),
        }
        return {name: df.toPandas() for name, df in frames.items()}
    finally:
        minute.unpersist()
        events.unpersist()
