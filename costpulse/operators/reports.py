"""The dashboard's time-range reports over the stored tables.

Every report takes an explicit ``as_of`` (one consistent "now" per refresh) and a range
from ``timefn.ALLOWED_RANGES``. The bound is a literal, so on the stored, date-partitioned
tables it prunes partitions and is pushed into the Parquet scan.

R5-R9 are projections of one per-(minute, model) aggregate: a dashboard refresh computes it
once (``minute_model_stats``), and a single report keeps only the measures it reads
(Catalyst drops unused aggregate expressions).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import timefn
from costpulse.operators.rollups import failure_flag

TOP_K = 100


def _in_range(df: DataFrame, column: str, as_of: dt.datetime, range_: str) -> DataFrame:
    return df.where(timefn.since(column, as_of, range_))


def _is_success() -> Column:
    return F.col("status") == F.lit(schemas.SUCCESS)


def _round_avg(total: Column, count: Column) -> Column:
    """ROUND(AVG(int), 0) of exact integer inputs, as BIGINT (half up)."""
    return F.round(total.cast("double") / count).cast("bigint")


# ------------------------------------------------------------------------------ KPIs

def kpis(events: DataFrame, as_of: dt.datetime,
         range_: str = timefn.DEFAULT_RANGE) -> DataFrame:
    """R1-R3 in one row from a single scan of the events (R4 reads the anomalies)."""
    return _in_range(events, "ts", as_of, range_).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.coalesce(F.round(F.sum("cost_usd"), 4), F.lit(0)).cast("decimal(18,4)")
         .alias("total_cost_usd"),
        F.coalesce(F.round(F.avg(F.when(_is_success(), F.col("latency_ms")))), F.lit(0))
         .cast("bigint").alias("avg_latency_ms"),
    )


def kpis_by_range(events: DataFrame, as_of: dt.datetime, anomalies: DataFrame | None = None,
                  ranges: tuple[str, ...] = timefn.ALLOWED_RANGES) -> DataFrame:
    """R1-R3 (and R4 when ``anomalies`` are given) of every trailing range in one scan:
    (report_range, total_requests, total_cost_usd, avg_latency_ms[, active_anomalies]).

    The ranges nest, so each row is summed once, in the ring between two neighbouring lower
    bounds, and a range is the running sum of its own ring and the smaller ones (a handful of
    rows). An empty range has zeros. Bounds are literals: the widest reaches the scan."""
    order = sorted(ranges, key=lambda r: timefn.range_start(as_of, r), reverse=True)
    starts = [timefn.ntz_lit(timefn.range_start(as_of, r)) for r in order]

    def ring(column: str) -> Column:
        return F.coalesce(*[F.when(F.col(column) >= s, F.lit(i)) for i, s in enumerate(starts)])

    success = F.when(_is_success(), F.col("latency_ms").cast("bigint"))
    sums = {"requests": F.count(F.lit(1)), "cost": F.sum("cost_usd"), "latency": F.sum(success),
            "timed": F.count(success)}
    rings = (_in_range(events, "ts", as_of, order[-1]).groupBy(ring("ts").alias("ring"))
             .agg(*[c.alias(n) for n, c in sums.items()]))
    names = list(sums)
    if anomalies is not None:
        found = (_in_range(anomalies, "detected_at", as_of, order[-1])
                 .groupBy(ring("detected_at").alias("ring")).agg(F.count(F.lit(1)).alias("found")))
        rings = rings.unionByName(found, allowMissingColumns=True)
        names.append("found")
    # at most two rows a ring: every range adds up the rings up to its own
    summed = rings.agg(*[F.sum(F.when(F.col("ring") <= i, F.col(n))).alias(f"{n}_{i}")
                         for i in range(len(order)) for n in names])
    ranges_ = F.array(*[F.struct(F.lit(r).alias("report_range"), *[F.col(f"{n}_{i}").alias(n) for n in names])
                        for i, r in enumerate(order)])
    extra = [] if anomalies is None else [F.coalesce("found", F.lit(0).cast("bigint")).alias("active_anomalies")]
    return summed.select(F.inline(ranges_)).select(
        "report_range", F.coalesce("requests", F.lit(0).cast("bigint")).alias("total_requests"),
        F.coalesce(F.round("cost", 4), F.lit(0)).cast("decimal(18,4)").alias("total_cost_usd"),
        F.coalesce(_round_avg(F.col("latency"), F.col("timed")), F.lit(0)).cast("bigint")
         .alias("avg_latency_ms"), *extra)


def total_requests(events, as_of, range_=timefn.DEFAULT_RANGE) -> DataFrame:
    """R1."""
    return _in_range(events, "ts", as_of, range_).agg(F.count(F.lit(1)).alias("cnt"))


def total_cost(events, as_of, range_=timefn.DEFAULT_RANGE) -> DataFrame:
    """R2: COALESCE(ROUND(SUM(cost), 4), 0)."""
    return _in_range(events, "ts", as_of, range_).agg(
        F.coalesce(F.round(F.sum("cost_usd"), 4), F.lit(0)).cast("decimal(18,4)").alias("cost"))


def avg_success_latency(events, as_of, range_=timefn.DEFAULT_RANGE) -> DataFrame:
    """COALESCE(ROUND(AVG(latency) of successes, 0), 0)."""
    return (_in_range(events, "ts", as_of, range_).where(_is_success())
            .agg(F.coalesce(F.round(F.avg("latency_ms")), F.lit(0)).cast("bigint").alias("lat")))


def active_anomalies(anomalies, as_of, range_=timefn.DEFAULT_RANGE) -> DataFrame:
    """Anomalies detected in range."""
    return (_in_range(anomalies, "detected_at", as_of, range_)
            .agg(F.count(F.lit(1)).alias("active_anomalies")))


# ------------------------------------------------------------------------------ per minute

def minute_model_stats(events: DataFrame, as_of: dt.datetime,
                       range_: str = timefn.DEFAULT_RANGE) -> DataFrame:
    """One aggregate per (minute, model) holding every per-minute measure."""
    success = _is_success()
    return (_in_range(events, "ts", as_of, range_)
            .groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("time"), "model")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(failure_flag()).alias("failures"),
                 F.sum(F.when(success, 1).otherwise(0)).alias("successes"),
                 F.sum(F.when(success, F.col("latency_ms").cast("bigint"))).alias("success_latency"),
                 F.sum(F.col("total_tokens").cast("bigint")).alias("total_tokens"),
                 F.sum("cost_usd").alias("cost_usd")))


def event_rate(stats: DataFrame) -> DataFrame:
    """Events per minute and model."""
    return stats.select("time", "model", "events").orderBy("time", "model")


def error_rate(stats: DataFrame) -> DataFrame:
    """ROUND(100.0 * failures / events, 2) per minute and model (exact decimal)."""
    pct = F.lit(Decimal("100.0")) * F.col("failures") / F.col("events")
    return (stats.select("time", "model", F.round(pct, 2).cast("decimal(7,2)").alias("error_rate"))
                 .orderBy("time", "model"))


def latency_by_minute(stats: DataFrame) -> DataFrame:
    """ROUND(AVG(latency), 0) of successes per minute and model."""
    return (stats.where(F.col("successes") > 0)
                 .select("time", "model",
                         _round_avg(F.col("success_latency"), F.col("successes"))
                         .alias("avg_latency_ms"))
                 .orderBy("time", "model"))


def tokens_by_minute(stats: DataFrame) -> DataFrame:
    """SUM(total_tokens) per minute and model."""
    return stats.select("time", "model", "total_tokens").orderBy("time", "model")


def cost_by_minute(stats: DataFrame) -> DataFrame:
    """ROUND(SUM(cost), 6) per minute and model."""
    return (stats.select("time", "model",
                         F.round(F.col("cost_usd"), 6).cast("decimal(18,6)").alias("cost_usd"))
                 .orderBy("time", "model"))


# ------------------------------------------------------------------------------ rollups

def cost_by_model(rollups: DataFrame, as_of: dt.datetime,
                  range_: str = timefn.DEFAULT_RANGE) -> DataFrame:
    """SUM(total_cost_usd) per model over stored rollups (4 decimals), largest first."""
    return (_in_range(rollups, "window_start", as_of, range_)
            .groupBy("model")
            .agg(F.sum("total_cost_usd").cast("decimal(38,4)").alias("total_cost"))
            .orderBy(F.desc("total_cost"), "model"))


# ------------------------------------------------------------------------------ top-k feeds

def recent_anomalies(anomalies: DataFrame, as_of: dt.datetime,
                     range_: str = timefn.DEFAULT_RANGE, k: int = TOP_K) -> DataFrame:
    """The newest ``k`` anomalies (top-k per partition, then one merge of k rows each)."""
    return (_in_range(anomalies, "detected_at", as_of, range_)
            .orderBy(F.desc("detected_at"), "anomaly_type", "model", F.desc("window_start"))
            .limit(k)
            .select("detected_at", "anomaly_type", "severity", "model", "user_id",
                    F.round("metric_value", 4).cast(schemas.METRIC_TYPE).alias("metric_value"),
                    F.round("threshold_value", 4).cast(schemas.METRIC_TYPE)
                     .alias("threshold_value"),
                    "window_start", "window_end"))


def live_feed(events: DataFrame, as_of: dt.datetime,
              range_: str = timefn.DEFAULT_RANGE, k: int = TOP_K) -> DataFrame:
    """The newest ``k`` events; ties on ts broken by event_id."""
    return (_in_range(events, "ts", as_of, range_)
            .orderBy(F.desc("ts"), "event_id")
            .limit(k)
            .select(F.col("ts").alias("time"), "model", "user_id", "prompt_tokens",
                    "completion_tokens",
                    F.round("cost_usd", 6).cast(schemas.COST_TYPE).alias("cost_usd"),
                    "latency_ms", "status",
                    F.coalesce(F.col("error_code"), F.lit("")).alias("error_code")))
