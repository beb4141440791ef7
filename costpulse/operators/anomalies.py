"""A2 + U1: per-model window statistics and the three threshold detectors.

The detectors are one aggregate followed by ``inline(filter(array(...)))``: each window row
yields up to three anomaly rows in the same stage. A UNION ALL of three filtered copies
would, on a stream, keep one state store per arm; here there is one aggregate, one shuffle,
one state store.

Grain is window x model. With few models every group is "hot", which is why the measures
are all algebraic (count, sum, avg): the partial aggregate collapses each partition to one
row per group before the shuffle, whatever the skew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import timefn
from costpulse.operators.rollups import failure_flag, p95


@dataclass(frozen=True)
class Thresholds:
    """Warning and critical lines of the three detectors (``>=``); defaults are the fixed
    values in ``schemas``."""
    latency_warning_ms: float = schemas.LATENCY_LINES_MS[0]
    latency_critical_ms: float = schemas.LATENCY_LINES_MS[1]
    error_rate_warning: float = schemas.ERROR_RATE_LINES[0]
    error_rate_critical: float = schemas.ERROR_RATE_LINES[1]
    cost_warning_usd: float = schemas.COST_LINES_USD[0]
    cost_critical_usd: float = schemas.COST_LINES_USD[1]


DEFAULT_THRESHOLDS = Thresholds()


def window_stats(events: DataFrame, window_minutes: int = 5, with_p95: bool = False,
                 percentile: str = "exact", time_col: str = "ts") -> DataFrame:
    """Raw (unrounded) statistics per (window, model)."""
    window = F.window(time_col, timefn.minutes_interval(window_minutes))
    measures = [
        F.count(F.lit(1)).alias("total_requests"),
        F.avg(F.col("latency_ms").cast("double")).alias("avg_latency_ms"),
        (F.sum(failure_flag()).cast("double") / F.count(F.lit(1))).alias("error_rate"),
        F.sum("cost_usd").alias("total_cost_usd"),
    ]
    if with_p95:
        measures.append(p95(F.col("latency_ms"), percentile).alias("p95_latency_ms"))
    agg = events.groupBy(window.alias("window"), "model").agg(*measures)
    cols = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "model", "total_requests", "avg_latency_ms", "error_rate", "total_cost_usd"]
    if with_p95:
        cols.append("p95_latency_ms")
    return agg.select(*cols)


def rounded_stats(stats: DataFrame) -> DataFrame:
    """Window statistics at stored scales (for reports and comparisons)."""
    extra = ["p95_latency_ms"] if "p95_latency_ms" in stats.columns else []
    out = stats.select(
        "window_start", "window_end", "model", "total_requests",
        F.col("avg_latency_ms").cast(schemas.LATENCY_TYPE).alias("avg_latency_ms"),
        F.col("error_rate").cast("decimal(12,6)").alias("error_rate"),
        F.col("total_cost_usd").cast("decimal(28,6)").alias("total_cost_usd"),
        *[F.col(c).cast(schemas.LATENCY_TYPE).alias(c) for c in extra],
    )
    return out


def _arm(anomaly_type: str, metric: Column, warning: float, critical: float) -> Column:
    return F.struct(
        F.lit(anomaly_type).alias("anomaly_type"),
        metric.cast("double").alias("metric"),
        F.lit(float(warning)).alias("warning"),
        F.lit(float(critical)).alias("critical"),
    )


def event_time_detection(delay_seconds: int = 10) -> Column:
    """Detection time in a replay: the moment the watermark passes the window end."""
    return F.col("window_end") + F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")


def processing_time_detection() -> Column:
    """Wall-clock detection time of a live run."""
    return F.current_timestamp().cast("timestamp_ntz")


def detect(stats: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS,
           detected_at: Column | None = None) -> DataFrame:
    """U1 + F7 + P6-P9: anomaly rows in the stored ``anomaly_events`` shape.

    A NULL metric fails ``>=`` and yields no row; there is no minimum sample size.
    """
    t = thresholds
    arms = F.array(
        _arm("latency_spike", F.col("avg_latency_ms"), t.latency_warning_ms, t.latency_critical_ms),
        _arm("error_surge", F.col("error_rate"), t.error_rate_warning, t.error_rate_critical),
        _arm("cost_spike", F.col("total_cost_usd"), t.cost_warning_usd, t.cost_critical_usd),
    )
    hits = F.filter(arms, lambda a: a["metric"] >= a["warning"])
    detected = detected_at if detected_at is not None else event_time_detection()
    flagged = (stats.select("window_start", "window_end", "model", F.inline(hits))
                    .withColumn("detected_at", detected))
    critical = F.col("metric") >= F.col("critical")
    return flagged.select(
        F.col("detected_at").cast("timestamp_ntz").alias("detected_at"),
        "anomaly_type",
        "model",
        F.lit(None).cast("string").alias("user_id"),
        F.col("metric").cast(schemas.METRIC_TYPE).alias("metric_value"),
        F.when(critical, F.col("critical")).otherwise(F.col("warning"))
         .cast(schemas.METRIC_TYPE).alias("threshold_value"),
        F.when(critical, F.lit("critical")).otherwise(F.lit("warning")).alias("severity"),
        "window_start",
        "window_end",
    )


def anomalies(events: DataFrame, window_minutes: int = 5,
              thresholds: Thresholds = DEFAULT_THRESHOLDS,
              detected_at: Column | None = None) -> DataFrame:
    return detect(window_stats(events, window_minutes), thresholds, detected_at)
