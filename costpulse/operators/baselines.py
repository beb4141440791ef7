"""Detectors against a rolling baseline of each model's previous windows.

Input is the per-(window, model) statistics table, whose size grows with the covered time
span and the number of models, not with event volume: a year of 5-minute windows is about
105k rows per model. Partitioning the window function by model is therefore bounded by
design; the event-level work (the aggregate feeding it) is the skew-proof partial
aggregate of ``anomalies.window_stats``.

Flags are decided in exact decimal arithmetic by cross-multiplying
(``metric * n > factor * sum``), so no division result decides a boundary. On a stream the
previous windows come along as arrays from keyed state (``streaming.stateful``), since OVER
clauses are not allowed on streaming DataFrames; ``from_history`` applies the same rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.operators.anomalies import event_time_detection


@dataclass(frozen=True)
class BaselineConfig:
    """The documented baseline rules; defaults are the fixed values in ``schemas``."""
    lookback: int = schemas.BASELINE_WINDOWS                       # previous windows
    latency_warning_ratio: int = schemas.LATENCY_BASELINE_RATIOS[0]   # p95 > r x baseline
    latency_critical_ratio: int = schemas.LATENCY_BASELINE_RATIOS[1]
    cost_warning_ratio: int = schemas.COST_BASELINE_RATIO          # cost > r x average
    z_warning: float = schemas.Z_SCORE_LINE                        # |z| > line


DEFAULT_BASELINE = BaselineConfig()


def _previous(lookback: int):
    return (Window.partitionBy("model").orderBy("window_start")
                  .rowsBetween(-int(lookback), -1))


def _ratio_rows(stats: DataFrame, metric: str, anomaly_type: str, lookback: int,
                warning: int, critical: int | None, detected_at: Column | None) -> DataFrame:
    frame = _previous(lookback)
    return _flagged(stats.select(
        "window_start", "window_end", "model", F.col(metric).alias("metric"),
        F.sum(metric).over(frame).alias("base_sum"),
        F.count(metric).over(frame).alias("base_n"),
    ), anomaly_type, warning, critical, detected_at)


def _flagged(with_base: DataFrame, anomaly_type: str, warning: int, critical: int | None,
             detected_at: Column | None) -> DataFrame:
    """Anomalies of windows with the sum and number of their baseline's values."""
    above = lambda factor: (F.col("base_n") > 0) & (
        F.col("metric") * F.col("base_n") > F.lit(Decimal(factor)) * F.col("base_sum"))
    is_critical = above(critical) if critical is not None else F.lit(False)
    factor = F.when(is_critical, F.lit(Decimal(critical or warning))) \
        .otherwise(F.lit(Decimal(warning)))
    flagged = with_base.where(above(warning))
    detected = detected_at if detected_at is not None else event_time_detection()
    return flagged.select(
        detected.cast("timestamp_ntz").alias("detected_at"),
        F.lit(anomaly_type).alias("anomaly_type"),
        "model",
        F.lit(None).cast("string").alias("user_id"),
        F.col("metric").cast(schemas.METRIC_TYPE).alias("metric_value"),
        (factor * F.col("base_sum") / F.col("base_n")).cast(schemas.METRIC_TYPE)
        .alias("threshold_value"),
        F.when(is_critical, F.lit("critical")).otherwise(F.lit("warning")).alias("severity"),
        "window_start", "window_end",
    )


def latency_baseline(stats: DataFrame, config: BaselineConfig = DEFAULT_BASELINE,
                     detected_at: Column | None = None) -> DataFrame:
    """Window p95 latency (stored scale) against the mean p95 of the previous windows.
    ``stats`` needs ``p95_latency_ms`` (``window_stats(..., with_p95=True)``)."""
    src = stats.withColumn("p95", F.col("p95_latency_ms").cast(schemas.LATENCY_TYPE))
    return _ratio_rows(src, "p95", "latency_spike", config.lookback,
                       config.latency_warning_ratio, config.latency_critical_ratio, detected_at)


def cost_baseline(stats: DataFrame, config: BaselineConfig = DEFAULT_BASELINE,
                  detected_at: Column | None = None) -> DataFrame:
    """Window cost against the rolling average cost of the previous windows."""
    # 16 integer digits: products with the factor and the window count stay exact.
    src = stats.withColumn("cost", F.col("total_cost_usd").cast("decimal(22,6)"))
    return _ratio_rows(src, "cost", "cost_spike", config.lookback,
                       config.cost_warning_ratio, None, detected_at)


def zscores(stats: DataFrame, config: BaselineConfig = DEFAULT_BASELINE) -> DataFrame:
    """z = (x - mean) / stddev_samp over the previous windows, for average latency and
    error rate; rows with |z| > z_warning. A constant history (stddev 0) yields no z."""
    metrics = F.array(
        F.struct(F.lit("avg_latency_ms").alias("metric"),
                 F.col("avg_latency_ms").cast("double").alias("value")),
        F.struct(F.lit("error_rate").alias("metric"),
                 F.col("error_rate").cast("double").alias("value")),
    )
    long = stats.select("window_start", "window_end", "model", F.inline(metrics))
    frame = Window.partitionBy("model", "metric").orderBy("window_start") \
        .rowsBetween(-int(config.lookback), -1)
    scored = long.select(
        "*",
        F.avg("value").over(frame).alias("mean"),
        F.stddev_samp("value").over(frame).alias("stddev"),
    )
    return _beyond(scored, config)


def _beyond(scored: DataFrame, config: BaselineConfig) -> DataFrame:
    """The rows with |z| above the line, at stored scales."""
    scored = scored.withColumn(
        "z", (F.col("value") - F.col("mean")) / F.nullif(F.col("stddev"), F.lit(0.0)))
    return (scored.where(F.abs(F.col("z")) > F.lit(float(config.z_warning)))
                  .select("window_start", "window_end", "model", "metric",
                          F.col("value").cast(schemas.METRIC_TYPE).alias("value"),
                          F.col("mean").cast(schemas.METRIC_TYPE).alias("mean"),
                          F.col("stddev").cast(schemas.METRIC_TYPE).alias("stddev"),
                          F.col("z").cast(schemas.METRIC_TYPE).alias("z")))


def zscore_anomalies(zrows: DataFrame, config: BaselineConfig = DEFAULT_BASELINE,
                     detected_at: Column | None = None) -> DataFrame:
    """N4 rows in the ``anomaly_events`` shape: metric_value = z, threshold = z_warning."""
    detected = detected_at if detected_at is not None else event_time_detection()
    kind = F.when(F.col("metric") == "error_rate", F.lit("error_surge")) \
        .otherwise(F.lit("latency_spike"))
    return zrows.select(
        detected.cast("timestamp_ntz").alias("detected_at"),
        kind.alias("anomaly_type"), "model",
        F.lit(None).cast("string").alias("user_id"),
        F.col("z").alias("metric_value"),
        F.lit(Decimal(str(config.z_warning))).cast(schemas.METRIC_TYPE).alias("threshold_value"),
        F.lit("warning").alias("severity"),
        "window_start", "window_end",
    )


def _moments(values: Column) -> tuple[Column, Column]:
    """(mean, sample standard deviation) of an array's numbers, nulls left out, by the running
    update that Spark's own aggregates use, so both paths round alike."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("total"), F.lit(0.0).alias("mean"),
                     F.lit(0.0).alias("m2"))

    def add(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1.0
        delta = x - acc["mean"]
        step = delta / n
        return F.when(x.isNull(), acc).otherwise(F.struct(
            n.alias("n"), (acc["total"] + x).alias("total"), (acc["mean"] + step).alias("mean"),
            (acc["m2"] + delta * (delta - step)).alias("m2")))

    done = F.aggregate(values, start, add)
    return (F.when(done["n"] > 0, done["total"] / done["n"]),
            F.when(done["n"] > 1, F.sqrt(done["m2"] / (done["n"] - 1.0))))


def from_history(rows: DataFrame, config: BaselineConfig = DEFAULT_BASELINE,
                 detected_at: Column | None = None) -> DataFrame:
    """N2-N4 of windows that carry their previous windows (``stateful.with_history``), in the
    ``anomaly_events`` shape; row by row, without a shuffle."""
    def base(metric: Column, previous: str, kind: str) -> DataFrame:
        known = F.filter(previous, lambda x: x.isNotNull())
        # the sum has the type that SUM gives
        total = F.aggregate(known, F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind))
        return rows.select("window_start", "window_end", "model", metric.alias("metric"),
                           total.alias("base_sum"), F.size(known).cast("bigint").alias("base_n"))

    latency = _flagged(base(F.col("p95_latency_ms").cast(schemas.LATENCY_TYPE), "previous_p95",
                            "decimal(22,2)"), "latency_spike", config.latency_warning_ratio,
                       config.latency_critical_ratio, detected_at)
    cost = _flagged(base(F.col("total_cost_usd").cast("decimal(22,6)"), "previous_cost",
                         "decimal(32,6)"), "cost_spike", config.cost_warning_ratio, None, detected_at)
    metrics = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"),
                                 _moments(F.col(previous))[0].alias("mean"),
                                 _moments(F.col(previous))[1].alias("stddev"))
                        for name, previous in (("avg_latency_ms", "previous_latency"),
                                               ("error_rate", "previous_errors"))])
    scored = rows.select("window_start", "window_end", "model", F.inline(metrics))
    return latency.unionByName(cost).unionByName(
        zscore_anomalies(_beyond(scored, config), config, detected_at))
