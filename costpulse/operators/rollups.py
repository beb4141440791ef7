"""A1 + N1: tumbling-window cost and usage rollups per (window, model, provider, user).

Same function for batch and streaming (add ``withWatermark`` upstream for streams). The plan
is a partial aggregate per input partition, one shuffle on the grouping keys, and a final
merge; a hot user or model is combined map-side before the shuffle, so one key holding a
third of all rows still ships one partial row per input partition.

p95 latency: ``exact`` uses ``percentile`` whose buffer is a histogram of distinct latency
values (bounded by the integer latency domain, not by the row count); ``approx`` uses
``percentile_approx`` with a fixed-size sketch for very wide groups; ``sketch`` keeps a KLL
sketch beside the rollup (``latency_sketch``), which ``merged_rollups`` combines over windows,
users or models without the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import timefn

APPROX_ACCURACY = 10_000

# Size parameter of the latency sketches. A group of up to SKETCH_K calls is kept exactly; beyond,
# the rank of a quantile is off by at most SKETCH_RANK_ERROR of the calls (99 % confidence; 2.296 /
# k^0.9021 for one quantile), and a sketch holds about 3 k numbers however many calls it saw.
SKETCH_K = 800
SKETCH_RANK_ERROR = 0.0056
SKETCH = "latency_sketch"


def p95(latency: Column, mode: str = "exact") -> Column:
    if mode == "exact":
        return F.percentile(latency, F.lit(0.95))
    if mode == "approx":
        return F.percentile_approx(latency, 0.95, APPROX_ACCURACY).cast("double")
    raise ValueError(f"unknown percentile mode {mode!r}")


def latency_sketch(latency: Column) -> Column:
    """KLL sketch of a group's latencies (nulls left out)."""
    return F.kll_sketch_agg_bigint(latency.cast("bigint"), SKETCH_K)


def sketch_quantile(sketch: Column, rank: float = 0.95) -> Column:
    """The smallest latency with at least ``rank`` of the calls at or below it; NULL for none."""
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0,
                  F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank)))


def success_flag() -> Column:
    """1 for success, 0 otherwise; NULL status counts in neither success nor error."""
    return F.when(F.col("status") == F.lit(schemas.SUCCESS), 1).otherwise(0)


def failure_flag() -> Column:
    """Error and timeout count alike (``status <> 'success'``)."""
    return F.when(F.col("status") != F.lit(schemas.SUCCESS), 1).otherwise(0)


def cost_rollups(events: DataFrame, window_minutes: int = 60,
                 percentile: str = "exact", time_col: str = "ts") -> DataFrame:
    """Rollup rows in the stored table's shape and scales (``schemas.COST_ROLLUPS``)."""
    window = F.window(time_col, timefn.minutes_interval(window_minutes))
    sketched = percentile == "sketch"
    latency = F.col("latency_ms")
    agg = events.groupBy(window.alias("window"), "model", "provider", "user_id").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.sum(success_flag()).cast("bigint").alias("success_count"),
        F.sum(failure_flag()).cast("bigint").alias("error_count"),
        F.sum(F.col("total_tokens").cast("bigint")).alias("total_tokens"),
        F.sum("cost_usd").alias("total_cost_usd"),
        F.avg(F.col("latency_ms").cast("double")).alias("avg_latency_ms"),
        (latency_sketch(latency).alias(SKETCH) if sketched
         else p95(latency, percentile).alias("p95_latency_ms")),
    )
    if sketched:
        agg = agg.withColumn("p95_latency_ms", sketch_quantile(F.col(SKETCH)))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "model", "provider", "user_id",
        "total_requests", "success_count", "error_count", "total_tokens",
        F.col("total_cost_usd").cast(schemas.ROLLUP_COST_TYPE).alias("total_cost_usd"),
        F.col("avg_latency_ms").cast(schemas.LATENCY_TYPE).alias("avg_latency_ms"),
        F.col("p95_latency_ms").cast(schemas.LATENCY_TYPE).alias("p95_latency_ms"),
        *([SKETCH] if sketched else []),
    )


def merged_rollups(stored: DataFrame, window_minutes: int | None,
                   by: tuple[str, ...] = ("model",)) -> DataFrame:
    """Rollups with sketches combined into longer windows (None: all of them) and by fewer keys:
    (window_start, window_end, *by, total_requests, total_tokens, total_cost_usd,
    p95_latency_ms). Reads no events; a merged sketch stays of bounded size, and Spark
    merges per input partition before the shuffle. The stored windows must nest in the new."""
    keys = list(by)
    if window_minutes is not None:
        window = F.window("window_start", timefn.minutes_interval(window_minutes))
        keys = [window.alias("window"), *keys]
    agg = stored.groupBy(*keys).agg(
        F.sum("total_requests").alias("total_requests"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum("total_cost_usd").cast("decimal(38,4)").alias("total_cost_usd"),
        F.kll_merge_agg_bigint(SKETCH).alias(SKETCH))
    bounds = [] if window_minutes is None else [F.col("window.start").alias("window_start"),
                                                F.col("window.end").alias("window_end")]
    return agg.select(*bounds, *by, "total_requests", "total_tokens", "total_cost_usd",
                      sketch_quantile(F.col(SKETCH)).alias("p95_latency_ms"))


def provider_conflicts(events: DataFrame) -> DataFrame:
    """Q8: models seen with more than one provider (the rollup upserts on a key without
    provider, which is only sound while each model has one provider)."""
    return (events.groupBy("model")
                  .agg(F.count_distinct("provider").alias("providers"))
                  .where(F.col("providers") > 1))
