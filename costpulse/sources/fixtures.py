"""Adapter from the driver table ``events`` to the landed ``llm_events`` shape.

The test data holds generic product events, not LLM calls, so every query runs on a
deterministic projection of ``events``: each row becomes one call whose model, tokens,
status, price and latency follow from its own columns. The projection is row-local (one
map stage, no shuffle); the only join is a broadcast of the 100-row weight-band table
derived from the 6-row model catalogue.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import pricing, timefn

EVENTS_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def model_bands(spark: SparkSession) -> DataFrame:
    """One row per percentage point 0..99 -> catalogue row (100 rows, fixed size)."""
    cat = pricing.catalogue(spark)
    return (cat.withColumn("band", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
               .drop("lo", "hi"))


def llm_events(spark: SparkSession, sf_dir: str, since: dt.datetime | None = None) -> DataFrame:
    """The ``llm_events`` table derived from ``events``.

    ``since`` keeps events with ``ts >= since``; it is applied to the raw column so it is
    pushed into the Parquet scan (row-group skipping). Valid because the landed ``ts`` is
    the raw ``ts`` truncated to milliseconds and report bounds are millisecond aligned.
    """
    if since is None:
        events = read_events(spark, sf_dir)
    else:
        events = read_events(spark, sf_dir).where(
            F.col("ts") >= timefn.ntz_lit(since))
    return adapt(events, model_bands(spark))


def adapt(events: DataFrame, bands: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    base = events.select(
        "event_id", "user_id", "event_type",
        timefn.to_ms_ntz(F.col("ts")).alias("ts"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        k.alias("k"),
        ((F.col("event_id") * 37) % 100).cast("int").alias("band"),
    )
    prompt = F.least(F.lit(schemas.PROMPT_TOKENS_MAX),
                     F.greatest(F.lit(schemas.PROMPT_TOKENS_MIN), F.col("cents") * 2))
    completion = F.least(F.lit(schemas.COMPLETION_TOKENS_MAX),
                         F.greatest(F.lit(schemas.COMPLETION_TOKENS_MIN), F.expr("cents div 10")))
    is_error = F.col("event_type") == "error"
    status = (F.when(is_error & (F.col("k") < 15), "error")
               .when(is_error & (F.col("k") < 30), "timeout")
               .otherwise(schemas.SUCCESS))
    t = base.select(
        "*",
        prompt.alias("prompt_tokens"),
        completion.alias("completion_tokens"),
        status.alias("status"),
    )
    # Weight band -> model: equi-join on a 100-row table, broadcast (size fixed by design).
    t = t.join(F.broadcast(bands), "band", "inner")
    error_code = (F.when(F.col("status") == "timeout", F.lit(schemas.TIMEOUT_CODE))
                   .when(F.col("status") == "error",
                         F.element_at(F.array(*[F.lit(c) for c in schemas.ERROR_CODES]),
                                      (F.col("k") % 4 + 1).cast("int"))))
    latency = F.greatest(
        F.lit(schemas.LATENCY_MS_MIN).cast("bigint"),
        (F.col("base_ms") + F.expr("completion_tokens * 5 div 2"))
        * F.when(F.col("status") == "timeout", 3).otherwise(1))
    return t.select(
        F.concat(F.lit("00000000-0000-4000-8000-"),
                 F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("event_id"),
        "ts", "model", "provider",
        F.concat(F.lit("user_"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("user_id"),
        F.concat(F.lit("s-"), F.col("user_id").cast("string"), F.lit("-"),
                 (F.col("event_id") % 4).cast("string")).alias("session_id"),
        F.col("prompt_tokens").cast("int").alias("prompt_tokens"),
        F.col("completion_tokens").cast("int").alias("completion_tokens"),
        (F.col("prompt_tokens") + F.col("completion_tokens")).cast("int").alias("total_tokens"),
        pricing.call_cost(F.col("status"), pricing.cost_micro()).alias("cost_usd"),
        latency.cast("int").alias("latency_ms"),
        "status",
        error_code.alias("error_code"),
        F.concat(F.lit("00000000-0000-4000-9000-"),
                 F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("request_id"),
    )


def max_event_time(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """``as_of`` for reproducible reports: the newest landed event time (one scalar)."""
    row = read_events(spark, sf_dir).agg(
        timefn.to_ms_ntz(F.max("ts")).alias("m")).first()
    return row["m"]

