"""Per-minute summaries kept up to date under re-delivery (R5-R9 over K1).

A re-sent event takes back what its earlier delivery added and adds its own values, possibly to
another minute or model. One stateful aggregate holds each event's deliveries by event_id (in
RocksDB, off the heap); in update mode it hands on the events a micro-batch touched, the last
delivery before the batch and the last of all. Their difference, summed per (minute, model),
is appended as the batch's own folder, so a replay rewrites exactly that folder, and the work
of a batch is that of its events, however large table and state are. Readers add the
differences up; ``compact`` does so for closed dates.

The order of deliveries is (micro-batch, arrival key), ties by a hash of the values, as two
lines of one file block in one micro-batch have no order on a stream. The state keeps every
event_id for as long as it may be re-sent: for ever, unless the checkpoint is renewed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse.operators.rollups import failure_flag, success_flag
from costpulse.sinks import tables
from costpulse.sources import tables as source_tables

KEY = ("time", "model")
MEASURES = ("events", "failures", "successes", "success_latency", "total_tokens", "cost_usd")
SUMMARY = T.StructType([
    T.StructField("time", T.TimestampNTZType()), T.StructField("model", T.StringType()),
    *[T.StructField(m, T.DecimalType(28, 6) if m == "cost_usd" else T.LongType()) for m in MEASURES]])


def _contribution() -> list[Column]:
    """What one event adds to its minute."""
    ok = success_flag().cast("bigint")
    return [
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("time"), F.col("model"),
        F.lit(1).cast("bigint").alias("events"), failure_flag().cast("bigint").alias("failures"),
        ok.alias("successes"), (ok * F.col("latency_ms")).cast("bigint").alias("success_latency"),
        F.col("total_tokens").cast("bigint").alias("total_tokens"),
        F.col("cost_usd").cast("decimal(28,6)").alias("cost_usd")]


def deliveries(events: DataFrame) -> DataFrame:
    """(event_id, deliveries) of the events a micro-batch touches; ``events`` are accepted rows
    of a stream with ``arrival_key``."""
    values = F.struct(*_contribution())
    # the start of the micro-batch: the same for all its rows, also when it is replayed
    sent = F.struct(F.current_timestamp().alias("batch"), F.col("arrival_key").alias("arrival"),
                    F.xxhash64(values).alias("tie"), values.alias("row"))
    return events.select("event_id", sent.alias("sent")).groupBy("event_id").agg(
        F.collect_list("sent").alias("deliveries"))


def differences(touched: DataFrame) -> DataFrame:
    """Signed changes per (time, model) of one micro-batch of ``deliveries``; those that cancel
    out are left out."""
    now = F.array_max(F.transform("deliveries", lambda d: d["batch"]))
    last = F.array_max("deliveries")
    before = F.array_max(F.filter("deliveries", lambda d: d["batch"] < now))
    changes = F.array(F.struct(F.lit(1).alias("sign"), last["row"].alias("row")),
                      F.struct(F.lit(-1).alias("sign"), before["row"].alias("row")))
    rows = (touched.select(F.inline(changes)).where(F.col("row").isNotNull())
            .select("sign", "row.*"))
    summed = rows.groupBy(*KEY).agg(*[F.sum(F.col("sign") * F.col(m)).cast(SUMMARY[m].dataType).alias(m)
                                      for m in MEASURES])
    return summed.where(_any_measure())


def _any_measure() -> Column:
    some = F.lit(False)
    for m in MEASURES:
        some = some | (F.col(m) != 0)
    return some


def store(touched: DataFrame, batch_id: int, path: str) -> None:
    rows = tables.with_date(differences(touched), "time")
    tables.append_batch(rows, batch_id, path, ["dt"], sort_cols=["model", "time"])


def minute_stats(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """The summaries as ``reports.minute_model_stats`` gives them; minutes whose events have all
    moved away are left out."""
    schema = T.StructType([T.StructField("batch_id", T.LongType()), *SUMMARY.fields,
                           T.StructField("dt", T.DateType())])
    found = source_tables.read_ranged(spark, path, "time", since, schema=schema)
    return _summed(found, KEY).where(F.col("events") > 0)


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).cast(SUMMARY[m].dataType).alias(m) for m in MEASURES])


def compact(spark: SparkSession, path: str, dates) -> None:
    """One row per (time, model) in closed dates, in one folder each."""
    def merge(rows: DataFrame) -> DataFrame:
        kept = _summed(rows, [*KEY, "dt"]).where(_any_measure())
        return kept.withColumn("batch_id", F.lit(0).cast("long"))
    tables.compact(spark, path, dates, list(KEY), ["batch_id"], sort_cols=["model", "time"],
                   merge=merge)
