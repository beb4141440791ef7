"""Per-minute summaries under re-delivery: retractions, replays, compaction, bounded batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from costpulse.operators import reports
from costpulse.plans.compare import multiset
from costpulse.sinks import tables as sinks
from costpulse.sources import raw_json, tables
from costpulse.streaming import jobs, summaries
from tests.test_stateful import _message, _put


def _run(spark, src, paths, files=None):
    config = jobs.StreamConfig(state_partitions=2)
    raw = lambda: raw_json.json_lines_stream(spark, src, files)
    for q in (jobs.summary_job(spark, raw(), paths, config, True), jobs.landing(spark, raw(), paths, config, True)):
        q.awaitTermination()
        assert q.exception() is None


def _same(spark, paths, as_of=dt.datetime(2024, 1, 7)):
    """The maintained summaries equal a recomputation from the landed table."""
    got = summaries.minute_stats(spark, paths.minute_summaries)
    want = reports.minute_model_stats(tables.events(spark, paths.events), dt.datetime(2024, 1, 1, 6), "24 hours")
    want = want.withColumn("success_latency", F.coalesce("success_latency", F.lit(0))).select(*got.columns)
    assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
        multiset(want.columns, [tuple(r) for r in want.collect()])
    return {(r["time"].strftime("%d %H:%M"), r["model"]): r for r in got.collect()}


def test_resent_events_take_back_what_they_added(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _put(src, "a", _message(1, "2024-01-05T10:01:00"), _message(2, "2024-01-05T10:01:30", status="error", cost_usd=0),
         _message(3, "2024-01-05T10:02:00"), "not json")
    _run(spark, src, paths)
    assert _same(spark, paths)["05 10:01", "m"]["events"] == 2
    # another minute and model; the same once more; and back as it was
    _put(src, "b", _message(1, "2024-01-05T11:00:00", model="n", cost_usd=2.5), _message(2, "2024-01-05T10:01:30"))
    _run(spark, src, paths)
    now = _same(spark, paths)
    assert (now["05 11:00", "n"]["events"], now["05 10:01", "m"]["failures"]) == (1, 0)
    _put(src, "c", _message(3, "2024-01-06T00:00:00"))
    _run(spark, src, paths)
    assert ("05 10:02", "m") not in _same(spark, paths)      # its only event has moved away
    before = spark.read.parquet(paths.minute_summaries).count()
    _put(src, "d", _message(3, "2024-01-06T00:00:00"), _message(1, "2024-01-05T11:00:00", model="n", cost_usd=2.5))
    _run(spark, src, paths)
    _same(spark, paths)
    assert spark.read.parquet(paths.minute_summaries).count() == before     # nothing changed, nothing stored
    dates = sinks.partition_dates(spark, paths.minute_summaries)
    for some in (dates[:1], dates):
        summaries.compact(spark, paths.minute_summaries, some)
        _same(spark, paths)
    _put(src, "e", _message(2, "2024-01-05T10:09:00", latency_ms=5000), _message(9, "2024-01-05T10:01:00"))
    _run(spark, src, paths)
    _same(spark, paths)
    assert summaries.minute_stats(spark, paths.minute_summaries, since=dt.datetime(2024, 1, 6)).count() == 1


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _put(src, "a", _message(1, "2024-01-05T10:01:00"), _message(2, "2024-01-05T10:03:00"))
    _run(spark, src, paths)
    _put(src, "b", _message(1, "2024-01-05T10:02:00"))
    first = sinks.run_of(spark, f"{paths.checkpoints}/summaries")
    touched = summaries.deliveries(jobs.accepted(spark, raw_json.json_lines_stream(spark, src)))

    def write_then_fail(batch, batch_id):
        summaries.store(batch, first + batch_id, paths.minute_summaries)
        raise RuntimeError("driver lost after the write")

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set(jobs.STATE_STORE_CONF, jobs.ROCKSDB_PROVIDER)
    try:
        q = (touched.writeStream.outputMode("update").foreachBatch(write_then_fail)
             .option("checkpointLocation", f"{paths.checkpoints}/summaries").trigger(availableNow=True).start())
        try:
            q.awaitTermination()
        except Exception:
            pass
        assert q.exception() is not None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset(jobs.STATE_STORE_CONF)
    _run(spark, src, paths)
    rows = _same(spark, paths)
    assert {k: r["events"] for k, r in rows.items()} == {("05 10:02", "m"): 1, ("05 10:03", "m"): 1}


def test_reports_read_the_summaries(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _put(src, "a", _message(1, "2024-01-05T10:01:00"), _message(2, "2024-01-05T10:01:20", status="timeout", cost_usd=0),
         _message(3, "2024-01-05T10:01:40", latency_ms=201))
    _run(spark, src, paths)
    stats = summaries.minute_stats(spark, paths.minute_summaries)
    assert reports.event_rate(stats).first()["events"] == 3
    assert float(reports.error_rate(stats).first()["error_rate"]) == 33.33
    assert reports.latency_by_minute(stats).first()["avg_latency_ms"] == 151
    assert reports.tokens_by_minute(stats).first()["total_tokens"] == 45
    assert float(reports.cost_by_minute(stats).first()["cost_usd"]) == 1.0
    assert summaries.minute_stats(spark, f"{tmp_dir}/none").count() == 0
