"""Streaming jobs over JSON-lines files: watermark, late rows, restart, upsert, two sinks."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from costpulse import schemas

from costpulse.operators import baselines
from costpulse.sources import raw_json, tables
from costpulse.sinks import tables as sinks
from costpulse.streaming import jobs

BASE = {
    "timestamp": None, "model": "gpt-4o", "provider": "openai", "user_id": "user_001",
    "session_id": "s-1", "prompt_tokens": 1000, "completion_tokens": 1000,
    "total_tokens": 2000, "cost_usd": 0.0125, "latency_ms": 900, "status": "success",
    "error_code": None,
}


def _event(i: int, stamp: str, **changes) -> str:
    d = dict(BASE)
    d.update(event_id=f"3f2b8c1e-1111-4a2b-9c3d-{i:012d}",
             request_id=f"3f2b8c1e-2222-4a2b-9c3d-{i:012d}", timestamp=stamp)
    d.update(changes)
    return json.dumps(d)


def _write(path: str, name: str, lines: list[str]) -> None:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def _run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_late_row_is_dropped_and_counted(spark, tmp_dir, mode):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    config = jobs.StreamConfig(rollup_minutes=60, rollup_mode=mode)
    _write(src, "a.json", [_event(1, "2024-01-23T10:00:00.000000+00:00"),
                           _event(2, "2024-01-23T12:00:00.000000+00:00")])
    q = _run(jobs.rollup_job(spark, raw_json.json_lines_stream(spark, src, 1), paths, config,
                             available_now=True))
    # Second run, new file: one on-time row, one far behind the watermark.
    _write(src, "b.json", [_event(3, "2024-01-01T00:30:00.000000+00:00"),
                           _event(4, "2024-01-23T14:00:00.000000+00:00")])
    q = _run(jobs.rollup_job(spark, raw_json.json_lines_stream(spark, src, 1), paths, config,
                             available_now=True))
    assert jobs.dropped_late_rows(q) == 1
    progress = q.lastProgress
    ops = progress["stateOperators"] if isinstance(progress, dict) else progress.stateOperators
    op = ops[0]
    metrics = op["customMetrics"] if isinstance(op, dict) else op.customMetrics
    assert any(k.startswith("rocksdb") for k in metrics)     # RocksDB state store in use
    hours = sorted(r["window_start"].hour for r in tables.rollups(spark, paths.rollups).collect())
    # 10:00 and 12:00 are closed by the watermark of 14:00 - 10 s; 14:00 is still open;
    # the 00:30 row is late and never aggregated.
    assert hours == [10, 12]


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_landing_upsert_restart_and_quarantine(spark, tmp_dir, mode):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    config = jobs.StreamConfig(landing_mode=mode)
    _write(src, "a.json", [_event(1, "2024-01-05T10:00:00.000000+00:00"),
                           _event(2, "2024-01-05T10:01:00.000000+00:00"),
                           "not json", _event(9, "yesterday")])
    _run(jobs.landing(spark, raw_json.json_lines_stream(spark, src), paths, config, True))
    # Restart from the checkpoint: the first file is not read again; event 2 is re-sent
    # with a corrected latency and must replace the stored row.
    _write(src, "b.json", [_event(2, "2024-01-05T10:01:00.000000+00:00", latency_ms=950),
                           _event(3, "2024-01-06T09:00:00.000000+00:00", status=None)])
    _run(jobs.landing(spark, raw_json.json_lines_stream(spark, src), paths, config, True))
    events = {r["event_id"][-1]: r for r in tables.events(spark, paths.events).collect()}
    assert sorted(events) == ["1", "2"]          # status NULL is quarantined (NOT NULL)
    assert events["2"]["latency_ms"] == 950
    bad = spark.read.parquet(paths.quarantine)
    reasons = sorted(r for row in bad.collect() for r in row["reasons"])
    assert reasons == ["bad_timestamp", "missing:status", "unparsable"]
    first = sinks.run_of(spark, f"{paths.checkpoints}/landing")
    assert sorted(r["batch_id"] - first for r in bad.select("batch_id").distinct().collect()) == [0, 1]
    assert tables.events(spark, paths.events).columns == list(schemas.LLM_EVENTS.fieldNames())
    if mode == "append":
        assert spark.read.parquet(paths.events).count() == 3      # both deliveries of 2
        jobs.compact_events(spark, paths, [dt.date(2024, 1, 5), dt.date(2024, 1, 6)])
        stored = sinks.read_deliveries(spark, paths.events)
        assert stored.count() == 2
        assert {(r["event_id"][-1], r["batch_id"] - first) for r in stored.collect()} == \
            {("1", 0), ("2", 1)}
        assert tables.events(spark, paths.events).count() == 2
        # A late delivery into a compacted date removes its marker: dedup again.
        _write(src, "c.json", [_event(1, "2024-01-05T10:00:00.000000+00:00", latency_ms=1)])
        _run(jobs.landing(spark, raw_json.json_lines_stream(spark, src), paths, config, True))
        events = {r["event_id"][-1]: r for r in tables.events(spark, paths.events).collect()}
        assert sorted(events) == ["1", "2"] and events["1"]["latency_ms"] == 1


def test_anomaly_job_writes_table_and_json(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    lines = [_event(i, f"2024-01-05T10:0{i}:00.000000+00:00", status="error",
                    error_code="server_error", cost_usd=0) for i in range(3)]
    lines.append(_event(7, "2024-01-05T11:00:00.000000+00:00"))
    _write(src, "a.json", lines)
    config = jobs.StreamConfig(anomaly_minutes=5, baselines=baselines.BaselineConfig())
    _run(jobs.anomaly_job(spark, raw_json.json_lines_stream(spark, src), paths, config, True))
    rows = spark.read.parquet(paths.anomalies).collect()
    assert [(r["anomaly_type"], r["severity"]) for r in rows] == [("error_surge", "critical")]
    as_json = [json.loads(r["value"]) for r in spark.read.parquet(paths.anomalies_json).collect()]
    assert as_json[0]["anomaly_type"] == "error_surge"
    assert as_json[0]["window_start"] == "2024-01-05T10:00:00.000"
    # The statistics history for the baselines was stored.
    assert spark.read.parquet(paths.window_stats).count() == 1


def test_dedup_within_watermark(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    line = _event(1, "2024-01-05T10:00:00.000000+00:00")
    _write(src, "a.json", [line, line, _event(2, "2024-01-05T10:00:01.000000+00:00")])
    out = f"{tmp_dir}/out"
    q = (jobs.dedup_stream(spark, raw_json.json_lines_stream(spark, src), jobs.StreamConfig())
         .select("event_id").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    _run(q)
    assert sorted(r[0][-1] for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_start_all_runs_three_independent_queries(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _write(src, "a.json", [_event(i, f"2024-01-05T1{i}:00:00.000000+00:00") for i in range(4)])
    queries = jobs.start_all(spark, lambda: raw_json.json_lines_stream(spark, src), paths,
                             available_now=True)
    for q in queries:
        _run(q)
    assert tables.events(spark, paths.events).count() == 4
    # Watermark 12:59:50: the 10:00 and 11:00 windows are closed, 12:00 and 13:00 are open.
    assert tables.rollups(spark, paths.rollups).where(F.col("total_requests") == 1).count() == 2
    jobs.compact_rollups(spark, paths, [dt.date(2024, 1, 5)])
    assert spark.read.parquet(paths.rollups).count() == 2
    assert {q.name for q in queries} == {"landing", "rollups", "anomalies"}


def test_replay_after_failure_leaves_no_duplicates(spark, tmp_dir):
    """Batch 0 writes, then fails before the stream commits it; the restarted query replays
    batch 0 from the checkpoint and overwrites exactly its own partition."""
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _write(src, "a.json", [_event(i, f"2024-01-05T10:0{i}:00.000000+00:00") for i in range(5)])

    first = sinks.run_of(spark, f"{paths.checkpoints}/landing")

    def write_then_fail(batch, batch_id):
        jobs.land_batch(spark, batch, first + batch_id, paths)
        raise RuntimeError("driver lost after the write")

    q = (raw_json.json_lines_stream(spark, src).writeStream
         .option("checkpointLocation", f"{paths.checkpoints}/landing")
         .foreachBatch(write_then_fail).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    assert spark.read.parquet(paths.events).count() == 5
    _run(jobs.landing(spark, raw_json.json_lines_stream(spark, src), paths,
                      jobs.StreamConfig(), available_now=True))
    stored = spark.read.parquet(paths.events)
    assert stored.count() == 5                       # raw storage, before any dedup
    assert {r["batch_id"] for r in stored.select("batch_id").collect()} == {first}


def test_stream_rollup_counts_null_status_in_total_only(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _write(src, "a.json", [
        _event(1, "2024-01-05T10:00:00.000000+00:00"),
        _event(2, "2024-01-05T10:10:00.000000+00:00", status=None, cost_usd=0),
        _event(3, "2024-01-05T10:20:00.000000+00:00", status="error", cost_usd=0,
               error_code="server_error", latency_ms="x"),
        _event(4, "2024-01-05T10:30:00.000000+00:00", model=None),        # no group key
        _event(5, "2024-01-05T12:00:00.000000+00:00"),                    # closes 10:00
    ])
    _run(jobs.rollup_job(spark, raw_json.json_lines_stream(spark, src), paths,
                         jobs.StreamConfig(), available_now=True))
    row = tables.rollups(spark, paths.rollups).where(F.hour("window_start") == 10).first()
    assert (row["total_requests"], row["success_count"], row["error_count"]) == (3, 1, 1)
    assert row["avg_latency_ms"] == 900           # the unparsable latency is left out


def test_stream_baselines_equal_batch_on_closed_windows(spark, tmp_dir):
    from costpulse.operators import anomalies as an
    from costpulse.plans.compare import multiset
    from costpulse.sources import fixtures, replay
    from tests.conftest import SF_SMALL

    events = fixtures.llm_events(spark, SF_SMALL)
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    replay.messages(events).write.text(src)
    cfg = baselines.BaselineConfig()
    config = jobs.StreamConfig(anomaly_minutes=60, baselines=cfg, state_partitions=4)
    _run(jobs.anomaly_job(spark, raw_json.json_lines_stream(spark, src), paths, config, True))
    got = tables.anomalies(spark, paths.anomalies).drop("detected_at", "batch_id")

    stats = an.window_stats(events, 60, with_p95=True)
    batch = (an.detect(stats)
             .unionByName(baselines.latency_baseline(stats, cfg))
             .unionByName(baselines.cost_baseline(stats, cfg))
             .unionByName(baselines.zscore_anomalies(baselines.zscores(stats, cfg), cfg)))
    watermark = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=10)
    want = batch.where(F.col("window_end") <= F.lit(watermark.isoformat(sep=" "))
                       .cast("timestamp_ntz")).drop("detected_at")
    assert got.count() > 300
    assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
        multiset(want.columns, [tuple(r) for r in want.collect()])


def test_stream_baselines_across_micro_batches(spark, tmp_dir):
    """Five time-ordered files, one per micro-batch: each batch's baselines read the stored
    statistics history written by the earlier batches; the end result equals the batch."""
    from costpulse.operators import anomalies as an
    from costpulse.plans.compare import multiset
    from costpulse.sources import fixtures, replay
    from tests.conftest import SF_SMALL

    events = fixtures.llm_events(spark, SF_SMALL)
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _time_ordered_files(events, src, replay)
    cfg = baselines.BaselineConfig()
    config = jobs.StreamConfig(anomaly_minutes=60, baselines=cfg, state_partitions=4)
    q = _run(jobs.anomaly_job(spark, raw_json.json_lines_stream(spark, f"{src}/*", 1), paths,
                              config, True))
    assert len(q.recentProgress) >= 5
    got = tables.anomalies(spark, paths.anomalies).drop("detected_at", "batch_id")

    stats = an.window_stats(events, 60, with_p95=True)
    batch = (an.detect(stats)
             .unionByName(baselines.latency_baseline(stats, cfg))
             .unionByName(baselines.cost_baseline(stats, cfg))
             .unionByName(baselines.zscore_anomalies(baselines.zscores(stats, cfg), cfg)))
    watermark = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=10)
    want = batch.where(F.col("window_end") <= F.lit(watermark.isoformat(sep=" "))
                       .cast("timestamp_ntz")).drop("detected_at")
    assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
        multiset(want.columns, [tuple(r) for r in want.collect()])


def _time_ordered_files(events, src, replay, parts=5, days=6):
    """Messages in ``parts`` files of consecutive time ranges, written in time order."""
    start = events.agg(F.min("ts")).first()[0].replace(hour=0, minute=0, second=0,
                                                        microsecond=0)
    for i in range(parts):
        lo, hi = start + dt.timedelta(days=days * i), start + dt.timedelta(days=days * (i + 1))
        part = events.where((F.col("ts") >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"))
                            & (F.col("ts") < F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")))
        replay.messages(part).coalesce(1).write.text(f"{src}/part{i}")


def test_stream_rollups_across_micro_batches(spark, tmp_dir):
    from costpulse.operators import rollups
    from costpulse.plans.compare import multiset
    from costpulse.sources import fixtures, replay
    from tests.conftest import SF_SMALL

    events = fixtures.llm_events(spark, SF_SMALL)
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _time_ordered_files(events, src, replay)
    q = _run(jobs.rollup_job(spark, raw_json.json_lines_stream(spark, f"{src}/*", 1), paths,
                             jobs.StreamConfig(state_partitions=4), True))
    assert len(q.recentProgress) >= 5 and jobs.dropped_late_rows(q) == 0
    got = tables.rollups(spark, paths.rollups)
    watermark = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=10)
    want = rollups.cost_rollups(events, 60).where(
        F.col("window_end") <= F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz"))
    assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
        multiset(want.columns, [tuple(r) for r in want.collect()])


def test_quarantine_shape_and_all_deliveries_reader(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    line = _event(1, "2024-01-05T10:00:00.000000+00:00")
    _write(src, "a.json", [line, line, "not json"])
    _run(jobs.landing(spark, raw_json.json_lines_stream(spark, src), paths,
                      jobs.StreamConfig(), True))
    bad = spark.read.parquet(paths.quarantine)
    assert set(bad.columns) == {"value", "reasons", "source", "arrival_key", "arrival_time",
                                "dt", "batch_id"}
    assert tables.events(spark, paths.events, latest=False).count() == 2   # both deliveries
    assert tables.events(spark, paths.events).count() == 1                 # latest per key
