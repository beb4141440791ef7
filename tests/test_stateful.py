"""Shared panes and window histories: parity with batch over deliveries, state held, odd values."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from costpulse.operators import anomalies as an
from costpulse.operators import baselines
from costpulse.plans.compare import multiset
from costpulse.sources import fixtures, raw_json, replay, tables
from costpulse.streaming import jobs, stateful
from tests.conftest import SF_SMALL


def _levels(spark, src, paths, files=None):
    q = jobs.levels_job(spark, raw_json.json_lines_stream(spark, src, files), paths,
                        jobs.StreamConfig(state_partitions=2), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    return q


def _batch(events, minutes, watermark):
    return an.window_stats(events, minutes).where(
        F.col("window_end") <= F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")).select(
        F.lit(minutes).alias("minutes"), "window_start", "window_end", "model", "total_requests",
        "avg_latency_ms", "error_rate", F.col("total_cost_usd").cast("decimal(28,6)").alias("total_cost_usd"))


def _open_panes(spark, paths):
    """(start, model) of the panes in the state of the first aggregate, by Spark's state reader."""
    ckpt = f"{paths.checkpoints}/levels"
    meta = spark.read.format("state-metadata").load(ckpt).collect()
    op = next(r["operatorId"] for r in meta if r["operatorName"] == "stateStoreSave")
    state = spark.read.format("statestore").option("operatorId", op).load(ckpt)
    return {(r["s"].replace(tzinfo=None), r["m"]) for r in
            state.select(F.col("key.window.start").alias("s"), F.col("key.model").alias("m")).collect()}


def test_both_lengths_equal_batch_over_five_deliveries_and_only_open_panes_stay(spark, tmp_dir):
    events = fixtures.llm_events(spark, SF_SMALL).cache()
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 5
    for i in range(5):
        upto = events if i == 4 else events.where(
            F.col("ts") < F.lit((first + (i + 1) * step).isoformat(sep=" ")).cast("timestamp_ntz"))
        part = upto.where(F.col("ts") >= F.lit((first + i * step).isoformat(sep=" ")).cast("timestamp_ntz"))
        replay.messages(part).write.mode("append").text(src)
        _levels(spark, src, paths)
        watermark = upto.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=10)
        got = tables.window_levels(spark, paths.window_levels)
        want = _batch(upto, 5, watermark).unionByName(_batch(upto, 60, watermark))
        assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
            multiset(want.columns, [tuple(r) for r in want.collect()])
        # the batch definition of an open pane: it has events and ends after the watermark
        panes = {(r["window_start"], r["model"]) for r in an.window_stats(upto, 5).collect()
                 if r["window_end"] > watermark}
        assert _open_panes(spark, paths) == panes
    events.unpersist()


def _message(i, stamp, **changes):
    d = dict(model="m", provider="p", user_id="u", session_id="s", prompt_tokens=10, completion_tokens=5,
             total_tokens=15, cost_usd=0.5, latency_ms=100, status="success", error_code=None)
    d.update(event_id=f"3f2b8c1e-1111-4a2b-9c3d-{i:012d}", request_id=f"3f2b8c1e-2222-4a2b-9c3d-{i:012d}",
             timestamp=stamp + ".000000+00:00", **changes)
    return json.dumps(d)


def _put(src, name, *lines):
    os.makedirs(src, exist_ok=True)
    with open(f"{src}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_missing_measures_and_windows_that_span_restarts(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    _put(src, "a", _message(1, "2024-01-05T10:01:00", cost_usd=None, latency_ms="x"),
         _message(2, "2024-01-05T10:20:00", status="error", cost_usd=0.25))
    _levels(spark, src, paths)
    _put(src, "b", _message(3, "2024-01-05T10:58:00"), _message(4, "2024-01-05T13:00:00"))
    _levels(spark, src, paths)
    rows = {(r["minutes"], r["window_start"].strftime("%H:%M")): r
            for r in tables.window_levels(spark, paths.window_levels).collect()}
    assert set(rows) == {(5, "10:00"), (5, "10:20"), (5, "10:55"), (60, "10:00")}
    none, hour = rows[5, "10:00"], rows[60, "10:00"]
    assert none["avg_latency_ms"] is None and none["total_cost_usd"] is None and none["error_rate"] == 0
    assert (hour["total_requests"], hour["avg_latency_ms"], hour["total_cost_usd"]) == (3, 100.0, Decimal("0.75"))
    assert abs(hour["error_rate"] - 1 / 3) < 1e-15


def test_history_state_holds_the_lookback_and_no_files_gather(spark, tmp_dir):
    """Ten micro-batches: keyed state has one list per model, and no folder but the outputs."""
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    config = jobs.StreamConfig(anomaly_minutes=5, state_partitions=2,
                               baselines=baselines.BaselineConfig(lookback=3))
    for i in range(10):
        _put(src, f"f{i}", _message(i, f"2024-01-05T1{i // 6}:{i % 6}0:00", latency_ms=100 + i))
    q = jobs.anomaly_job(spark, raw_json.json_lines_stream(spark, src, 1), paths, config, True)
    q.awaitTermination()
    assert q.exception() is None
    kept = {o.operatorName: o.numRowsTotal for o in q.lastProgress.stateOperators}
    assert kept["transformWithStateInPySparkExec"] <= 3 and kept["stateStoreSave"] == 1
    assert sorted(os.listdir(tmp_dir)) == ["_checkpoints", "src", "window_stats"] or \
        set(os.listdir(tmp_dir)) <= {"_checkpoints", "src", "window_stats", "anomaly_events", "anomalies_json"}


def test_from_history_equals_the_window_functions(spark):
    """Arrays of the previous windows against OVER clauses, with nulls and constant histories."""
    cfg = baselines.BaselineConfig(lookback=4, z_warning=1.5)
    rows = [("a", i, float(100 + (i * 37) % 11 + (900 if i % 7 == 0 else 0)), 0.1 * (i % 3),
             None if i % 5 == 0 else Decimal(i % 4) / 8 + (3 if i == 9 else 0), None if i == 6 else 100.0 + 700 * (i % 8 == 0))
            for i in range(30)] + [("b", i, 5.0, 0.0, Decimal(1), 7.0) for i in range(8)]
    stats = spark.createDataFrame(rows, "model string, i int, avg_latency_ms double, error_rate double,"
                                  "total_cost_usd decimal(28,6), p95_latency_ms double").withColumn(
        "window_start", F.timestamp_micros(F.col("i").cast("long") * 300_000_000).cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
    want = (baselines.latency_baseline(stats, cfg).unionByName(baselines.cost_baseline(stats, cfg))
            .unionByName(baselines.zscore_anomalies(baselines.zscores(stats, cfg), cfg)))
    from pyspark.sql import Window
    frame = Window.partitionBy("model").orderBy("window_start").rowsBetween(-4, -1)
    kinds = {"previous_p95": F.col("p95_latency_ms").cast("decimal(12,2)"),
             "previous_cost": F.col("total_cost_usd").cast("decimal(22,6)"),
             "previous_latency": F.col("avg_latency_ms"), "previous_errors": F.col("error_rate")}
    held = stats.withColumns({k: F.transform(F.collect_list(F.struct(v.alias("x"))).over(frame), lambda s: s["x"])
                              for k, v in kinds.items()})
    got = baselines.from_history(held, cfg)
    assert want.count() > 5 and got.columns == want.columns
    assert multiset(got.columns, [tuple(r) for r in got.collect()]) == \
        multiset(want.columns, [tuple(r) for r in want.collect()])


def test_pane_length_must_divide_the_window():
    import pytest
    with pytest.raises(ValueError):
        stateful.PaneWindows(7, 60)
