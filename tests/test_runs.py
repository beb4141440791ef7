"""Stored tables under restarts, backfills, compaction and re-delivery."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.operators import anomalies as an
from costpulse.plans import dashboard
from costpulse.sinks import tables as sinks
from costpulse.sources import fixtures, raw_json, tables
from costpulse.streaming import jobs
from tests.conftest import SF_SMALL

SHAPE = "event_id string, v int, dt date, arrival_key string"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(spark, *items):
    return spark.createDataFrame([(*i, "k") for i in items], SHAPE)


def stored(spark, path):
    return sorted(tuple(r) for r in tables.events(spark, path).select("event_id", "v").collect())


def test_runs_add_to_each_other_and_the_later_one_wins(spark, tmp_dir):
    path, first = f"{tmp_dir}/events", sinks.run_of(spark, f"{tmp_dir}/ckpt")
    assert sinks.run_of(spark, f"{tmp_dir}/ckpt") == first          # a restart goes on
    sinks.append_batch(rows(spark, *[(f"e{i}", 1, D1) for i in range(10)]), first + 7, path, ["dt"])
    later = sinks.new_run()
    assert later > first + 7
    sinks.append_batch(rows(spark, ("e3", 2, D1), ("x", 2, D1)), later, path, ["dt"])
    assert len(stored(spark, path)) == 11 and ("e3", 2) in stored(spark, path)


def test_replay_under_another_date_replaces_the_batch(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sinks.append_batch(rows(spark, ("a", 1, D1), ("b", 1, D1)), 5, path, ["dt"])
    sinks.append_batch(rows(spark, ("a", 1, D2), ("b", 1, D2)), 5, path, ["dt"])
    assert spark.read.parquet(path).count() == 2


def test_key_resent_under_another_date_survives_compaction_once(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    sinks.append_batch(rows(spark, ("a", 1, D1), ("b", 1, D1)), 1, path, ["dt"])
    sinks.append_batch(rows(spark, ("a", 2, D2)), 2, path, ["dt"])
    want = [("a", 2), ("b", 1)]
    assert stored(spark, path) == want
    for dates in ([D1], [D2], [D1, D2]):
        sinks.compact(spark, path, dates, ["event_id"], ["batch_id", "arrival_key"])
        assert stored(spark, path) == want


def test_compaction_leaves_one_file_of_many_batches(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    for batch in range(50):
        sinks.append_batch(rows(spark, (f"e{batch}", batch, D1), ("hot", batch, D1)), batch, path,
                           ["dt"])
    before = stored(spark, path)
    sinks.compact(spark, path, [D1], ["event_id"], ["batch_id", "arrival_key"])
    assert stored(spark, path) == before and len(before) == 51 and ("hot", 49) in before
    assert len(spark.read.parquet(path).inputFiles()) == 1
    own = {r["event_id"]: r["batch_id"] for r in sinks.read_deliveries(spark, path).collect()}
    assert own["e7"] == 7 and own["hot"] == 49
    # An earlier batch that comes again doesn't win over what came after it.
    sinks.append_batch(rows(spark, ("hot", 3, D1)), 3, path, ["dt"])
    assert stored(spark, path) == before


def test_further_sinks_get_each_anomaly_batch(spark, tmp_dir):
    messages, plain = [], []
    config = jobs.StreamConfig(anomaly_json_sinks=(lambda m: messages.append(m.columns),),
                               anomaly_row_sinks=(lambda r: plain.append(r.columns),))
    stats = an.window_stats(fixtures.llm_events(spark, SF_SMALL), 60)
    jobs.store_anomalies(spark, stats, 0, jobs.Paths.under(tmp_dir), config)
    assert messages == [["key", "value"]]
    assert plain == [schemas.ANOMALY_EVENTS.fieldNames()]


def test_last_line_of_a_file_wins(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.json"), "w") as out:
        for v in (1, 2):
            for i in range(12):
                out.write(json.dumps({"id": f"e{i}", "v": v}) + "\n")
    lines = raw_json.json_lines(spark, tmp_dir)
    last = lines.select(F.get_json_object("value", "$.id").alias("id"),
                        F.get_json_object("value", "$.v").alias("v"), "arrival_key")
    got = sinks.latest_by_key(last, ["id"], ["arrival_key"]).collect()
    assert len(got) == 12 and {r["v"] for r in got} == {"2"}


def test_upsert_over_many_dates(spark, tmp_dir):
    path = f"{tmp_dir}/wide"
    days = spark.range(1100).select(
        F.col("id").cast("string").alias("event_id"), F.lit(1).alias("v"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("dt"))
    sinks.upsert(spark, days, path, ["event_id"], ["v"])
    sinks.upsert(spark, days.where("cast(event_id as int) < 1050")
                 .withColumn("v", F.lit(2)), path, ["event_id"], ["v"])
    assert sorted((r["v"], r["count"]) for r in spark.read.parquet(path).groupBy("v").count().collect()) == [
        (1, 50), (2, 1050)]


def test_tables_without_rows_read_as_empty(spark, tmp_dir):
    paths = jobs.Paths.under(tmp_dir)
    assert tables.anomalies(spark, paths.anomalies).count() == 0
    assert tables.rollups(spark, paths.rollups).count() == 0
    assert tables.events(spark, paths.events).columns == schemas.LLM_EVENTS.fieldNames()
    frames = dashboard.refresh(spark, paths, "1 hour")
    assert frames is not None
