"""Ranged reads of a merge-on-read table in which keys were re-sent under other dates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.sinks import keyindex
from costpulse.sinks import tables as sinks
from costpulse.sources import tables

FIELDS = [f.name for f in schemas.LLM_EVENTS.fields]
KEY, ORDER = ["event_id"], ["batch_id", "arrival_key"]


def _event(spark, *rows):
    """(id, time, latency[, arrival]) -> events to land."""
    full = [(f"id-{r[0]}", dt.datetime.fromisoformat(r[1]), "m", "p", "u", "s", 1, 1, 2, r[2],
             "success", None, "q", r[3] if len(r) > 3 else "k") for r in rows]
    df = spark.createDataFrame(full, "event_id string, ts timestamp_ntz, model string, provider string,"
                               "user_id string, session_id string, prompt_tokens int,"
                               "completion_tokens int, total_tokens int, latency_ms int, status string,"
                               "error_code string, request_id string, arrival_key string")
    return sinks.with_date(df.withColumn("cost_usd", F.lit(0).cast(schemas.COST_TYPE)), "ts")


def _land(spark, path, batch, *rows, index=tables.EVENT_INDEX):
    sinks.append_batch(_event(spark, *rows), batch, path, ["dt"], ["model", "ts"], index=index)


def _read(spark, path, since):
    return sorted((r["event_id"], r["latency_ms"])
                  for r in tables.events(spark, path, since=dt.datetime.fromisoformat(since)).collect())


def _compact(spark, path, dates, index=tables.EVENT_INDEX):
    sinks.compact(spark, path, dates, KEY, ORDER, sort_cols=["model", "ts"], index=index)


@pytest.mark.parametrize("indexed", [True, False])
def test_event_resent_before_the_range_is_not_in_it(spark, tmp_dir, indexed):
    path, index = f"{tmp_dir}/events", tables.EVENT_INDEX if indexed else None
    _land(spark, path, 1, ("a", "2024-01-11T08:00", 100), ("b", "2024-01-11T09:00", 1), index=index)
    _land(spark, path, 2, ("a", "2024-01-03T08:00", 200), index=index)
    for dates in ([], ["2024-01-11"], ["2024-01-03"], ["2024-01-03", "2024-01-11"]):
        _compact(spark, path, dates, index)
        assert _read(spark, path, "2024-01-10T00:00") == [("id-b", 1)]
        assert _read(spark, path, "2024-01-01T00:00") == [("id-a", 200), ("id-b", 1)]
    # sent once more, into the range: it is back
    _land(spark, path, 3, ("a", "2024-01-10T12:00", 300), index=index)
    assert _read(spark, path, "2024-01-10T00:00") == [("id-a", 300), ("id-b", 1)]
    assert _read(spark, path, "2024-01-10T13:00") == [("id-b", 1)]       # same date, before the range


def test_two_dates_in_one_batch_and_older_deliveries_outside(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    _land(spark, path, 5, ("a", "2024-01-02T00:00", 1, "k1"), ("a", "2024-01-09T00:00", 2, "k2"),
          ("b", "2024-01-09T00:00", 3, "k3"), ("b", "2024-01-02T00:00", 4, "k4"))
    assert _read(spark, path, "2024-01-09T00:00") == [("id-a", 2)]
    _land(spark, path, 6, ("c", "2024-01-02T00:00", 5), ("d", "2024-01-09T00:00", 6))
    _land(spark, path, 7, ("c", "2024-01-09T00:00", 7))
    assert _read(spark, path, "2024-01-09T00:00") == [("id-a", 2), ("id-c", 7), ("id-d", 6)]


def test_tables_from_before_the_index_stay_exact(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    _land(spark, path, 1, ("a", "2024-01-02T00:00", 1), ("b", "2024-01-09T00:00", 2), index=None)
    _compact(spark, path, ["2024-01-02"], None)
    _land(spark, path, 2, ("a", "2024-01-09T00:00", 3), ("b", "2024-01-02T00:00", 4))
    assert _read(spark, path, "2024-01-09T00:00") == [("id-a", 3)]
    _land(spark, path, 3, ("a", "2024-01-02T00:00", 5), index=None)       # crash before the index
    assert _read(spark, path, "2024-01-09T00:00") == []
    _compact(spark, path, ["2024-01-02", "2024-01-09"])
    assert _read(spark, path, "2024-01-09T00:00") == []
    assert _read(spark, path, "2024-01-01T00:00") == [("id-a", 5), ("id-b", 4)]


def test_other_days_are_known_by_index_files_or_names_alone(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    for day in range(1, 10):
        _land(spark, path, day, (f"x{day}", f"2024-01-{day:02d}T10:00", day))
    since = dt.datetime(2024, 1, 9)
    # in time order nothing older can have replaced a row of the range: no index file either
    assert keyindex.outside(spark, path, since, tables.EVENT_INDEX) == (
        [f for f in keyindex.folders(spark, path) if f.date == "2024-01-09"], [])
    _land(spark, path, 20, ("x9", "2024-01-04T10:00", 99))
    read = tables.events(spark, path, since=since)
    assert read.count() == 0
    plan = read._jdf.queryExecution().executedPlan().toString()
    data = [scan for scan in plan.split("FileScan parquet")[1:] if "total_tokens" in scan.split("]")[0]]
    assert data and all(">= 2024-01-09" in s.split("PartitionFilters: ")[1].split("]")[0] for s in data)
    index = [f for f in read.inputFiles() if keyindex.FOLDER in f]
    assert {f.split("dt=")[1][:10] for f in index} == {"2024-01-04", "2024-01-09"}


def test_replay_under_another_date_replaces_its_index(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    _land(spark, path, 1, ("a", "2024-01-09T00:00", 1))
    _land(spark, path, 2, ("a", "2024-01-02T00:00", 2))
    assert _read(spark, path, "2024-01-09T00:00") == []
    _land(spark, path, 2, ("a", "2024-01-09T01:00", 2))
    assert _read(spark, path, "2024-01-09T00:00") == [("id-a", 2)]
    assert len([f for f in keyindex.folders(spark, path) if f.last == 2]) == 1


def test_merged_index_has_one_folder_per_date(spark, tmp_dir):
    path = f"{tmp_dir}/events"
    for batch in range(1, 6):
        _land(spark, path, batch, (f"e{batch}", "2024-01-02T00:00", batch), ("same", "2024-01-02T01:00", batch))
    _compact(spark, path, ["2024-01-02"])
    found = keyindex.folders(spark, path)
    assert [(f.first, f.last) for f in found] == [(1, 5)]
    assert spark.read.parquet(found[0].path).count() == 6


def test_dates_compacted_together_are_indexed_in_one_go(spark, tmp_dir, monkeypatch):
    path, calls, merge = f"{tmp_dir}/events", [], keyindex.merge
    monkeypatch.setattr(keyindex, "merge", lambda s, p, dates, i: (calls.append(dates), merge(s, p, dates, i)))
    days = [f"2024-01-{day:02d}" for day in range(1, 5)]
    for batch in (1, 2):
        _land(spark, path, batch, *[(f"x{d}", f"{d}T10:00", batch) for d in days])
    _compact(spark, path, days)
    assert calls == [days]
    assert sorted((f.date, f.first, f.last) for f in keyindex.folders(spark, path)) == [(d, 2, 2) for d in days]
    assert _read(spark, path, "2024-01-03T00:00") == [("id-x2024-01-03", 2), ("id-x2024-01-04", 2)]
