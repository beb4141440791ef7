"""Rows behind the watermark: kept with their reason, counted, unchanged by replays."""

from __future__ import annotations

import datetime as dt

from costpulse.sources import raw_json, tables
from costpulse.streaming import jobs, lateness
from tests.test_stateful import _message, _put


def _land(spark, src, paths):
    q = jobs.landing(spark, raw_json.json_lines_stream(spark, src, 1), paths,
                     jobs.StreamConfig(late_rows=True), available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def _late(spark, paths):
    return sorted((int(r["event_id"][-3:]), r["window_end"].strftime("%d %H"), r["watermark"].strftime("%H:%M:%S"))
                  for r in tables.late_rows(spark, paths.late_rows).collect())


def test_late_rows_are_kept_landed_and_remembered_over_restarts(spark, tmp_dir):
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    assert tables.late_rows(spark, paths.late_rows).count() == 0
    _put(src, "a", _message(1, "2024-01-05T12:30:00"), _message(2, "2024-01-05T09:00:00"), "not json",
         _message(3, "yesterday"))
    _land(spark, src, paths)
    assert _late(spark, paths) == []            # nothing was closed before the first batch
    _put(src, "b", _message(4, "2024-01-05T11:59:59"), _message(5, "2024-01-05T12:00:00"),
         _message(6, "2024-01-05T13:00:10", model=None))
    _land(spark, src, paths)
    assert _late(spark, paths) == [(4, "05 12", "12:29:50")]
    _put(src, "c", _message(7, "2024-01-05T12:59:59"), _message(8, "2024-01-01T00:00:00"))
    _land(spark, src, paths)                    # 13:00:10 - 10 s closes the hour that ends at 13:00
    assert _late(spark, paths) == [(4, "05 12", "12:29:50"), (7, "05 13", "13:00:00"), (8, "01 01", "13:00:00")]
    assert {int(r["event_id"][-3:]) for r in tables.events(spark, paths.events).collect()} == {1, 2, 4, 5, 7, 8}
    assert tables.late_rows(spark, paths.late_rows).first()["reasons"] == [lateness.REASON]


def test_ledger_is_small_and_a_replay_reads_what_its_batch_read(spark, tmp_dir):
    ledger = f"{tmp_dir}/times"
    t = dt.datetime(2024, 1, 5, 10)
    assert lateness.newest_before(spark, ledger, 9) is None
    for batch in range(10):
        newest = None if batch == 4 else t + dt.timedelta(minutes=batch if batch != 7 else -60)
        lateness.record(spark, ledger, batch, newest)
    assert len(lateness._entries(spark, ledger)) == lateness.KEPT
    assert lateness.newest_before(spark, ledger, 8) == t + dt.timedelta(minutes=6)
    lateness.record(spark, ledger, 9, t + dt.timedelta(minutes=9))
    assert lateness.newest_before(spark, ledger, 10) == t + dt.timedelta(minutes=9)
    assert lateness.delay_of("10 seconds") == dt.timedelta(seconds=10)
    assert lateness.delay_of("1 hour") == dt.timedelta(hours=1)


def test_counts_and_replay_of_a_batch(spark, tmp_dir):
    from costpulse.operators import quality
    src, paths = f"{tmp_dir}/src", jobs.Paths.under(tmp_dir)
    windows = lateness.Windows(60, "10 seconds", f"{tmp_dir}/times")
    _put(src, "a", _message(1, "2024-01-05T12:30:00"))
    _put(src, "b", _message(2, "2024-01-05T10:30:00"), _message(3, "2024-01-05T12:45:00"), "{}")
    for batch, name in ((1, "a"), (2, "b"), (2, "b")):
        rows = quality.assess(raw_json.decode(raw_json.json_lines(spark, f"{src}/{name}")), spark)
        assert lateness.keep(spark, rows, batch, paths.late_rows, windows) == (name == "b")
    assert _late(spark, paths) == [(2, "05 11", "12:29:50")]
