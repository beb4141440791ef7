"""Report semantics on small hand-made event tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.operators import anomalies as an
from costpulse.operators import reports
from costpulse.sources import fixtures
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 5, 10, 0, 0)


def _events(spark, rows):
    """rows: (seconds after T0, model, status, latency, tokens, cost, error_code)."""
    data = []
    for i, (sec, model, status, latency, tokens, cost, code) in enumerate(rows):
        data.append((f"3f2b8c1e-1111-4a2b-9c3d-{i:012d}", T0 + dt.timedelta(seconds=sec),
                     model, "openai", "user_001", "s-1", tokens // 2, tokens - tokens // 2,
                     tokens, Decimal(cost), latency, status, code,
                     f"3f2b8c1e-2222-4a2b-9c3d-{i:012d}"))
    return spark.createDataFrame(data, schemas.LLM_EVENTS)


def _calls(n_fail, n):
    rows = [(i, "gpt-4o", "error" if i < n_fail else "success", 100 + i, 10,
             "0" if i < n_fail else "0.000100", "server_error" if i < n_fail else None)
            for i in range(n)]
    return rows


def test_empty_range_coalesces_to_zero(spark):
    ev = _events(spark, _calls(1, 3))
    later = T0 + dt.timedelta(days=2)
    row = reports.kpis(ev, later, "1 hour").first()
    assert (row["total_requests"], row["total_cost_usd"], row["avg_latency_ms"]) == \
        (0, Decimal("0.0000"), 0)


@pytest.mark.parametrize("fails,n,expected", [(1, 8, "12.50"), (1, 16, "6.25"),
                                              (1, 32, "3.13"), (1, 3, "33.33"),
                                              (2, 3, "66.67"), (0, 5, "0.00")])
def test_error_rate_rounds_half_up_exactly(spark, fails, n, expected):
    ev = _events(spark, _calls(fails, n))
    stats = reports.minute_model_stats(ev, T0 + dt.timedelta(minutes=1), "1 hour")
    assert reports.error_rate(stats).first()["error_rate"] == Decimal(expected)


def test_latency_report_covers_successes_only(spark):
    ev = _events(spark, [(0, "gpt-4o", "error", 5000, 10, "0", "server_error"),
                         (1, "gpt-4o", "success", 101, 10, "0.000100", None),
                         (2, "gpt-4o", "success", 102, 10, "0.000100", None),
                         (65, "gpt-4o", "timeout", 9000, 10, "0", "request_timeout")])
    stats = reports.minute_model_stats(ev, T0 + dt.timedelta(minutes=2), "1 hour")
    rows = reports.latency_by_minute(stats).collect()
    # 101.5 rounds half up; the minute with only a timeout has no latency row.
    assert [(r["time"].minute, r["avg_latency_ms"]) for r in rows] == [(0, 102)]
    assert reports.avg_success_latency(ev, T0 + dt.timedelta(minutes=2)).first()["lat"] == 102


def test_live_feed_order_and_blank_error_code(spark):
    ev = _events(spark, _calls(1, 4))
    rows = reports.live_feed(ev, T0 + dt.timedelta(minutes=1), "15 minutes", k=3).collect()
    assert [r["time"].second for r in rows] == [3, 2, 1]
    assert [r["error_code"] for r in rows] == ["", "", ""]
    rows = reports.live_feed(ev, T0 + dt.timedelta(minutes=1), "15 minutes").collect()
    assert rows[-1]["error_code"] == "server_error"


def test_range_lower_bound_only(spark):
    ev = _events(spark, _calls(0, 3))
    # as_of before the events: a trailing range has no upper bound, the events count.
    assert reports.total_requests(ev, T0, "15 minutes").first()["cnt"] == 3
    with pytest.raises(ValueError):
        reports.total_requests(ev, T0, "2 hours")


def test_nested_ranges_come_from_one_scan(spark):
    """Ring sums against one report per range: bounds included, an empty range, odd events."""
    events = fixtures.llm_events(spark, SF_SMALL)
    as_of = events.agg(F.max("ts")).first()[0]
    stats = an.anomalies(events, 60)
    for now in (as_of, as_of + dt.timedelta(hours=2), as_of + dt.timedelta(days=3),
                as_of - dt.timedelta(days=9)):
        got = reports.kpis_by_range(events, now, stats)
        by = {r["report_range"]: tuple(r)[1:] for r in got.collect()}
        for r in schemas.REPORT_RANGES:
            want = tuple(reports.kpis(events, now, r).first()) + \
                tuple(reports.active_anomalies(stats, now, r).first())
            assert by[r] == want
    plan = reports.kpis_by_range(events, as_of)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
