"""Threshold boundaries through the real DataFrame detector, and baseline detectors."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costpulse.operators import anomalies as an
from costpulse.operators import baselines

W0 = dt.datetime(2024, 1, 1, 0, 0)

# (metric, value, expected severity or None): the boundary table of the detector rules.
BOUNDARIES = [
    ("avg_latency_ms", 0.0, None), ("avg_latency_ms", 2999.9, None),
    ("avg_latency_ms", 3000.0, "warning"), ("avg_latency_ms", 4500.0, "warning"),
    ("avg_latency_ms", 5999.9, "warning"), ("avg_latency_ms", 6000.0, "critical"),
    ("avg_latency_ms", 12000.0, "critical"),
    ("error_rate", 0.0, None), ("error_rate", 0.14, None), ("error_rate", 0.15, "warning"),
    ("error_rate", 0.25, "warning"), ("error_rate", 0.399, "warning"),
    ("error_rate", 0.40, "critical"), ("error_rate", 1.0, "critical"),
    ("total_cost_usd", 0.0, None), ("total_cost_usd", 0.99, None),
    ("total_cost_usd", 1.0, "warning"), ("total_cost_usd", 3.0, "warning"),
    ("total_cost_usd", 4.99, "warning"), ("total_cost_usd", 5.0, "critical"),
    ("total_cost_usd", 100.0, "critical"),
]
TYPE_OF = {"avg_latency_ms": "latency_spike", "error_rate": "error_surge",
           "total_cost_usd": "cost_spike"}


def _stats(spark, rows):
    """One window per row; the other two metrics neutral."""
    data = []
    for i, (metric, value, _) in enumerate(rows):
        vals = {"avg_latency_ms": 100.0, "error_rate": 0.0, "total_cost_usd": Decimal("0")}
        vals[metric] = Decimal(str(value)) if metric == "total_cost_usd" else value
        start = W0 + dt.timedelta(minutes=5 * i)
        data.append((start, start + dt.timedelta(minutes=5), f"m{i}", 10,
                     vals["avg_latency_ms"], vals["error_rate"], vals["total_cost_usd"]))
    schema = ("window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "total_requests bigint, avg_latency_ms double, error_rate double, "
              "total_cost_usd decimal(18,6)")
    return spark.createDataFrame(data, schema)


def test_threshold_boundaries(spark):
    found = {r["model"]: (r["anomaly_type"], r["severity"], r["threshold_value"])
             for r in an.detect(_stats(spark, BOUNDARIES)).collect()}
    for i, (metric, value, expected) in enumerate(BOUNDARIES):
        got = found.get(f"m{i}")
        if expected is None:
            assert got is None, (metric, value, got)
        else:
            assert got is not None, (metric, value)
            assert got[0] == TYPE_OF[metric] and got[1] == expected, (metric, value, got)


def test_threshold_value_follows_severity(spark):
    rows = an.detect(_stats(spark, [("avg_latency_ms", 7000.0, "critical"),
                                    ("error_rate", 0.2, "warning")])).collect()
    by_type = {r["anomaly_type"]: r for r in rows}
    assert by_type["latency_spike"]["threshold_value"] == Decimal("6000.0000")
    assert by_type["error_surge"]["threshold_value"] == Decimal("0.1500")


def test_one_window_can_raise_three_anomalies(spark):
    schema = ("window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "total_requests bigint, avg_latency_ms double, error_rate double, "
              "total_cost_usd decimal(18,6)")
    df = spark.createDataFrame([(W0, W0 + dt.timedelta(minutes=5), "m", 1, 9000.0, 1.0,
                                 Decimal("7"))], schema)
    rows = an.detect(df).collect()
    assert sorted(r["anomaly_type"] for r in rows) == ["cost_spike", "error_surge",
                                                       "latency_spike"]
    assert {r["severity"] for r in rows} == {"critical"}
    assert all(r["user_id"] is None for r in rows)


def test_null_metric_yields_no_row(spark):
    schema = ("window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "total_requests bigint, avg_latency_ms double, error_rate double, "
              "total_cost_usd decimal(18,6)")
    df = spark.createDataFrame([(W0, W0 + dt.timedelta(minutes=5), "m", 1, None, None, None)],
                               schema)
    assert an.detect(df).count() == 0


def test_detection_time_is_injectable(spark):
    when = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    rows = an.detect(_stats(spark, [("error_rate", 0.5, "critical")]), detected_at=when).collect()
    assert rows[0]["detected_at"] == dt.datetime(2024, 2, 1)


def _history(spark, values, column):
    data = []
    for i, v in enumerate(values):
        start = W0 + dt.timedelta(hours=i)
        data.append((start, start + dt.timedelta(hours=1), "m", 10, 100.0, 0.0,
                     Decimal(str(v)) if column == "cost" else Decimal("0"),
                     float(v) if column == "p95" else 100.0))
    schema = ("window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "total_requests bigint, avg_latency_ms double, error_rate double, "
              "total_cost_usd decimal(18,6), p95_latency_ms double")
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("last,expected", [(299.0, None), (301.0, "warning"),
                                           (600.0, "warning"), (601.0, "critical")])
def test_latency_baseline_ratio(spark, last, expected):
    rows = baselines.latency_baseline(_history(spark, [100.0] * 12 + [last], "p95")).collect()
    sev = [r["severity"] for r in rows if r["window_start"] == W0 + dt.timedelta(hours=12)]
    assert (sev[0] if sev else None) == expected


def test_cost_baseline_uses_only_previous_windows(spark):
    # The first window has no history: never flagged, whatever its value.
    rows = baselines.cost_baseline(_history(spark, [50, 1, 1, 3], "cost")).collect()
    assert rows == []
    rows = baselines.cost_baseline(_history(spark, [1, 1, 1, 3], "cost")).collect()
    assert [r["window_start"].hour for r in rows] == [3]
    assert rows[0]["threshold_value"] == Decimal("2.0000")


def test_zscore_constant_history_gives_no_score(spark):
    assert baselines.zscores(_history(spark, [1] * 14, "cost")).count() == 0
