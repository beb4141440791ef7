"""Large values pass through every aggregate: nothing is clamped, dropped or raised."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from costpulse.functions import checks
from costpulse.operators import anomalies as an
from costpulse.operators import baselines, quality, reports, rollups
from costpulse.plans import registry
from costpulse.sources import raw_json
from costpulse.streaming import jobs
from tests.conftest import SF_MEDIUM

T0 = dt.datetime(2025, 1, 1)
UUID = "00000000-0000-4000-8000-%012d"


def _stats(spark, latencies, cost="1"):
    rows = [(T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i + 1), "m", float(x), 0.0,
             Decimal(cost)) for i, x in enumerate(latencies)]
    return spark.createDataFrame(
        rows, "window_start timestamp_ntz, window_end timestamp_ntz, model string, "
              "avg_latency_ms double, error_rate double, total_cost_usd decimal(28,6)")


def test_zscore_of_a_nearly_constant_history(spark):
    stats = _stats(spark, [1000.0, 1000.0000001] * 6 + [9000.0])
    found = baselines.zscores(stats)
    row = found.where(F.col("value") == 9000).first()
    assert row["z"] > 10 ** 10
    stored = baselines.zscore_anomalies(found).first()
    assert stored["metric_value"] == row["z"]


def _messages(spark, *costs):
    body = {"timestamp": "2025-01-01T00:00:01.000000+00:00", "model": "gpt-4o", "provider": "openai",
            "user_id": "u", "session_id": "s", "prompt_tokens": 10, "completion_tokens": 5,
            "total_tokens": 15, "latency_ms": 100, "status": "success", "error_code": None}
    lines = [(json.dumps(body | {"event_id": UUID % i, "request_id": UUID % i})[:-1]
              + f', "cost_usd": {c}}}',) for i, c in enumerate(costs)]
    return raw_json.decode(spark.createDataFrame(lines, "value string"))


def test_a_call_over_a_million_is_counted_but_not_landed(spark):
    decoded = _messages(spark, "1500000.25", "0.5", "999999.999999")
    events = jobs.countable(decoded, jobs.ROLLUP_KEYS)
    assert rollups.cost_rollups(events).first()["total_cost_usd"] == Decimal("2500000.7500")
    assert an.window_stats(events).first()["total_cost_usd"] == Decimal("2500000.749999")
    assessed = quality.assess(decoded, spark)
    assert quality.good(assessed).schema["cost_usd"].dataType.simpleString() == "decimal(12,6)"
    assert {str(r["cost_usd"]) for r in quality.good(assessed).collect()} == {
        "0.500000", "999999.999999"}
    assert [r["reasons"] for r in quality.quarantined(assessed).collect()] == [
        ["too_large:cost_usd"]]


def test_a_window_of_a_billion(spark):
    events = jobs.countable(_messages(spark, *["999999999.5"] * 3), jobs.ROLLUP_KEYS)
    total = Decimal("2999999998.5")
    rolled = rollups.cost_rollups(events)
    assert rolled.first()["total_cost_usd"] == total
    assert reports.cost_by_model(rolled, T0 + dt.timedelta(hours=1), "24 hours").first()[
        "total_cost"] == total
    hit = an.anomalies(events).where(F.col("anomaly_type") == "cost_spike").first()
    assert (hit["metric_value"], hit["severity"]) == (total, "critical")
    assert an.rounded_stats(an.window_stats(events)).first()["total_cost_usd"] == total
    stats = _stats(spark, [1.0, 1.0], "1000000000").unionByName(
        _stats(spark, [1.0] * 3, "5000000000").where(F.hour("window_start") == 2))
    spike = baselines.cost_baseline(stats).first()
    assert (spike["metric_value"], spike["threshold_value"]) == (5 * 10 ** 9, 2 * 10 ** 9)


def test_the_damaged_replay_reaches_every_warning(spark):
    seen = {(r["kind"], r["reason"]) for r in
            registry.REGISTRY["quarantine_reasons"].plan(spark, SF_MEDIUM).collect()}
    assert {r for kind, r in seen if kind == "warning"} == {n for n, _ in checks.soft_checks()}
    assert ("quarantine", "too_large:cost_usd") in seen
    assert registry.REGISTRY["provider_conflicts"].plan(spark, SF_MEDIUM).count() > 1
