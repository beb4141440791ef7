"""Pricing, tolerant decode, quality checks and the quarantine split."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costpulse.functions import pricing
from costpulse.operators import quality
from costpulse.sources import raw_json

GOOD = {
    "event_id": "3f2b8c1e-1111-4a2b-9c3d-000000000001",
    "timestamp": "2024-01-05T10:11:12.345678+00:00",
    "model": "gpt-4o", "provider": "openai", "user_id": "user_001", "session_id": "s-1",
    "prompt_tokens": 1000, "completion_tokens": 1000, "total_tokens": 2000,
    "cost_usd": 0.0125, "latency_ms": 900, "status": "success", "error_code": None,
    "request_id": "3f2b8c1e-2222-4a2b-9c3d-000000000001",
}


def _price(spark, model, p, c):
    cat = pricing.catalogue(spark).where(F.col("model") == model)
    df = cat.select(F.lit(p).alias("prompt_tokens"), F.lit(c).alias("completion_tokens"),
                    "in_micro", "out_micro")
    return df.select(pricing.micro_to_usd(pricing.cost_micro()).alias("c")).first()["c"]


def test_price_rows(spark):
    assert _price(spark, "gpt-4o", 1000, 1000) == Decimal("0.012500")
    assert _price(spark, "gpt-4o-mini", 0, 0) == Decimal("0")
    s1 = _price(spark, "claude-3-5-sonnet-20241022", 100, 100)
    assert _price(spark, "claude-3-5-sonnet-20241022", 200, 200) == 2 * s1
    assert _price(spark, "gemini-1.5-pro", 500, 200) > 0
    assert _price(spark, "gpt-4o-mini", 200, 100) != _price(spark, "gpt-4o-mini", 100, 200)


def test_catalogue_bands_cover_all_percent_points():
    rows = pricing.catalogue_rows()
    assert rows[0][5] == 0 and rows[-1][6] == 100
    assert all(a[6] == b[5] for a, b in zip(rows, rows[1:]))


def _assess(spark, lines):
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    return quality.assess(raw_json.decode(raw), spark)


def _reasons(spark, line):
    return _assess(spark, [line]).select("reasons", "warnings").first()


def _with(**changes):
    d = dict(GOOD)
    d.update(changes)
    return json.dumps(d)


def test_good_message_lands(spark):
    a = _assess(spark, [json.dumps(GOOD)])
    row = quality.good(a).first()
    assert row["ts"].isoformat() == "2024-01-05T10:11:12.345000"
    assert row["cost_usd"] == Decimal("0.012500")
    assert _reasons(spark, json.dumps(GOOD)) == ([], [])


@pytest.mark.parametrize("line", ["not json", '{"event_id": "x"', "[1,2]", ""])
def test_unparsable_messages(spark, line):
    assert "unparsable" in _reasons(spark, line)["reasons"]


def test_null_message(spark):
    raw = spark.createDataFrame([(None,)], "value string")
    a = quality.assess(raw_json.decode(raw), spark)
    assert a.first()["reasons"] == ["unparsable"]


def test_numeric_text_is_coerced_but_fractions_are_not(spark):
    assert _reasons(spark, _with(latency_ms="12"))["reasons"] == []
    assert _reasons(spark, _with(latency_ms=12.7))["reasons"] == ["not_integer:latency_ms"]
    assert _reasons(spark, _with(latency_ms="x"))["reasons"] == ["not_integer:latency_ms"]


def test_missing_field_and_unknown_field(spark):
    d = dict(GOOD)
    del d["session_id"]
    d["extra"] = 1
    assert _reasons(spark, json.dumps(d))["reasons"] == ["missing:session_id"]


def test_missing_error_code_is_allowed(spark):
    d = dict(GOOD)
    del d["error_code"]
    assert _reasons(spark, json.dumps(d)) == ([], [])


@pytest.mark.parametrize("stamp", ["yesterday", "2024-01-05T10:11:12.123Z"])
def test_bad_timestamp(spark, stamp):
    assert _reasons(spark, _with(timestamp=stamp))["reasons"] == ["bad_timestamp"]


def test_uuid_and_length_checks(spark):
    assert _reasons(spark, _with(event_id="abc"))["reasons"] == ["bad_uuid:event_id"]
    assert _reasons(spark, _with(status="s" * 21))["reasons"] == ["too_long:status"]


def test_soft_rules_warn_without_quarantine(spark):
    r = _reasons(spark, _with(total_tokens=1))
    assert r["reasons"] == [] and r["warnings"] == ["total_mismatch"]
    r = _reasons(spark, _with(status="error", error_code="nope", cost_usd=0))
    assert r["warnings"] == ["bad_error_code"]
    r = _reasons(spark, _with(status="timeout", error_code="request_timeout", cost_usd=0.5))
    assert r["warnings"] == ["failure_with_cost"]
    r = _reasons(spark, _with(model="other", provider="x"))
    assert r["warnings"] == ["unknown_model"]
    r = _reasons(spark, _with(provider="google"))
    assert r["warnings"] == ["provider_mismatch"]
    r = _reasons(spark, _with(cost_usd=0.02))
    assert r["warnings"] == ["cost_mismatch"]
    r = _reasons(spark, _with(latency_ms=10, prompt_tokens=5, total_tokens=1005))
    assert r["warnings"] == ["prompt_out_of_range", "latency_below_floor", "cost_mismatch"]


def test_split_is_complete(spark):
    lines = [json.dumps(GOOD), "not json", _with(event_id="bad"), _with(total_tokens=3)]
    a = _assess(spark, lines)
    assert quality.good(a).count() == 2
    q = quality.quarantined(a).collect()
    assert sorted(r["value"] for r in q) == sorted(["not json", _with(event_id="bad")])


def test_encode_decode_roundtrip(spark):
    a = _assess(spark, [json.dumps(GOOD)])
    landed = quality.good(a)
    again = quality.good(quality.assess(raw_json.decode(raw_json.encode(landed)), spark))
    assert landed.collect() == again.collect()


def test_decode_parses_json_once(spark):
    """Filters on decoded fields must not copy from_json below the generator."""
    a = _assess(spark, [json.dumps(GOOD)])
    plan = quality.good(a)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_jdbc_upsert_statement():
    from costpulse.sinks import jdbc

    sql = jdbc.upsert_sql("llm_events", "llm_events_staging", ["event_id", "ts", "model"],
                          ["event_id"])
    assert sql == ("INSERT INTO llm_events (event_id, ts, model) SELECT event_id, ts, model "
                   "FROM llm_events_staging ON CONFLICT (event_id) DO UPDATE SET "
                   "ts = EXCLUDED.ts, model = EXCLUDED.model")
