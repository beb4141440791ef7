"""Backfill into stored tables, then the dashboard panels over them with range pruning."""

from __future__ import annotations

import pytest

from costpulse.plans import backfill, dashboard, registry
from costpulse.plans.compare import multiset
from costpulse.sources import fixtures, raw_json, replay, tables
from costpulse.streaming import jobs
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile

    base = tempfile.mkdtemp(prefix="costpulse-stored-")
    src = f"{base}/source"
    replay.messages(fixtures.llm_events(spark, SF_SMALL)).write.text(src)
    paths = jobs.Paths.under(base)
    backfill.run(spark, raw_json.json_lines(spark, src), paths)
    return paths


def _same(a, b):
    return multiset(a.columns, [tuple(r) for r in a.collect()]) == \
        multiset(b.columns, [tuple(r) for r in b.collect()])


def test_backfill_lands_every_event(spark, stored):
    landed = tables.events(spark, stored.events)
    assert _same(landed, fixtures.llm_events(spark, SF_SMALL))


def test_backfill_rollups_equal_batch_rollups(spark, stored):
    got = tables.rollups(spark, stored.rollups)
    assert _same(got, registry.REGISTRY["cost_rollup_60m"].plan(spark, SF_SMALL))


def test_backfill_anomalies_equal_batch_anomalies(spark, stored):
    got = spark.read.parquet(stored.anomalies).drop("dt", "batch_id")
    assert _same(got, registry.REGISTRY["anomalies_5m"].plan(spark, SF_SMALL))


@pytest.mark.parametrize("panel", ["event_rate", "error_rate", "latency_by_minute",
                                   "tokens_by_minute", "cost_by_minute", "live_feed",
                                   "cost_by_model", "recent_anomalies"])
def test_panels_over_stored_tables(spark, stored, panel):
    as_of = fixtures.max_event_time(spark, SF_SMALL)
    got = dashboard.panels(spark, stored, registry.REPORT_RANGE, as_of)[panel]
    assert _same(got, registry.REGISTRY[panel].plan(spark, SF_SMALL))


def test_range_prunes_partitions_and_pushes_time(spark, stored):
    as_of = fixtures.max_event_time(spark, SF_SMALL)
    df = dashboard.panels(spark, stored, "1 hour", as_of)["live_feed"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan
    assert "GreaterThanOrEqual(ts," in plan


def test_refresh_returns_every_panel(spark, stored):
    as_of = fixtures.max_event_time(spark, SF_SMALL)
    frames = dashboard.refresh(spark, stored, "24 hours", as_of)
    assert set(frames) >= {"kpis", "event_rate", "live_feed", "cost_by_model"}
    assert len(frames["live_feed"]) == registry.REGISTRY["live_feed"].plan(spark, SF_SMALL).count()
    assert int(frames["kpis"]["total_requests"][0]) == \
        registry.REGISTRY["kpi_requests"].plan(spark, SF_SMALL).first()["cnt"]
