"""Named query plans: each key has a Spark plan over the driver tables and, where the result
is expressible in SQL, the DuckDB text that must give the same rows.

A plan callable takes ``(spark, sf_dir)`` and returns a DataFrame; it reads the whole
tables (reports apply their own time range, which is the report's definition).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import timefn
from costpulse.operators import anomalies as an
from costpulse.operators import baselines, quality, reports, rollups
from costpulse.plans import backfill, dashboard, oracle
from costpulse.session import prepare, scratch_path
from costpulse.sinks import tables
from costpulse.sources import fixtures, raw_json, replay
from costpulse.sources import tables as source_tables
from costpulse.streaming import jobs, summaries

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    plan: Plan
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, operators: str):
    def deco(fn: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        plan.__name__ = plan.__qualname__ = name
        plan.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, plan, sql, operators)
        return fn
    return deco


# ---------------------------------------------------------------------------- landing

@register("llm_events_landed", oracle.with_events("SELECT * FROM llm_events"),
          "P1 P2 P10-P14 J1")
def llm_events_landed(spark, sf_dir):
    return fixtures.llm_events(spark, sf_dir)


# ---------------------------------------------------------------------------- rollups

def _rollup(minutes):
    def plan(spark, sf_dir):
        return rollups.cost_rollups(fixtures.llm_events(spark, sf_dir), minutes)
    return plan


for _m, _suffix in ((60, "60m"), (1440, "1d")):
    register(f"cost_rollup_{_suffix}",
             oracle.with_events("SELECT * FROM rollups", oracle.rollup_cte(_m)),
             "A1 A3-A6 T2 N1 P3 P4")(_rollup(_m))


# Longer windows and fewer keys from stored hourly rollups alone: their sketches are merged.

def _stored_sketches(spark, sf_dir):
    """Hourly rollups with latency sketches, as a backfill of the messages stores them."""
    source, paths = _stream_source(spark, sf_dir)
    backfill.run(spark, raw_json.json_lines(spark, source), paths,
                 jobs.StreamConfig(percentile="sketch"))
    return source_tables.rollups(spark, paths.rollups, sketches=True)


def _merged_sql(minutes: int, p95: str) -> str:
    return f"""SELECT {oracle.bucket(minutes)} AS window_start,
  {oracle.bucket(minutes)} + INTERVAL '{minutes} minutes' AS window_end, model,
  CAST(count(*) AS BIGINT) AS total_requests,
  CAST(sum(CAST(total_tokens AS BIGINT)) AS BIGINT) AS total_tokens, {p95}
FROM llm_events GROUP BY ALL"""


@register("sketch_p95_1h", oracle.with_events(_merged_sql(
    60, "CAST(quantile_disc(latency_ms, 0.95) AS BIGINT) AS p95_latency_ms")), "N1 A9 K2 S8")
def sketch_p95_1h(spark, sf_dir):
    """Hourly p95 by model, users merged: groups this small are exact in their sketches."""
    return rollups.merged_rollups(_stored_sketches(spark, sf_dir), 60).drop("total_cost_usd")


@register("sketch_p95_1d", oracle.with_events(_merged_sql(1440, "TRUE AS within_bound")),
          "N1 A9 K2 S8")
def sketch_p95_1d(spark, sf_dir):
    """Daily p95 by model from 24 hours of stored sketches, held against the exact latencies
    at the two ends of the sketch's rank interval."""
    daily = rollups.merged_rollups(_stored_sketches(spark, sf_dir), 1440)
    ends = [0.95 - rollups.SKETCH_RANK_ERROR, 0.95 + rollups.SKETCH_RANK_ERROR]
    window = F.window("ts", "1440 minutes")
    exact = (fixtures.llm_events(spark, sf_dir).groupBy(window.alias("w"), "model").agg(*[
        F.expr(f"percentile_disc({r}) WITHIN GROUP (ORDER BY latency_ms)").alias(name)
        for r, name in zip(ends, ("low", "high"))])
        .select(F.col("w.start").alias("window_start"), "model", "low", "high"))
    return daily.join(exact, ["window_start", "model"], "left").select(
        "window_start", "window_end", "model", "total_requests", "total_tokens",
        F.coalesce(F.col("p95_latency_ms").between(F.col("low"), F.col("high")), F.lit(False))
        .alias("within_bound"))


# ---------------------------------------------------------------------------- window stats

def _stats(minutes):
    def plan(spark, sf_dir):
        return an.rounded_stats(an.window_stats(fixtures.llm_events(spark, sf_dir), minutes,
                                                with_p95=True))
    return plan


_STATS_SELECT = f"""SELECT window_start, window_end, model, total_requests,
  {oracle.dec("avg_latency_ms", 12, 2)} AS avg_latency_ms,
  {oracle.dec("error_rate", 12, 6)} AS error_rate,
  CAST(total_cost_usd AS DECIMAL(28,6)) AS total_cost_usd,
  {oracle.dec("p95_latency_ms", 12, 2)} AS p95_latency_ms
FROM stats"""

for _m, _suffix in ((5, "5m"), (60, "60m")):
    register(f"window_stats_{_suffix}",
             oracle.with_events(_STATS_SELECT, oracle.stats_cte(_m, with_p95=True)),
             "A2 T3 P5 N1")(_stats(_m))


# ---------------------------------------------------------------------------- anomalies

def _anomalies(minutes):
    def plan(spark, sf_dir):
        return an.anomalies(fixtures.llm_events(spark, sf_dir), minutes)
    return plan


for _m, _suffix in ((5, "5m"), (60, "60m"), (1440, "1d")):
    register(f"anomalies_{_suffix}",
             oracle.with_events("SELECT * FROM anomalies", oracle.anomalies_cte(_m)),
             "A2 U1 P6-P9 F7 T3")(_anomalies(_m))


# ---------------------------------------------------------------------------- reports
# One "now" per report: the newest event time (a literal, so the range bound is pushed into
# the scan). Range: the widest offered by the dashboard.

REPORT_RANGE = "24 hours"
ANOMALY_WINDOW_MIN = 5
_RANGE_SQL = f"(SELECT as_of FROM as_of) - INTERVAL '{REPORT_RANGE}'"


def _as_of(spark, sf_dir) -> tuple[dt.datetime, dt.datetime]:
    as_of = fixtures.max_event_time(spark, sf_dir)
    return as_of, timefn.range_start(as_of, REPORT_RANGE)


def _ranged_events(spark, sf_dir):
    as_of, start = _as_of(spark, sf_dir)
    return fixtures.llm_events(spark, sf_dir, since=start), as_of


def _ranged_anomalies(spark, sf_dir):
    """Anomalies detected in range. A window detected at or after ``start`` begins at or after
    ``start - window - delay``, so only events from there on are read (whole windows)."""
    as_of, start = _as_of(spark, sf_dir)
    lead = dt.timedelta(minutes=ANOMALY_WINDOW_MIN, seconds=10)
    events = fixtures.llm_events(spark, sf_dir, since=start - lead)
    return an.anomalies(events, ANOMALY_WINDOW_MIN), as_of


def _ev(sql, *ctes):
    return oracle.with_events(sql, oracle.AS_OF, *ctes)


_IN_RANGE = f"WHERE ts >= {_RANGE_SQL}"


@register("kpi_requests", _ev(f"SELECT count(*) AS cnt FROM llm_events {_IN_RANGE}"),
          "R1 F1 A3 A7")
def kpi_requests(spark, sf_dir):
    events, as_of = _ranged_events(spark, sf_dir)
    return reports.total_requests(events, as_of, REPORT_RANGE)


@register("kpi_cost", _ev(f"""SELECT CAST(COALESCE(round(sum(cost_usd), 4), 0) AS DECIMAL(18,4))
  AS cost FROM llm_events {_IN_RANGE}"""), "R2 F1 A5 A7 P10")
def kpi_cost(spark, sf_dir):
    events, as_of = _ranged_events(spark, sf_dir)
    return reports.total_cost(events, as_of, REPORT_RANGE)


@register("kpi_latency", _ev(f"""SELECT CAST(COALESCE(round(avg(latency_ms)), 0) AS BIGINT) AS lat
  FROM llm_events {_IN_RANGE} AND status = 'success'"""), "R3 F1 F5 A6 A7 P10")
def kpi_latency(spark, sf_dir):
    events, as_of = _ranged_events(spark, sf_dir)
    return reports.avg_success_latency(events, as_of, REPORT_RANGE)


@register("kpis", _ev(f"""SELECT count(*) AS total_requests,
  CAST(COALESCE(round(sum(cost_usd), 4), 0) AS DECIMAL(18,4)) AS total_cost_usd,
  CAST(COALESCE(round(avg(CASE WHEN status = 'success' THEN latency_ms END)), 0) AS BIGINT)
    AS avg_latency_ms
  FROM llm_events {_IN_RANGE}"""), "R1-R3 in one scan")
def kpis(spark, sf_dir):
    events, as_of = _ranged_events(spark, sf_dir)
    return reports.kpis(events, as_of, REPORT_RANGE)


_RANGE_KPIS = "\nUNION ALL\n".join(f"""SELECT '{r}' AS report_range, count(*) AS total_requests,
  CAST(COALESCE(round(sum(cost_usd), 4), 0) AS DECIMAL(18,4)) AS total_cost_usd,
  CAST(COALESCE(round(avg(CASE WHEN status = 'success' THEN latency_ms END)), 0) AS BIGINT)
    AS avg_latency_ms
FROM llm_events WHERE ts >= (SELECT as_of FROM as_of) - INTERVAL '{r}'"""
                                 for r in schemas.REPORT_RANGES)


@register("kpis_all_ranges", _ev(_RANGE_KPIS), "R1-R3 F1 F4")
def kpis_all_ranges(spark, sf_dir):
    """The KPI row of every range the dashboard offers, from one scan."""
    as_of = fixtures.max_event_time(spark, sf_dir)
    events = fixtures.llm_events(spark, sf_dir, since=timefn.range_start(as_of, REPORT_RANGE))
    return reports.kpis_by_range(events, as_of)


@register("kpi_anomalies", _ev(f"""SELECT count(*) AS active_anomalies FROM anomalies
  WHERE detected_at >= {_RANGE_SQL}""", oracle.anomalies_cte(ANOMALY_WINDOW_MIN)),
          "R4 F3 A3")
def kpi_anomalies(spark, sf_dir):
    anomalies, as_of = _ranged_anomalies(spark, sf_dir)
    return reports.active_anomalies(anomalies, as_of, REPORT_RANGE)


_MINUTE = f"""SELECT date_trunc('minute', ts) AS time, model, {{measure}}
FROM llm_events {_IN_RANGE}{{extra}} GROUP BY 1, 2 ORDER BY 1, 2"""

_MINUTE_REPORTS = {
    "event_rate": ("count(*) AS events", "", reports.event_rate, "R5 A8 L1"),
    "error_rate": ("""CAST(((20000 * sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) + count(*))
     // (2 * count(*))) * 0.01 AS DECIMAL(7,2)) AS error_rate""", "", reports.error_rate,
                   "R6 A8 A4 F6 L1"),
    "latency_by_minute": ("CAST(round(avg(latency_ms)) AS BIGINT) AS avg_latency_ms",
                          " AND status = 'success'", reports.latency_by_minute, "R7 A8 F5 L1"),
    "tokens_by_minute": ("CAST(sum(total_tokens) AS BIGINT) AS total_tokens", "",
                         reports.tokens_by_minute, "R8 A8 A5 L1"),
    "cost_by_minute": ("CAST(round(sum(cost_usd), 6) AS DECIMAL(18,6)) AS cost_usd", "",
                       reports.cost_by_minute, "R9 A8 A5 L1"),
}


def _minute_plan(report):
    def plan(spark, sf_dir):
        events, as_of = _ranged_events(spark, sf_dir)
        return report(reports.minute_model_stats(events, as_of, REPORT_RANGE))
    return plan


for _name, (_measure, _extra, _report, _ops) in _MINUTE_REPORTS.items():
    register(_name, _ev(_MINUTE.format(measure=_measure, extra=_extra)), _ops)(
        _minute_plan(_report))


@register("cost_by_model", _ev(f"""SELECT model,
  CAST(sum(total_cost_usd) AS DECIMAL(38,4)) AS total_cost
FROM rollups WHERE window_start >= {_RANGE_SQL}
GROUP BY model ORDER BY total_cost DESC, model""", oracle.rollup_cte(60)), "R10 A9 F2 L2")
def cost_by_model(spark, sf_dir):
    as_of, start = _as_of(spark, sf_dir)
    # Windows starting in range hold only events from ``start`` on: read just those.
    events = fixtures.llm_events(spark, sf_dir, since=start)
    return reports.cost_by_model(rollups.cost_rollups(events, 60), as_of, REPORT_RANGE)


@register("recent_anomalies", _ev(f"""SELECT detected_at, anomaly_type, severity, model, user_id,
  metric_value, threshold_value, window_start, window_end
FROM anomalies WHERE detected_at >= {_RANGE_SQL}
ORDER BY detected_at DESC, anomaly_type, model, window_start DESC LIMIT 100""",
                                   oracle.anomalies_cte(ANOMALY_WINDOW_MIN)), "R11 F3 L3")
def recent_anomalies(spark, sf_dir):
    anomalies, as_of = _ranged_anomalies(spark, sf_dir)
    return reports.recent_anomalies(anomalies, as_of, REPORT_RANGE)


@register("live_feed", _ev(f"""SELECT ts AS time, model, user_id, prompt_tokens, completion_tokens,
  CAST(round(cost_usd, 6) AS DECIMAL(12,6)) AS cost_usd, latency_ms, status,
  COALESCE(error_code, '') AS error_code
FROM llm_events {_IN_RANGE} ORDER BY ts DESC, event_id LIMIT 100"""), "R12 F1 L4 P10")
def live_feed(spark, sf_dir):
    events, as_of = _ranged_events(spark, sf_dir)
    return reports.live_feed(events, as_of, REPORT_RANGE)


# ---------------------------------------------------------------------------- baselines
# Hourly windows: a p95 over 5-minute windows of a few calls says little.

BASELINE_WINDOW_MIN = 60


def _baseline_stats(spark, sf_dir):
    return an.window_stats(fixtures.llm_events(spark, sf_dir), BASELINE_WINDOW_MIN,
                           with_p95=True)


_N2 = oracle.ratio_baseline_sql(oracle.dec("p95_latency_ms", 12, 2), 2, "latency_spike",
                                *schemas.LATENCY_BASELINE_RATIOS)
_N3 = oracle.ratio_baseline_sql("CAST(total_cost_usd AS DECIMAL(18,6))", 6, "cost_spike",
                                schemas.COST_BASELINE_RATIO, None)


def _split_ctes(sql: str) -> tuple[list[str], str]:
    """Split 'a AS (..),\nb AS (..)\nSELECT ..' into CTE texts and the final SELECT."""
    head, _, body = sql.rpartition("\nSELECT ")
    return [head], "SELECT " + body


def _with_stats(sql: str) -> str:
    ctes, body = _split_ctes(sql)
    return oracle.with_events(body, oracle.stats_cte(BASELINE_WINDOW_MIN, with_p95=True), *ctes)


@register("latency_baseline", _with_stats(_N2), "N2 N1 A2")
def latency_baseline(spark, sf_dir):
    return baselines.latency_baseline(_baseline_stats(spark, sf_dir))


@register("cost_baseline", _with_stats(_N3), "N3 A2")
def cost_baseline(spark, sf_dir):
    return baselines.cost_baseline(_baseline_stats(spark, sf_dir))


@register("zscore", _with_stats(oracle.zscore_sql()), "N4 A2")
def zscore(spark, sf_dir):
    return baselines.zscores(_baseline_stats(spark, sf_dir))


# ---------------------------------------------------------------------------- ingest

def _rule_case() -> str:
    on = {None: "", "success": " AND status = 'success'", "failure": " AND status <> 'success'"}
    arms = " ".join(f"WHEN n % {r.modulus} = 0{on[r.on]} THEN '{r.name}'" for r in replay.RULES)
    return f"CASE {arms} END"


_RULED = ("ruled AS (SELECT *, " + _rule_case() + " AS rule FROM "
          "(SELECT *, CAST(right(event_id, 12) AS BIGINT) AS n FROM llm_events))")
_QUARANTINE_RULES = ", ".join(f"'{r.name}'" for r in replay.RULES
                              if any(kind == "quarantine" for kind, _ in r.outcomes))
_RULE_VALUES = ", ".join(f"('{r.name}', '{kind}', '{reason}')"
                         for r in replay.RULES for kind, reason in r.outcomes)


def _assessed(spark, sf_dir):
    msgs = replay.damaged_messages(fixtures.llm_events(spark, sf_dir))
    return quality.assess(raw_json.decode(msgs), spark)


# Expected landed rows of the damaged replay: damaged-by-field rows land changed, rows the
# store rejects are left out.
_LANDED_CTE = f"""landed AS (SELECT event_id, ts,
  CASE WHEN rule = 'unlisted_model' THEN 'unlisted-model' ELSE model END AS model,
  CASE WHEN rule = 'other_provider' THEN 'other' ELSE provider END AS provider,
  user_id, session_id,
  CASE WHEN rule = 'prompt_over' THEN 32001 ELSE prompt_tokens END AS prompt_tokens,
  CASE WHEN rule = 'completion_over' THEN 4097 ELSE completion_tokens END AS completion_tokens,
  CASE rule WHEN 'total_off_by_one' THEN total_tokens + 1
    WHEN 'prompt_over' THEN 32001 + completion_tokens
    WHEN 'completion_over' THEN prompt_tokens + 4097 ELSE total_tokens END AS total_tokens,
  CAST(CASE rule WHEN 'free_call' THEN 0 WHEN 'cost_off' THEN cost_usd + 0.01
    WHEN 'cost_on_failure' THEN 0.5 ELSE cost_usd END AS DECIMAL(12,6)) AS cost_usd,
  CASE WHEN rule = 'latency_low' THEN 49 ELSE latency_ms END AS latency_ms,
  CASE WHEN rule = 'status_word' THEN 'unknown' ELSE status END AS status,
  CASE WHEN rule = 'code_on_success' THEN 'server_error' ELSE error_code END AS error_code,
  request_id
FROM ruled WHERE rule IS NULL OR rule NOT IN ({_QUARANTINE_RULES}))"""
_LANDED_SQL = oracle.with_events("SELECT * FROM landed", _RULED, _LANDED_CTE)


@register("json_roundtrip", _LANDED_SQL, "S4 P1 P2 K4 K7 Q1-Q12 J1")
def json_roundtrip(spark, sf_dir):
    return quality.good(_assessed(spark, sf_dir))


@register("quarantine_reasons", oracle.with_events(f"""SELECT kind, reason, count(*) AS events
FROM ruled JOIN (VALUES {_RULE_VALUES}) AS rules(rule, kind, reason) USING (rule)
GROUP BY kind, reason""", _RULED), "S4 K7 Q1-Q12")
def quarantine_reasons(spark, sf_dir):
    return quality.reason_counts(_assessed(spark, sf_dir))


@register("provider_conflicts", oracle.with_events(
    """SELECT model, count(DISTINCT provider) AS providers FROM landed
GROUP BY model HAVING count(DISTINCT provider) > 1""", _RULED, _LANDED_CTE), "Q8")
def provider_conflicts(spark, sf_dir):
    """Models that the damaged replay lands with more than one provider."""
    return rollups.provider_conflicts(quality.good(_assessed(spark, sf_dir)))


# ---------------------------------------------------------------------------- upsert

_UPSERT_SQL = oracle.with_events("""SELECT * EXCLUDE (batch, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY batch DESC) AS rn FROM batches)
WHERE rn = 1""", """d0 AS (SELECT date_trunc('day', min(ts)) AS d0 FROM llm_events)""",
    """batches AS (
  SELECT *, 1 AS batch FROM llm_events WHERE ts < (SELECT d0 FROM d0) + INTERVAL 20 DAYS
  UNION ALL
  SELECT * REPLACE (latency_ms + 1 AS latency_ms), 2 AS batch FROM llm_events
  WHERE ts >= (SELECT d0 FROM d0) + INTERVAL 10 DAYS + INTERVAL 12 HOURS)""")


@register("upsert_latest", _UPSERT_SQL, "K1 K8 K9 T8")
def upsert_latest(spark, sf_dir):
    """Two overlapping deliveries (days 1-20 as sent; from the middle of day 11 on, re-sent
    with a corrected latency) upserted on event_id into a date-partitioned table; the later
    delivery wins, and the first half of day 11 survives the rewrite of its partition."""
    events = fixtures.llm_events(spark, sf_dir)
    d0 = events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")).first()[0]
    first = events.where(F.col("ts") < F.lit(d0 + dt.timedelta(days=20)).cast("timestamp_ntz"))
    second = (events.where(F.col("ts") >= F.lit(d0 + dt.timedelta(days=10, hours=12))
                           .cast("timestamp_ntz"))
                    .withColumn("latency_ms", F.col("latency_ms") + 1))
    path = scratch_path(spark, "upsert_latest")
    for batch in (first, second):
        tables.upsert(spark, tables.with_date(batch, "ts"), path, key=["event_id"], order=[],
                      partition_cols=["dt"], sort_cols=["model", "ts"])
    return spark.read.parquet(path).select(*events.columns)


# ---------------------------------------------------------------------------- streaming
# The fixture events as a JSON-lines message stream, processed by the streaming jobs with
# an availableNow trigger. A window is emitted once the watermark (newest event time minus
# 10 s) passes its end, so the batch oracle keeps the windows closed by that watermark.

_WATERMARK_SQL = "wm AS (SELECT max(ts) - INTERVAL 10 SECONDS AS wm FROM llm_events)"


def _stream_source(spark, sf_dir) -> tuple[str, jobs.Paths]:
    base = scratch_path(spark, "streams")
    source = f"{base}/source"
    replay.messages(fixtures.llm_events(spark, sf_dir)).write.text(source)
    return source, jobs.Paths.under(base)


DELIVERIES = 3


def _delivered_in_order(spark, sf_dir, job, deliveries: int = DELIVERIES) -> jobs.Paths:
    """The messages arrive in time order in ``deliveries`` parts of equal time; after each,
    ``job(raw, paths)`` runs until it has read them and stops. Every run but the first goes
    on from the checkpoint, with the windows that the last part left open."""
    base = scratch_path(spark, "streams")
    source, paths = f"{base}/source", jobs.Paths.under(base)
    events = fixtures.llm_events(spark, sf_dir)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:                            # an empty table: one empty delivery
        first = last = dt.datetime(1970, 1, 1)
    step = (last - first) / deliveries
    for i in range(deliveries):
        part = events.where(F.col("ts") >= timefn.ntz_lit(first + i * step)) if i else events
        if i < deliveries - 1:
            part = part.where(F.col("ts") < timefn.ntz_lit(first + (i + 1) * step))
        replay.messages(part).write.mode("append").text(source)
        _await(job(raw_json.json_lines_stream(spark, source), paths))
    return paths


def _replay_config(spark, **kw) -> jobs.StreamConfig:
    """State partitions sized to the replayed input (one fixture file set), not to the
    session default meant for large shuffles."""
    return jobs.StreamConfig(state_partitions=spark.sparkContext.defaultParallelism, **kw)


def _await(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("stream_rollup_closed", oracle.with_events(
    "SELECT * FROM rollups WHERE window_end <= (SELECT wm FROM wm)",
    _WATERMARK_SQL, oracle.rollup_cte(60)), "S1-S6 T1 T2 T4 T6 K2 A1")
def stream_rollup_closed(spark, sf_dir):
    paths = _delivered_in_order(spark, sf_dir, lambda raw, p: jobs.rollup_job(
        spark, raw, p, _replay_config(spark), available_now=True))
    return source_tables.rollups(spark, paths.rollups)


_ANOMALY_COLS = ("anomaly_type", "model", "user_id", "metric_value", "threshold_value",
                 "severity", "window_start", "window_end")


@register("stream_anomalies_closed", oracle.with_events(
    f"SELECT {', '.join(_ANOMALY_COLS)} FROM anomalies WHERE window_end <= (SELECT wm FROM wm)",
    _WATERMARK_SQL, oracle.anomalies_cte(60)), "T1 T3 T4 T6 U1 K3 K4 K5")
def stream_anomalies_closed(spark, sf_dir):
    config = _replay_config(spark, anomaly_minutes=60)
    paths = _delivered_in_order(spark, sf_dir, lambda raw, p: jobs.anomaly_job(
        spark, raw, p, config, available_now=True))
    return source_tables.anomalies(spark, paths.anomalies).select(*_ANOMALY_COLS)


_LEVEL_SELECT = """SELECT {m} AS minutes, window_start, window_end, model, total_requests,
  {avg} AS avg_latency_ms, {err} AS error_rate, CAST(total_cost_usd AS DECIMAL(28,6)) AS total_cost_usd
FROM level_{m} WHERE window_end <= (SELECT wm FROM wm)"""


@register("stream_shared_panes", oracle.with_events("\nUNION ALL\n".join(
    _LEVEL_SELECT.format(m=m, avg=oracle.dec("avg_latency_ms", 12, 2), err=oracle.dec("error_rate", 12, 6))
    for m in (5, 60)), _WATERMARK_SQL, oracle.stats_cte(5, "level_5"), oracle.stats_cte(60, "level_60")),
    "T1 T2 T3 T4 T6 A2")
def stream_shared_panes(spark, sf_dir):
    """5-minute and hourly statistics of one streaming query over five deliveries with restarts:
    the hours are added up from the panes, the messages read once."""
    paths = _delivered_in_order(spark, sf_dir, lambda raw, p: jobs.levels_job(
        spark, raw, p, _replay_config(spark), available_now=True), deliveries=5)
    stored = source_tables.window_levels(spark, paths.window_levels)
    return stored.select(
        "minutes", "window_start", "window_end", "model", "total_requests",
        F.col("avg_latency_ms").cast(schemas.LATENCY_TYPE).alias("avg_latency_ms"),
        F.col("error_rate").cast("decimal(12,6)").alias("error_rate"), "total_cost_usd")


@register("stream_dedup", oracle.with_events("SELECT * FROM llm_events"), "T8 S4")
def stream_dedup(spark, sf_dir):
    """Every message delivered twice (the second delivery in a later file); the stream keeps
    one row per event_id."""
    source, paths = _stream_source(spark, sf_dir)
    replay.messages(fixtures.llm_events(spark, sf_dir)).write.mode("append").text(source)
    out = f"{paths.events}_dedup"
    q = jobs.dedup_job(spark, raw_json.json_lines_stream(spark, source), out, paths,
                       _replay_config(spark), available_now=True)
    _await(q)
    return spark.read.parquet(out)


def _landed_stream(spark, sf_dir) -> jobs.Paths:
    """The damaged message replay, landed by the streaming landing job (merge-on-read)."""
    base = scratch_path(spark, "streams")
    source = f"{base}/source"
    replay.damaged_messages(fixtures.llm_events(spark, sf_dir)).write.text(source)
    paths = jobs.Paths.under(base)
    _await(jobs.landing(spark, raw_json.json_lines_stream(spark, source), paths,
                        _replay_config(spark), available_now=True))
    return paths


@register("stream_landing", _LANDED_SQL, "T7 K1 S4 P1 P2 Q1-Q12")
def stream_landing(spark, sf_dir):
    return source_tables.events(spark, _landed_stream(spark, sf_dir).events)


@register("stream_quarantine", oracle.with_events(f"""SELECT reason, count(*) AS events
FROM ruled JOIN (VALUES {_RULE_VALUES}) AS rules(rule, kind, reason) USING (rule)
WHERE kind = 'quarantine' GROUP BY reason""", _RULED), "K7 K3 Q1-Q3 Q10 Q12")
def stream_quarantine(spark, sf_dir):
    bad = source_tables.quarantine(spark, _landed_stream(spark, sf_dir).quarantine)
    return (bad.select(F.explode("reasons").alias("reason"))
               .groupBy("reason").agg(F.count(F.lit(1)).alias("events")))


# ---------------------------------------------------------------------------- stored tables
# The reports as the dashboard runs them: over the tables that a backfill of the messages has
# stored, pruned to the range, with the newest stored event time as "now".

def _stored_panel(panel):
    def plan(spark, sf_dir):
        source, paths = _stream_source(spark, sf_dir)
        backfill.run(spark, raw_json.json_lines(spark, source), paths)
        as_of = source_tables.newest_time(spark, paths.events, "ts")
        return dashboard.panels(spark, paths, REPORT_RANGE, as_of)[panel]
    return plan


for _panel, _key, _ops in (
        ("error_rate", "error_rate", "S7 R6"),
        ("cost_by_model", "cost_by_model", "S8 R10 K2"),
        ("recent_anomalies", "recent_anomalies", "S9 R11 K3"),
        ("live_feed", "live_feed", "S7 R12")):
    register(f"stored_{_panel}", REGISTRY[_key].sql, _ops)(_stored_panel(_panel))


_RANGE_ANOMALIES = "\nUNION ALL\n".join(f"""SELECT '{r}' AS report_range, count(*) AS active_anomalies
FROM anomalies WHERE detected_at >= (SELECT as_of FROM as_of) - INTERVAL '{r}'"""
                                      for r in schemas.REPORT_RANGES)


@register("stored_kpis_all_ranges", _ev(f"SELECT * FROM ({_RANGE_KPIS}) JOIN ({_RANGE_ANOMALIES}) "
                                        "USING (report_range)", oracle.anomalies_cte(ANOMALY_WINDOW_MIN)),
          "S7 S9 R1-R4 F1 F4")
def stored_kpis_all_ranges(spark, sf_dir):
    """R1-R4 of all six ranges over stored tables: one scan of the events, one of the anomalies."""
    source, paths = _stream_source(spark, sf_dir)
    backfill.run(spark, raw_json.json_lines(spark, source), paths)
    as_of = source_tables.newest_time(spark, paths.events, "ts")
    return dashboard.all_ranges(spark, paths, as_of)


@register("redelivered_compacted", oracle.with_events("""SELECT * EXCLUDE (n) REPLACE (
  CASE WHEN n % 5 <> 0 AND n % 3 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts,
  CASE WHEN n % 5 = 0 THEN latency_ms + 3 WHEN n % 3 = 0 THEN latency_ms + 1
    ELSE latency_ms END AS latency_ms)
FROM (SELECT *, CAST(right(event_id, 12) AS BIGINT) AS n FROM llm_events)"""), "K1 S7 T7 T8 K8")
def redelivered_compacted(spark, sf_dir):
    """A live landing of all events; a backfill that sends every third again a day later; then
    one that sends every fifth twice in the same file. Dates are compacted after each run, in
    the end all. The last delivery of an event is the one that counts."""
    source, paths = _stream_source(spark, sf_dir)
    events = fixtures.llm_events(spark, sf_dir)
    n = F.right("event_id", F.lit(12)).cast("bigint")
    later = (events.where(n % 3 == 0).withColumn("latency_ms", F.col("latency_ms") + 1)
             .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")))
    twice = (events.where(n % 5 == 0)
             .withColumn("_more", F.explode(F.array(F.lit(2), F.lit(3))))
             .withColumn("latency_ms", F.col("latency_ms") + F.col("_more")).drop("_more"))
    _await(jobs.landing(spark, raw_json.json_lines_stream(spark, source), paths,
                        _replay_config(spark), available_now=True))
    for name, part in (("later", later), ("twice", twice)):
        jobs.compact_events(spark, paths, tables.partition_dates(spark, paths.events)[::2])
        again = f"{source}_{name}"
        replay.messages(part).write.text(again)
        backfill.run(spark, raw_json.json_lines(spark, again), paths)
    jobs.compact_events(spark, paths, tables.partition_dates(spark, paths.events))
    return source_tables.events(spark, paths.events)


@register("stored_events_redelivered_earlier", oracle.with_events(f"""SELECT * EXCLUDE (batch, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY batch DESC) AS rn FROM deliveries)
WHERE rn = 1 AND ts >= {_RANGE_SQL}""", oracle.AS_OF, """deliveries AS (
  SELECT *, 1 AS batch FROM llm_events
  UNION ALL SELECT * REPLACE (ts - INTERVAL 8 DAYS AS ts, latency_ms + 5 AS latency_ms), 2
  FROM llm_events WHERE CAST(right(event_id, 12) AS BIGINT) % 7 = 0
  UNION ALL SELECT * REPLACE (latency_ms + 9 AS latency_ms), 3
  FROM llm_events WHERE CAST(right(event_id, 12) AS BIGINT) % 21 = 0)"""), "K1 S7 T8")
def stored_events_redelivered_earlier(spark, sf_dir):
    """The last 24 hours of a stored table in which every seventh event was sent again with a
    time eight days earlier, and every third of those once more with its own: an event
    counts where its last delivery lies. Half of the dates are compacted before the read."""
    source, paths = _stream_source(spark, sf_dir)
    events = fixtures.llm_events(spark, sf_dir)
    n = F.right("event_id", F.lit(12)).cast("bigint")
    earlier = (events.where(n % 7 == 0).withColumn("latency_ms", F.col("latency_ms") + 5)
               .withColumn("ts", F.col("ts") - F.expr("INTERVAL 8 DAYS")))
    again = events.where(n % 21 == 0).withColumn("latency_ms", F.col("latency_ms") + 9)
    _await(jobs.landing(spark, raw_json.json_lines_stream(spark, source), paths,
                        _replay_config(spark), available_now=True))
    for number, (name, part) in enumerate((("earlier", earlier), ("again", again))):
        path = f"{source}_{name}"
        replay.messages(part).write.text(path)
        jobs.land_batch(spark, raw_json.json_lines(spark, path), tables.new_run() + number, paths)
    jobs.compact_events(spark, paths, tables.partition_dates(spark, paths.events)[::2])
    as_of, start = _as_of(spark, sf_dir)
    return source_tables.events(spark, paths.events, since=start)


@register("stream_minute_summaries", oracle.with_events("""SELECT date_trunc('minute', ts) AS time, model,
  count(*) AS events, CAST(sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) AS BIGINT) AS failures,
  CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
  CAST(sum(CASE WHEN status = 'success' THEN latency_ms ELSE 0 END) AS BIGINT) AS success_latency,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, CAST(sum(cost_usd) AS DECIMAL(28,6)) AS cost_usd
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY batch DESC) AS rn FROM deliveries)
WHERE rn = 1 GROUP BY ALL""", """deliveries AS (
  SELECT *, 1 AS batch FROM llm_events
  UNION ALL SELECT * REPLACE (ts + INTERVAL 3 HOURS AS ts, latency_ms + 5 AS latency_ms), 2
  FROM llm_events WHERE CAST(right(event_id, 12) AS BIGINT) % 4 = 0
  UNION ALL SELECT * REPLACE (ts + INTERVAL 1 DAY AS ts, 'error' AS status, 'server_error' AS error_code,
    CAST(0 AS DECIMAL(12,6)) AS cost_usd), 3
  FROM llm_events WHERE CAST(right(event_id, 12) AS BIGINT) % 6 = 0)"""), "R5-R9 K1 T8 A8")
def stream_minute_summaries(spark, sf_dir):
    """Per-minute summaries after every fourth event was re-sent three hours later and every
    sixth as a failure of the next day, equal to a recomputation from the last deliveries."""
    source, paths = _stream_source(spark, sf_dir)
    events = fixtures.llm_events(spark, sf_dir)
    n = F.right("event_id", F.lit(12)).cast("bigint")
    second = (events.where(n % 4 == 0).withColumn("latency_ms", F.col("latency_ms") + 5)
              .withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 HOURS")))
    third = (events.where(n % 6 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
             .withColumns({"status": F.lit("error"), "error_code": F.lit("server_error"),
                           "cost_usd": F.lit(0).cast(schemas.COST_TYPE)}))
    for part in (None, second, third):
        if part is not None:
            replay.messages(part).write.mode("append").text(source)
        _await(jobs.summary_job(spark, raw_json.json_lines_stream(spark, source), paths,
                                _replay_config(spark), available_now=True))
    summaries.compact(spark, paths.minute_summaries,
                      tables.partition_dates(spark, paths.minute_summaries)[::2])
    return summaries.minute_stats(spark, paths.minute_summaries)


@register("stream_late_rows", oracle.with_events(f"""SELECT event_id, ts AS event_time,
  {oracle.bucket(60)} + INTERVAL 60 MINUTES AS window_end, wm AS watermark, 'late:rollups' AS reason
FROM llm_events, wm WHERE CAST(right(event_id, 12) AS BIGINT) % 20 = 0
  AND {oracle.bucket(60)} + INTERVAL 60 MINUTES <= wm""", _WATERMARK_SQL), "T5 K7 T1")
def stream_late_rows(spark, sf_dir):
    """Dead letters of rows behind the watermark: all events in time order in three deliveries,
    then every twentieth once more; only those whose hour is closed are late."""
    config = _replay_config(spark, late_rows=True)

    def land(raw, paths):
        return jobs.landing(spark, raw, paths, config, available_now=True)

    paths = _delivered_in_order(spark, sf_dir, land)
    source = paths.events.rsplit("/", 1)[0] + "/source"
    events = fixtures.llm_events(spark, sf_dir)
    n = F.right("event_id", F.lit(12)).cast("bigint")
    replay.messages(events.where(n % 20 == 0)).write.mode("append").text(source)
    _await(land(raw_json.json_lines_stream(spark, source), paths))
    return source_tables.late_rows(spark, paths.late_rows).select(
        "event_id", "event_time", "window_end", "watermark", F.explode("reasons").alias("reason"))


def queries() -> dict[str, Plan]:
    return {name: q.plan for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
