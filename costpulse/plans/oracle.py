"""DuckDB texts that compute the same results as the Spark plans (the correctness gate).

They run on the same Parquet tables with views ``events`` etc. pre-registered. Shared CTEs
are composed here so each query text is complete and standalone.
"""

from __future__ import annotations

from costpulse import schemas
from costpulse.functions import pricing

_CAT_VALUES = ",\n  ".join(
    f"('{m}','{p}',{i},{o},{b},{lo},{hi})" for m, p, i, o, b, lo, hi in pricing.catalogue_rows())

# llm_events derived from events (same rules as sources/fixtures.adapt).
LLM_EVENTS = f"""
cat(model, provider, in_micro, out_micro, base_ms, lo, hi) AS (VALUES
  {_CAT_VALUES}),
b AS (SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type,
             CAST(round(value * 100) AS BIGINT) AS cents,
             TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
t AS (SELECT *,
        least(32000, greatest(10, cents * 2)) AS prompt_tokens,
        least(4096, greatest(5, cents // 10)) AS completion_tokens,
        CASE WHEN event_type = 'error' AND k < 15 THEN 'error'
             WHEN event_type = 'error' AND k < 30 THEN 'timeout'
             ELSE 'success' END AS status FROM b),
llm_events AS (
SELECT concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS event_id,
  ts, model, provider,
  concat('user_', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS user_id,
  concat('s-', CAST(user_id AS VARCHAR), '-', CAST(event_id % 4 AS VARCHAR)) AS session_id,
  CAST(prompt_tokens AS INT) AS prompt_tokens,
  CAST(completion_tokens AS INT) AS completion_tokens,
  CAST(prompt_tokens + completion_tokens AS INT) AS total_tokens,
  CAST(CASE WHEN status = 'success'
       THEN CAST((prompt_tokens * in_micro + completion_tokens * out_micro + 500) // 1000 AS DECIMAL(12,0))
            * CAST(0.000001 AS DECIMAL(7,6))
       ELSE 0 END AS DECIMAL(12,6)) AS cost_usd,
  CAST(greatest(50, (base_ms + completion_tokens * 5 // 2)
       * CASE WHEN status = 'timeout' THEN 3 ELSE 1 END) AS INT) AS latency_ms,
  status,
  CASE WHEN status = 'timeout' THEN 'request_timeout'
       WHEN status = 'error' THEN CASE k % 4 WHEN 0 THEN 'rate_limit_exceeded'
            WHEN 1 THEN 'invalid_request_error' WHEN 2 THEN 'context_length_exceeded'
            ELSE 'server_error' END END AS error_code,
  concat('00000000-0000-4000-9000-', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS request_id
FROM t JOIN cat ON (event_id * 37) % 100 >= lo AND (event_id * 37) % 100 < hi)"""

AS_OF = "as_of AS (SELECT max(ts) AS as_of FROM llm_events)"


def dec(expr: str, precision: int, scale: int) -> str:
    """A DOUBLE stored at DECIMAL(p,s) the way the store does it: its shortest decimal
    form, rounded half away from zero (so 2263.325 -> 2263.33, not the binary 2263.32)."""
    return (f"CAST(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)) "
            f"AS DECIMAL({precision},{scale}))")


def with_events(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {LLM_EVENTS.strip()}{extra}\n{body.strip()}\n"


def bucket(minutes: int, col: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{int(minutes)} minutes', {col}, TIMESTAMP '1970-01-01')"


def rollup_cte(minutes: int, name: str = "rollups") -> str:
    return f"""{name} AS (
SELECT {bucket(minutes)} AS window_start,
  {bucket(minutes)} + INTERVAL '{int(minutes)} minutes' AS window_end,
  model, provider, user_id,
  CAST(count(*) AS BIGINT) AS total_requests,
  CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
  CAST(sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  CAST(sum(CAST(total_tokens AS BIGINT)) AS BIGINT) AS total_tokens,
  CAST(sum(cost_usd) AS DECIMAL(28,4)) AS total_cost_usd,
  {dec("avg(CAST(latency_ms AS DOUBLE))", 12, 2)} AS avg_latency_ms,
  {dec("quantile_cont(latency_ms, 0.95)", 12, 2)} AS p95_latency_ms
FROM llm_events GROUP BY ALL)"""


def stats_cte(minutes: int, name: str = "stats", with_p95: bool = False) -> str:
    p95 = ",\n  quantile_cont(latency_ms, 0.95) AS p95_latency_ms" if with_p95 else ""
    return f"""{name} AS (
SELECT {bucket(minutes)} AS window_start,
  {bucket(minutes)} + INTERVAL '{int(minutes)} minutes' AS window_end,
  model,
  CAST(count(*) AS BIGINT) AS total_requests,
  avg(CAST(latency_ms AS DOUBLE)) AS avg_latency_ms,
  CAST(sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS error_rate,
  sum(cost_usd) AS total_cost_usd{p95}
FROM llm_events GROUP BY ALL)"""


_WARN = (schemas.LATENCY_LINES_MS[0], schemas.ERROR_RATE_LINES[0], schemas.COST_LINES_USD[0])
_CRIT = (schemas.LATENCY_LINES_MS[1], schemas.ERROR_RATE_LINES[1], schemas.COST_LINES_USD[1])


def anomalies_cte(minutes: int, name: str = "anomalies", warn=_WARN, crit=_CRIT) -> str:
    arms = []
    for typ, metric, w, c in (("latency_spike", "avg_latency_ms", warn[0], crit[0]),
                              ("error_surge", "error_rate", warn[1], crit[1]),
                              ("cost_spike", "CAST(total_cost_usd AS DOUBLE)", warn[2], crit[2])):
        arms.append(f"""SELECT window_end + INTERVAL 10 SECONDS AS detected_at,
  '{typ}' AS anomaly_type, model, CAST(NULL AS VARCHAR) AS user_id,
  {dec(metric, 38, 4)} AS metric_value,
  CAST(CASE WHEN {metric} >= {c} THEN {c} ELSE {w} END AS DECIMAL(38,4)) AS threshold_value,
  CASE WHEN {metric} >= {c} THEN 'critical' ELSE 'warning' END AS severity,
  window_start, window_end
FROM anomaly_stats_{minutes} WHERE {metric} >= {w}""")
    union = "\nUNION ALL\n".join(arms)
    return f"{stats_cte(minutes, f'anomaly_stats_{minutes}')},\n{name} AS (\n{union})"


def _frame(lookback: int, keys: str = "model") -> str:
    return (f"(PARTITION BY {keys} ORDER BY window_start "
            f"ROWS BETWEEN {int(lookback)} PRECEDING AND 1 PRECEDING)")


def _half_up_div_1e4(sum_col: str, scale: int, factor: int, n_col: str) -> str:
    """factor * sum / n rounded half up to 4 decimals, in exact integer arithmetic."""
    units = f"CAST({sum_col} * {10 ** scale} AS HUGEINT)"
    num = f"{factor} * {units}" + (f" * {10 ** (4 - scale)}" if scale <= 4 else "")
    den = n_col if scale <= 4 else f"{n_col} * {10 ** (scale - 4)}"
    return (f"CAST(CAST((2 * {num} + {den}) // (2 * {den}) AS DECIMAL(38,0)) * 0.0001 "
            f"AS DECIMAL(38,4))")


def ratio_baseline_sql(metric_sql: str, scale: int, anomaly_type: str, warning: int,
                       critical: int | None, lookback: int = schemas.BASELINE_WINDOWS) -> str:
    crit = (f"metric * base_n > {critical} * base_sum" if critical is not None else "FALSE")
    return f"""src AS (SELECT window_start, window_end, model, {metric_sql} AS metric FROM stats),
based AS (SELECT *, sum(metric) OVER w AS base_sum, count(metric) OVER w AS base_n
  FROM src WINDOW w AS {_frame(lookback)}),
flagged AS (SELECT *, {crit} AS is_critical FROM based
  WHERE base_n > 0 AND metric * base_n > {warning} * base_sum)
SELECT window_end + INTERVAL 10 SECONDS AS detected_at, '{anomaly_type}' AS anomaly_type, model,
  CAST(NULL AS VARCHAR) AS user_id,
  CAST(metric AS DECIMAL(38,4)) AS metric_value,
  CASE WHEN is_critical THEN {_half_up_div_1e4("base_sum", scale, critical or warning, "base_n")}
       ELSE {_half_up_div_1e4("base_sum", scale, warning, "base_n")} END AS threshold_value,
  CASE WHEN is_critical THEN 'critical' ELSE 'warning' END AS severity,
  window_start, window_end
FROM flagged"""


def zscore_sql(lookback: int = schemas.BASELINE_WINDOWS, z: float = schemas.Z_SCORE_LINE) -> str:
    return f"""long AS (
  SELECT window_start, window_end, model, 'avg_latency_ms' AS metric, avg_latency_ms AS value
  FROM stats
  UNION ALL
  SELECT window_start, window_end, model, 'error_rate' AS metric, error_rate AS value FROM stats),
scored AS (SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS stddev
  FROM long WINDOW w AS {_frame(lookback, "model, metric")}),
z AS (SELECT *, (value - mean) / nullif(stddev, 0) AS z FROM scored)
SELECT window_start, window_end, model, metric,
  {dec("value", 38, 4)} AS value, {dec("mean", 38, 4)} AS mean,
  {dec("stddev", 38, 4)} AS stddev, {dec("z", 38, 4)} AS z
FROM z WHERE abs(z) > {z}"""
