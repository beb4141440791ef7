"""Declared schemas, domains and the fixed reference values of the data model.

One source of truth: the raw JSON event, the landed event table, the rollup table and the
anomaly table. Jobs select the columns they need and Catalyst prunes the rest (also inside
``from_json``), so there is no per-job narrower copy of the schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Fixed values (must equal the upstream event producer and table definitions).
# --------------------------------------------------------------------------------------

# Event status domain and the status counted as success.
STATUSES = ("success", "error", "timeout")
SUCCESS = "success"

# Error codes of failed calls; a timeout always carries TIMEOUT_CODE.
ERROR_CODES = (
    "rate_limit_exceeded",
    "invalid_request_error",
    "context_length_exceeded",
    "server_error",
)
TIMEOUT_CODE = "request_timeout"

# Token bounds of a call and the latency floor in milliseconds.
PROMPT_TOKENS_MIN, PROMPT_TOKENS_MAX = 10, 32000
COMPLETION_TOKENS_MIN, COMPLETION_TOKENS_MAX = 5, 4096
LATENCY_MS_MIN = 50

# Maximum column lengths of the stored event table.
MAX_LENGTHS = {
    "model": 100,
    "provider": 50,
    "user_id": 100,
    "session_id": 100,
    "status": 20,
    "error_code": 100,
}

# Anomaly type and severity domains.
ANOMALY_TYPES = ("latency_spike", "error_surge", "cost_spike")
SEVERITIES = ("warning", "critical")

# Wire format of the event timestamp; only the first 26 characters are parsed, the UTC
# offset suffix is ignored (the producer always writes +00:00).
EVENT_TIME_PREFIX_LEN = 26
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EVENT_TIME_WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"

# Watermark delay of every streaming job.
WATERMARK_DELAY = "10 seconds"

# Default tumbling window lengths (minutes) of the rollup and anomaly jobs, and the topic.
ROLLUP_WINDOW_MINUTES = 60
ANOMALY_WINDOW_MINUTES = 5
RAW_TOPIC = "llm.events.raw"

# Model catalogue: model, provider, USD per 1k input tokens, USD per 1k output tokens,
# base latency in ms, traffic weight.
MODELS = (
    ("gpt-4o", "openai", "0.0025", "0.01000", 800, "0.28"),
    ("gpt-4o-mini", "openai", "0.000150", "0.000600", 350, "0.25"),
    ("gpt-3.5-turbo", "openai", "0.000500", "0.001500", 280, "0.15"),
    ("claude-3-5-sonnet-20241022", "anthropic", "0.003", "0.015", 950, "0.17"),
    ("claude-3-haiku-20240307", "anthropic", "0.000250", "0.001250", 320, "0.10"),
    ("gemini-1.5-pro", "google", "0.00125", "0.005", 600, "0.05"),
)

# Detector lines (a window is flagged when its metric is >= the line): warning, critical.
LATENCY_LINES_MS = (3000.0, 6000.0)
ERROR_RATE_LINES = (0.15, 0.40)
COST_LINES_USD = (1.0, 5.0)

# Rolling-baseline rules: previous windows in the baseline; p95 above 3x / 6x the baseline
# p95 is a warning / critical; cost above 2x the rolling average is a warning; |z| > 3.
BASELINE_WINDOWS = 12
LATENCY_BASELINE_RATIOS = (3, 6)
COST_BASELINE_RATIO = 2
Z_SCORE_LINE = 3.0

# Report ranges offered to users, and the default.
REPORT_RANGES = ("15 minutes", "30 minutes", "1 hour", "3 hours", "6 hours", "24 hours")
DEFAULT_REPORT_RANGE = "1 hour"

# --------------------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------------------

# Raw event as it arrives on the wire. Numeric fields are decoded as STRING and then
# try-cast, so "12" is accepted as 12 while 12.7 or "x" become a quality failure instead of
# silently nulling the whole record.
RAW_EVENT_WIRE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("prompt_tokens", T.StringType()),
    T.StructField("completion_tokens", T.StringType()),
    T.StructField("total_tokens", T.StringType()),
    T.StructField("cost_usd", T.StringType()),
    T.StructField("latency_ms", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_code", T.StringType()),
    T.StructField("request_id", T.StringType()),
])

INT_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens", "latency_ms")

# Landed event table (one row per event_id).
LLM_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("prompt_tokens", T.IntegerType(), False),
    T.StructField("completion_tokens", T.IntegerType(), False),
    T.StructField("total_tokens", T.IntegerType(), False),
    T.StructField("cost_usd", T.DecimalType(12, 6), False),
    T.StructField("latency_ms", T.IntegerType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_code", T.StringType(), True),
    T.StructField("request_id", T.StringType(), False),
])

# Rollup table, key (window_start, model, user_id).
COST_ROLLUPS = T.StructType([
    T.StructField("window_start", T.TimestampNTZType(), False),
    T.StructField("window_end", T.TimestampNTZType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("total_requests", T.LongType(), False),
    T.StructField("success_count", T.LongType(), False),
    T.StructField("error_count", T.LongType(), False),
    T.StructField("total_tokens", T.LongType(), False),
    T.StructField("total_cost_usd", T.DecimalType(28, 4), False),
    T.StructField("avg_latency_ms", T.DecimalType(12, 2), True),
    T.StructField("p95_latency_ms", T.DecimalType(12, 2), True),
])
ROLLUP_KEY = ("window_start", "model", "user_id")

# Anomaly table, append only (no key).
ANOMALY_EVENTS = T.StructType([
    T.StructField("detected_at", T.TimestampNTZType(), False),
    T.StructField("anomaly_type", T.StringType(), False),
    T.StructField("model", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("metric_value", T.DecimalType(38, 4), False),
    T.StructField("threshold_value", T.DecimalType(38, 4), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("window_start", T.TimestampNTZType(), False),
    T.StructField("window_end", T.TimestampNTZType(), False),
])

# Dead letters of the landing job.
QUARANTINE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reasons", T.ArrayType(T.StringType())),
    T.StructField("source", T.StringType()),
    T.StructField("arrival_key", T.StringType()),
    T.StructField("arrival_time", T.TimestampNTZType()),
])

# Decimal types of the stored measures. The aggregation jobs read costs from the wire wider
# than the event table stores them; sums and metrics have room for any number of such calls,
# so no window, however large its cost or z-score, can fail a batch.
WIRE_COST_TYPE = T.DecimalType(18, 6)
COST_TYPE = T.DecimalType(12, 6)
ROLLUP_COST_TYPE = T.DecimalType(28, 4)
LATENCY_TYPE = T.DecimalType(12, 2)
METRIC_TYPE = T.DecimalType(38, 4)
