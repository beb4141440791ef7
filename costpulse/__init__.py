"""costpulse: Spark-native cost, usage and anomaly analytics for LLM API call events.

Every transformation is a function from DataFrame to DataFrame with no reader or writer
inside, so the batch path (checked against DuckDB) and the Structured Streaming path share
the same code. Readers live in :mod:`costpulse.sources`, writers in :mod:`costpulse.sinks`,
streaming wiring in :mod:`costpulse.streaming` and the named query plans in
:mod:`costpulse.plans`.

Typical use::

    from costpulse import get_spark, jobs, Paths
    spark = get_spark()
    jobs.start_all(spark, lambda: kafka_stream(spark, servers, "llm.events.raw"),
                   Paths.under("s3a://bucket/costpulse"))
    spark.streams.awaitAnyTermination()

    from costpulse import dashboard
    frames = dashboard.refresh(spark, Paths.under("s3a://bucket/costpulse"), "1 hour")
"""

from costpulse.operators.anomalies import Thresholds, anomalies, detect, window_stats
from costpulse.operators.baselines import (BaselineConfig, cost_baseline, latency_baseline,
                                           zscores)
from costpulse.operators.quality import assess, good, quarantined, reason_counts
from costpulse.operators.rollups import cost_rollups
from costpulse.plans import backfill, dashboard
from costpulse.session import get_spark, prepare
from costpulse.sources.raw_json import decode, encode, json_lines_stream, kafka_stream
from costpulse.streaming import jobs
from costpulse.streaming.jobs import Paths, StreamConfig

__version__ = "0.1.0"

__all__ = [
    "BaselineConfig", "Paths", "StreamConfig", "Thresholds", "anomalies", "assess", "backfill",
    "cost_baseline", "cost_rollups", "dashboard", "decode", "detect", "encode", "get_spark",
    "good", "jobs", "json_lines_stream", "kafka_stream", "latency_baseline", "prepare",
    "quarantined", "reason_counts", "window_stats", "zscores",
]
