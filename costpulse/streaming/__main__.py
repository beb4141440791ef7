"""Start the three streaming jobs and wait: ``python -m costpulse.streaming --help``.

The window lengths follow ``ROLLUP_WINDOW_MINUTES`` (default 60) and
``ANOMALY_WINDOW_MINUTES`` (default 5) unless given as options. All queries are started
before waiting on any of them, then the process blocks until one stops (and fails if one
failed), so a supervisor restarts the application, which resumes from the checkpoints.
"""

from __future__ import annotations

import argparse
import os

from costpulse import schemas
from costpulse.operators.baselines import BaselineConfig
from costpulse.session import get_spark
from costpulse.sources import raw_json
from costpulse.streaming import jobs


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m costpulse.streaming")
    p.add_argument("--base", required=True,
                   help="folder of the stored tables and checkpoints (shared storage)")
    p.add_argument("--source", choices=("kafka", "files"), default="kafka")
    p.add_argument("--bootstrap", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS"))
    p.add_argument("--topic", default=schemas.RAW_TOPIC)
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--min-partitions", type=int, default=None,
                   help="Spark partitions per micro-batch at least (default: Kafka's)")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None)
    p.add_argument("--path", help="folder of JSON-lines files (--source files)")
    p.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="bound a micro-batch of the file source")
    p.add_argument("--rollup-minutes", type=int,
                   default=int(os.environ.get("ROLLUP_WINDOW_MINUTES",
                                              schemas.ROLLUP_WINDOW_MINUTES)))
    p.add_argument("--anomaly-minutes", type=int,
                   default=int(os.environ.get("ANOMALY_WINDOW_MINUTES",
                                              schemas.ANOMALY_WINDOW_MINUTES)))
    p.add_argument("--landing-mode", choices=("append", "upsert"), default="append")
    p.add_argument("--rollup-mode", choices=("append", "upsert"), default="append")
    p.add_argument("--baselines", action="store_true",
                   help="also run the rolling-baseline detectors (N2-N4)")
    p.add_argument("--percentile", choices=("exact", "approx"), default="exact",
                   help="p95 from all latencies of a group, or from a sketch of fixed size")
    p.add_argument("--anomaly-topic",
                   help="also send the anomalies to this Kafka topic (needs --bootstrap)")
    p.add_argument("--anomaly-jdbc-url",
                   help="also append the anomalies to this database (its driver on the classpath)")
    p.add_argument("--anomaly-jdbc-table", default="anomaly_events")
    p.add_argument("--state-partitions", type=int, default=None)
    p.add_argument("--available-now", action="store_true",
                   help="process what is available, then stop (backfill / tests)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = get_spark("costpulse-streaming")
    if args.source == "kafka":
        if not args.bootstrap:
            raise SystemExit("--bootstrap or KAFKA_BOOTSTRAP_SERVERS is required for kafka")

        def source():
            return raw_json.kafka_stream(spark, args.bootstrap, args.topic, args.starting_offsets,
                                         args.min_partitions, args.max_offsets_per_trigger)
    else:
        if not args.path:
            raise SystemExit("--path is required for --source files")

        def source():
            return raw_json.json_lines_stream(spark, args.path, args.max_files_per_trigger)

    if args.anomaly_topic and not args.bootstrap:
        raise SystemExit("--anomaly-topic needs --bootstrap or KAFKA_BOOTSTRAP_SERVERS")
    config = jobs.StreamConfig(
        percentile=args.percentile,
        anomaly_json_sinks=(jobs.kafka_anomalies(args.bootstrap, args.anomaly_topic),)
        if args.anomaly_topic else (),
        anomaly_row_sinks=(jobs.jdbc_anomalies(args.anomaly_jdbc_url, args.anomaly_jdbc_table, {}),)
        if args.anomaly_jdbc_url else (),
        landing_mode=args.landing_mode, rollup_mode=args.rollup_mode,
        rollup_minutes=args.rollup_minutes, anomaly_minutes=args.anomaly_minutes,
        baselines=BaselineConfig() if args.baselines else None,
        state_partitions=args.state_partitions)
    queries = jobs.start_all(spark, source, jobs.Paths.under(args.base), config,
                             available_now=args.available_now)
    if args.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


if __name__ == "__main__":
    main()
