"""Batch backfill: the streaming jobs' work over a bounded set of raw messages.

Uses the same per-batch writers as the streaming jobs, so a replay of archived messages
lands, rolls up and scores events exactly like the live path. Batch results are complete:
every window is closed (there is no watermark to wait for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costpulse.operators import anomalies as an
from costpulse.operators import quality, rollups
from costpulse.sources import raw_json
from costpulse.sinks import tables
from costpulse.streaming import jobs


def run(spark: SparkSession, raw: DataFrame, paths: jobs.Paths,
        config: jobs.StreamConfig | None = None, batch_id: int | None = None) -> None:
    """Land ``raw`` messages, then rebuild rollups and anomalies from the same messages.

    The run has batch numbers of its own (``tables.new_run``), so it adds to what live streams
    have stored and never replaces it; ``batch_id`` repeats an earlier run in its place.

    Each output decodes the messages in its own pass, so nothing but the outputs is stored:
    holding the decoded rows (with their raw text) would take several times the input.
    """
    config = config or jobs.StreamConfig()
    batch_id = tables.new_run() if batch_id is None else batch_id
    decoded = raw_json.decode(raw)
    jobs.land_assessed(spark, quality.assess(decoded, spark), batch_id, paths, config.landing_mode,
                       keep=False)
    # The aggregates count the same rows as the streaming jobs (see jobs.aggregatable).
    jobs.store_rollups(spark, rollups.cost_rollups(jobs.countable(decoded, jobs.ROLLUP_KEYS),
                                                   config.rollup_minutes, config.percentile),
                       paths, batch_id, config.rollup_mode)
    stats = an.window_stats(jobs.countable(decoded, jobs.STATS_KEYS), config.anomaly_minutes,
                            with_p95=config.baselines is not None, percentile=config.percentile)
    jobs.store_anomalies(spark, stats, batch_id, paths, config,
                         detected_at=an.event_time_detection())


def main(argv=None) -> None:
    """``python -m costpulse.plans.backfill --base <tables> --path <json lines>``"""
    import argparse

    from costpulse.session import get_spark

    p = argparse.ArgumentParser(prog="python -m costpulse.plans.backfill")
    p.add_argument("--base", required=True, help="folder of the stored tables (shared)")
    p.add_argument("--path", required=True, help="JSON-lines messages to replay")
    p.add_argument("--batch-id", type=int, default=None,
                   help="number of an earlier run to overwrite (default: a new run's)")
    p.add_argument("--compact", action="store_true",
                   help="afterwards, compact the dates present in the event table")
    args = p.parse_args(argv)
    spark = get_spark("costpulse-backfill")
    paths = jobs.Paths.under(args.base)
    run(spark, raw_json.json_lines(spark, args.path), paths, batch_id=args.batch_id)
    if args.compact:
        from costpulse.sinks.tables import partition_dates
        jobs.compact_events(spark, paths, partition_dates(spark, paths.events))
        jobs.compact_rollups(spark, paths, partition_dates(spark, paths.rollups))


if __name__ == "__main__":
    main()
