"""The two entry points, run in-process on the test session."""

from __future__ import annotations

from costpulse.plans import backfill
from costpulse.sources import fixtures, replay, tables
from costpulse.streaming import __main__ as streaming_main
from costpulse.streaming import jobs
from tests.conftest import SF_SMALL


def test_streaming_cli_available_now(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    replay.messages(fixtures.llm_events(spark, SF_SMALL)).write.text(src)
    streaming_main.main(["--base", f"{tmp_dir}/t", "--source", "files", "--path", src,
                         "--available-now", "--state-partitions", "4",
                         "--max-files-per-trigger", "2",
                         "--rollup-minutes", "1440", "--anomaly-minutes", "60"])
    paths = jobs.Paths.under(f"{tmp_dir}/t")
    assert tables.events(spark, paths.events).count() == 1000
    assert tables.rollups(spark, paths.rollups).count() > 0
    assert tables.anomalies(spark, paths.anomalies).count() > 0


def test_backfill_cli_with_compaction(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    replay.messages(fixtures.llm_events(spark, SF_SMALL)).write.text(src)
    backfill.main(["--base", f"{tmp_dir}/t", "--path", src, "--compact"])
    paths = jobs.Paths.under(f"{tmp_dir}/t")
    from costpulse.sinks.tables import compacted_dates, partition_dates
    assert compacted_dates(spark, paths.events) == partition_dates(spark, paths.events)
    assert spark.read.parquet(paths.events).count() == 1000
    assert tables.rollups(spark, paths.rollups).count() == 996
