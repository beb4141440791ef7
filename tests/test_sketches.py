"""Latency sketches in stored rollups: exactness of small groups, rank error of large ones,
bounded size, streaming parity, tables with older rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from costpulse.operators import rollups
from costpulse.sources import fixtures, raw_json, replay, tables
from costpulse.streaming import jobs
from tests.conftest import SF_MEDIUM, SF_SMALL


def _ranks(spark, values_sql, parts, n):
    """(estimate, share of values below it, share at or below it) of a merged sketch."""
    df = spark.range(n).select((F.expr(values_sql)).cast("int").alias("v"), (F.col("id") % parts).alias("p"))
    sketches = df.groupBy("p").agg(rollups.latency_sketch(F.col("v")).alias("s"))
    merged = sketches.agg(F.kll_merge_agg_bigint("s").alias("s"))
    row = merged.select(rollups.sketch_quantile(F.col("s")).alias("q"), F.length("s").alias("bytes")).first()
    share = df.agg(F.avg((F.col("v") < row["q"]).cast("double")),
                   F.avg((F.col("v") <= row["q"]).cast("double"))).first()
    return row["q"], share[0], share[1], row["bytes"]


def test_rank_error_and_size_do_not_grow(spark):
    for n in (20_000, 400_000):
        for sql in ("(id * 7919) % 100003", "id", "pow((id % 1000) / 100, 4)"):
            _, below, upto, size = _ranks(spark, sql, 24, n)
            assert below - rollups.SKETCH_RANK_ERROR <= 0.95 <= upto + rollups.SKETCH_RANK_ERROR
            assert size < 8 * 4 * rollups.SKETCH_K


def test_small_groups_are_exact_and_nulls_left_out(spark):
    rows = [("a", v) for v in range(1, rollups.SKETCH_K + 1)] + [("b", None), ("b", 7), ("c", None)]
    got = {r["k"]: r["q"] for r in spark.createDataFrame(rows, "k string, v int").groupBy("k").agg(
        rollups.latency_sketch(F.col("v")).alias("s")).select(
        "k", rollups.sketch_quantile(F.col("s")).alias("q")).collect()}
    assert got == {"a": 760, "b": 7, "c": None}


def _by_model(spark, stored, events):
    got = {(r["window_start"], r["model"]): r["p95_latency_ms"]
           for r in rollups.merged_rollups(stored, 1440).collect()}
    want = {(r["s"], r["model"]): r["q"] for r in events.groupBy(
        F.window("ts", "1 day").start.alias("s"), "model").agg(
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms)").cast("bigint").alias("q"))
        .collect()}
    return got, want


def test_streamed_sketches_merge_to_the_daily_p95(spark, tmp_dir):
    """Every window that the watermark closes is stored once with its sketch; merged days equal
    the exact quantile (their groups are small). Compaction keeps the sketches."""
    events = fixtures.llm_events(spark, SF_SMALL)
    replay.messages(events).write.text(f"{tmp_dir}/src")
    paths = jobs.Paths.under(tmp_dir)
    q = jobs.rollup_job(spark, raw_json.json_lines_stream(spark, f"{tmp_dir}/src"), paths,
                        jobs.StreamConfig(percentile="sketch", state_partitions=4), True)
    q.awaitTermination()
    assert q.exception() is None
    last = events.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).first()[0]
    for _ in range(2):
        got, want = _by_model(spark, tables.rollups(spark, paths.rollups, sketches=True), events)
        assert {k: v for k, v in got.items() if k[0] < last} == \
            {k: v for k, v in want.items() if k[0] < last}
        from costpulse.sinks.tables import partition_dates
        jobs.compact_rollups(spark, paths, partition_dates(spark, paths.rollups))


def test_rows_stored_without_sketches_still_count(spark, tmp_dir):
    events = fixtures.llm_events(spark, SF_SMALL)
    paths = jobs.Paths.under(tmp_dir)
    half = F.col("model") == "gpt-4o"
    jobs.store_rollups(spark, rollups.cost_rollups(events.where(half), 60), paths, 1)
    jobs.store_rollups(spark, rollups.cost_rollups(events.where(~half), 60, "sketch"), paths, 2)
    merged = {r["model"]: r for r in rollups.merged_rollups(
        tables.rollups(spark, paths.rollups, sketches=True), None).collect()}
    assert merged["gpt-4o"]["p95_latency_ms"] is None and merged["gpt-4o"]["total_requests"] > 0
    assert merged["gemini-1.5-pro"]["p95_latency_ms"] > 0
    assert "latency_sketch" not in tables.rollups(spark, paths.rollups).columns
    assert tables.rollups(spark, f"{tmp_dir}/none", sketches=True).count() == 0


def test_merge_reads_no_events(spark, tmp_dir):
    events = fixtures.llm_events(spark, SF_MEDIUM)
    jobs.store_rollups(spark, rollups.cost_rollups(events, 60, "sketch"), jobs.Paths.under(tmp_dir), 1)
    merged = rollups.merged_rollups(
        tables.rollups(spark, jobs.Paths.under(tmp_dir).rollups, sketches=True, latest=False), 1440)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "partial_kll_merge_agg_bigint" in plan and plan.count("FileScan") == 1
    assert "user_id" not in schema and "avg_latency_ms" not in schema
