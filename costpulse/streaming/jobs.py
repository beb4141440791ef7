"""The three streaming jobs, built from the same operators as the batch path.

Each job reads the raw message stream itself (its own checkpoint = its own consumer
position) and decodes it once. Landing keeps the rows the store accepts; the aggregation
jobs count every decodable message with an event time and its group keys. All write through
``foreachBatch`` with a replay-safe sink:

* ``landing``   - keyed upsert of events on ``event_id`` + quarantine append (K1, K7, T7)
* ``rollups``   - watermark, tumbling window aggregate, upsert on (window_start, model,
                  user_id) (A1, T1-T6, K2)
* ``anomalies`` - watermark, per-model window statistics, the three detectors, append to
                  the anomaly table and a JSON copy from one computation (A2, U1, K3-K5);
                  optionally the rolling-baseline detectors against the stored history.

Late rows (event time behind the watermark) are dropped by Spark and counted in
``numRowsDroppedByWatermark`` (``dropped_late_rows``). Rows without a parseable event time
never reach the watermark: they go to the quarantine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from costpulse import schemas
from costpulse.operators import anomalies as an
from costpulse.operators import baselines, quality, rollups
from costpulse.sinks import jdbc, tables
from costpulse.sources import raw_json
from costpulse.sources import tables as source_tables
from costpulse.streaming import lateness, stateful, summaries


STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Triggers:
    """Micro-batch cadence per job (the upstream sink flush intervals)."""
    landing: str = "2 seconds"
    rollups: str = "10 seconds"
    anomalies: str = "5 seconds"


@dataclass(frozen=True)
class Paths:
    events: str
    quarantine: str
    rollups: str
    anomalies: str
    anomalies_json: str
    window_stats: str
    window_levels: str
    minute_summaries: str
    late_rows: str
    checkpoints: str

    @classmethod
    def under(cls, base: str) -> "Paths":
        base = base.rstrip("/")
        return cls(events=f"{base}/llm_events", quarantine=f"{base}/quarantine",
                   rollups=f"{base}/cost_rollups", anomalies=f"{base}/anomaly_events",
                   anomalies_json=f"{base}/anomalies_json", window_stats=f"{base}/window_stats",
                   window_levels=f"{base}/window_levels",
                   minute_summaries=f"{base}/minute_summaries",
                   late_rows=f"{base}/late_rows", checkpoints=f"{base}/_checkpoints")


@dataclass
class StreamConfig:
    # "append": merge-on-read landing (per-batch idempotent append; readers keep the latest
    # row per event_id; ``compact_events`` rewrites closed dates). Cost per micro-batch is
    # the batch itself, whatever the table size. "upsert": copy-on-write of the touched date
    # partitions; exact table at rest, cost grows with the size of a date partition.
    landing_mode: str = "append"
    # Keep rows that come after their rollup window was closed as dead letters (they land, too).
    late_rows: bool = False
    # Same choice for rollups (key window_start, model, user_id). Append mode never deletes
    # stored files, so a crash at any point leaves the table readable and a replay of the
    # micro-batch rewrites only that batch's own partition.
    rollup_mode: str = "append"
    rollup_minutes: int = schemas.ROLLUP_WINDOW_MINUTES
    anomaly_minutes: int = schemas.ANOMALY_WINDOW_MINUTES
    watermark: str = schemas.WATERMARK_DELAY
    thresholds: an.Thresholds = an.DEFAULT_THRESHOLDS
    baselines: baselines.BaselineConfig | None = None
    percentile: str = "exact"
    triggers: Triggers = field(default_factory=Triggers)
    # Shuffle partitions of the stateful aggregates (= state store partitions). Fixed by
    # the checkpoint for the life of a query, so it is chosen here, at first start, from the
    # expected state size (None: the session's spark.sql.shuffle.partitions).
    state_partitions: int | None = None
    # State store of the stateful aggregates, also fixed at first start. RocksDB keeps
    # large keyed window state off the JVM heap and checkpoints it incrementally.
    state_store: str | None = ROCKSDB_PROVIDER
    # Further sinks of the anomalies, each called once per micro-batch with the JSON messages
    # (key, value) or the rows, e.g. ``kafka_anomalies`` or ``jdbc_anomalies``.
    anomaly_json_sinks: tuple[Callable[[DataFrame], None], ...] = ()
    anomaly_row_sinks: tuple[Callable[[DataFrame], None], ...] = ()


def _start(spark: SparkSession, writer, every: str | None, available_now: bool,
           config: StreamConfig) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    settings = {}
    if config.state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(int(config.state_partitions))
    if config.state_store is not None:
        settings[STATE_STORE_CONF] = config.state_store
    # The query clones the session configuration when it starts; restore ours afterwards.
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def accepted(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Decoded, assessed rows the store accepts, with ``ts`` as TIMESTAMP for watermarks
    (event time is a UTC wall clock; the session zone is UTC)."""
    good = quality.good(quality.assess(raw_json.decode(raw), spark))
    return good.withColumn("ts", F.col("ts").cast("timestamp"))


def aggregatable(raw: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows the aggregation jobs count: a decodable message with an event time and its
    group keys present. Other fields may be NULL and aggregate as NULL (a NULL status is
    counted in total_requests only, a NULL latency is left out of the average), as the
    aggregation jobs read the raw stream, not the landed table. Rows without event time
    never reach the watermark; the landing job quarantines them."""
    return countable(raw_json.decode(raw), keys).withColumn("ts", F.col("ts").cast("timestamp"))


def countable(decoded: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``aggregatable`` over already decoded rows, in the landed shape (``ts`` NTZ)."""
    ok = ~F.col("_null_message") & F.col(raw_json.CORRUPT).isNull() \
        & F.col("event_time").isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return raw_json.landed(decoded.where(ok))


ROLLUP_KEYS = ("model", "provider", "user_id")
STATS_KEYS = ("model",)


def _to_ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


ARRIVAL_COLUMNS = ("source", "arrival_key", "arrival_time")
EVENT_INDEX = source_tables.EVENT_INDEX


# ---------------------------------------------------------------------------- batch writers
# What one micro-batch does; also used as-is by the batch backfill (plans.backfill).

def land_batch(spark: SparkSession, raw: DataFrame, batch_id: int, paths: Paths,
               mode: str = "append", late: lateness.Windows | None = None) -> None:
    """Decode + assess once; land accepted rows, append the quarantine (K1, K5, K7) and, with
    ``late``, the rows whose window is closed already (T5)."""
    if "arrival_key" in raw.columns:
        raw = raw_json.numbered(raw)
    land_assessed(spark, quality.assess(raw_json.decode(raw), spark), batch_id, paths, mode, late=late)


def land_assessed(spark: SparkSession, assessed: DataFrame, batch_id: int, paths: Paths,
                  mode: str = "append", keep: bool = True,
                  late: lateness.Windows | None = None) -> None:
    """``keep`` holds the assessed rows for both sinks, as a micro-batch should; a backfill of
    any size decodes them again instead."""
    if mode not in ("append", "upsert"):
        raise ValueError(f"landing mode {mode!r}")

    def land(df: DataFrame) -> None:
        good = tables.with_date(quality.good(df), "ts")
        if mode == "append":
            rows = good.drop(*[c for c in ("source", "arrival_time") if c in good.columns])
            if "arrival_key" not in rows.columns:
                rows = rows.withColumn("arrival_key", F.lit(None).cast("string"))
            tables.append_batch(rows, batch_id, paths.events, ["dt"], sort_cols=["model", "ts"],
                                index=EVENT_INDEX)
        else:
            tables.upsert(spark, good, paths.events, key=["event_id"], order=["arrival_key"],
                          partition_cols=["dt"], sort_cols=["model", "ts"],
                          drop=[c for c in ARRIVAL_COLUMNS if c in good.columns])

    def quarantine(df: DataFrame) -> None:
        bad = quality.quarantined(df).withColumn(
            "dt", F.coalesce(F.to_date("arrival_time"), F.current_date()))
        tables.append_batch(bad, batch_id, paths.quarantine, ["dt"])

    def closed(df: DataFrame) -> None:
        lateness.keep(spark, df, batch_id, paths.late_rows, late)

    tables.write_all(assessed, [land, quarantine, *([closed] if late else [])], keep)


def store_rollups(spark: SparkSession, rows: DataFrame, paths: Paths, batch_id: int = 0,
                  mode: str = "append") -> None:
    """K2: rollup rows keyed on (window_start, model, user_id): appended per batch (readers
    keep the last batch per key) or upserted in place."""
    rows = tables.with_date(_to_ntz(rows, "window_start", "window_end"), "window_start")
    if mode == "append":
        tables.append_batch(rows, batch_id, paths.rollups, ["dt"],
                            sort_cols=["model", "window_start"])
    elif mode == "upsert":
        tables.upsert(spark, rows, paths.rollups, key=list(schemas.ROLLUP_KEY), order=[],
                      partition_cols=["dt"], sort_cols=["model", "window_start"])
    else:
        raise ValueError(f"rollup mode {mode!r}")


def store_anomalies(spark: SparkSession, stats: DataFrame, batch_id: int, paths: Paths,
                    config: StreamConfig, detected_at=None) -> None:
    """K3-K5: detectors over closed-window statistics; the anomaly table (by detection
    date and batch) and the JSON copy are written from one persisted result. The batch's
    statistics are computed once for all detectors (a micro-batch is never re-executed)."""
    stats = _to_ntz(stats, "window_start", "window_end").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        detected = detected_at if detected_at is not None else an.processing_time_detection()
        found = an.detect(stats, config.thresholds, detected)
        if config.baselines is not None:
            found = found.unionByName(_baseline_rows(stats, config, detected))
            # the statistics themselves, for reports over stored windows
            tables.append_batch(tables.with_date(stats.drop(*stateful.HISTORY), "window_start"),
                                batch_id, paths.window_stats, ["dt"])
        found = found.withColumn("dt", F.to_date("detected_at"))
        tables.write_all(found, [
            lambda df: tables.append_batch(df, batch_id, paths.anomalies, ["dt"]),
            lambda df: tables.append_batch(raw_json.encode_anomalies(df, "dt"), batch_id,
                                           paths.anomalies_json, ["dt"]),
            *[lambda df, put=put: put(raw_json.encode_anomalies(df, "dt").drop("dt"))
              for put in config.anomaly_json_sinks],
            *[lambda df, put=put: put(df.drop("dt")) for put in config.anomaly_row_sinks],
        ])
    finally:
        stats.unpersist()


def kafka_anomalies(bootstrap: str, topic: str) -> Callable[[DataFrame], None]:
    """K4: the anomaly topic, for ``StreamConfig.anomaly_json_sinks``. At least once: a replayed
    micro-batch sends its messages again."""
    return lambda messages: raw_json.kafka_write(messages, bootstrap, topic)


def jdbc_anomalies(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame], None]:
    """K3 in a database, for ``StreamConfig.anomaly_row_sinks`` (append, at least once)."""
    return lambda rows: jdbc.append(rows, url, table, properties)


# ---------------------------------------------------------------------------- jobs

def landing(spark: SparkSession, raw: DataFrame, paths: Paths, config: StreamConfig,
            available_now: bool = False) -> StreamingQuery:
    first = tables.run_of(spark, f"{paths.checkpoints}/landing")
    late = lateness.Windows(config.rollup_minutes, config.watermark,
                            f"{paths.checkpoints}/landing_times") if config.late_rows else None
    writer = (raw.writeStream.queryName("landing")
              .option("checkpointLocation", f"{paths.checkpoints}/landing")
              .foreachBatch(lambda batch, batch_id: land_batch(spark, batch, first + batch_id, paths,
                                                               config.landing_mode, late)))
    return _start(spark, writer, config.triggers.landing, available_now, config)


def rollup_stream(spark: SparkSession, raw: DataFrame, config: StreamConfig) -> DataFrame:
    events = aggregatable(raw, ROLLUP_KEYS).withWatermark("ts", config.watermark)
    return rollups.cost_rollups(events, config.rollup_minutes, config.percentile)


def rollup_job(spark: SparkSession, raw: DataFrame, paths: Paths, config: StreamConfig,
               available_now: bool = False) -> StreamingQuery:
    first = tables.run_of(spark, f"{paths.checkpoints}/rollups")
    writer = (rollup_stream(spark, raw, config).writeStream.queryName("rollups")
              .outputMode("append")
              .option("checkpointLocation", f"{paths.checkpoints}/rollups")
              .foreachBatch(lambda batch, batch_id: store_rollups(spark, batch, paths, first + batch_id,
                                                                  config.rollup_mode)))
    return _start(spark, writer, config.triggers.rollups, available_now, config)


def stats_stream(spark: SparkSession, raw: DataFrame, config: StreamConfig) -> DataFrame:
    events = aggregatable(raw, STATS_KEYS).withWatermark("ts", config.watermark)
    stats = an.window_stats(events, config.anomaly_minutes,
                            with_p95=config.baselines is not None, percentile=config.percentile)
    if config.baselines is None:
        return stats
    if config.state_store != ROCKSDB_PROVIDER:
        raise ValueError("baselines keep keyed state, which needs the RocksDB state store")
    return stateful.with_history(stats, config.baselines.lookback)


def anomaly_job(spark: SparkSession, raw: DataFrame, paths: Paths, config: StreamConfig,
                available_now: bool = False) -> StreamingQuery:
    """One aggregate (one state store) feeding the detectors; both sinks in one batch."""
    first = tables.run_of(spark, f"{paths.checkpoints}/anomalies")
    writer = (stats_stream(spark, raw, config).writeStream.queryName("anomalies")
              .outputMode("append")
              .option("checkpointLocation", f"{paths.checkpoints}/anomalies")
              .foreachBatch(lambda batch, batch_id: store_anomalies(spark, batch, first + batch_id,
                                                                    paths, config)))
    return _start(spark, writer, config.triggers.anomalies, available_now, config)


def levels_job(spark: SparkSession, raw: DataFrame, paths: Paths, config: StreamConfig,
               available_now: bool = False) -> StreamingQuery:
    """T2 + T3 in one query: panes of ``anomaly_minutes`` and the windows of ``rollup_minutes`` they
    add up to, each stored once when the watermark closes it, from one decode of the
    messages and one state of open panes (``stateful.window_levels``)."""
    first = tables.run_of(spark, f"{paths.checkpoints}/levels")
    events = aggregatable(raw, STATS_KEYS).withWatermark("ts", config.watermark)
    rows = stateful.window_levels(events, config.anomaly_minutes, config.rollup_minutes)

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = tables.with_date(_to_ntz(batch, "window_start", "window_end"), "window_start")
        tables.append_batch(rows, first + batch_id, paths.window_levels, ["dt"],
                            sort_cols=["minutes", "model", "window_start"])

    writer = (rows.writeStream.queryName("levels").outputMode("append")
              .option("checkpointLocation", f"{paths.checkpoints}/levels").foreachBatch(store))
    return _start(spark, writer, config.triggers.anomalies, available_now, config)


def summary_job(spark: SparkSession, raw: DataFrame, paths: Paths, config: StreamConfig,
                available_now: bool = False) -> StreamingQuery:
    """R5-R9 kept up to date: per-minute summaries with retractions (``summaries``)."""
    first = tables.run_of(spark, f"{paths.checkpoints}/summaries")
    touched = summaries.deliveries(accepted(spark, raw))
    writer = (touched.writeStream.queryName("summaries").outputMode("update")
              .option("checkpointLocation", f"{paths.checkpoints}/summaries")
              .foreachBatch(lambda batch, batch_id: summaries.store(batch, first + batch_id,
                                                                    paths.minute_summaries)))
    return _start(spark, writer, config.triggers.landing, available_now, config)


def _baseline_rows(stats: DataFrame, config: StreamConfig, detected) -> DataFrame:
    """N2-N4 of closed windows: from the previous windows they carry (streams), or over the whole
    input (batch)."""
    cfg = config.baselines
    if stateful.HISTORY[0] in stats.columns:
        return baselines.from_history(stats, cfg, detected)
    return (baselines.latency_baseline(stats, cfg, detected)
            .unionByName(baselines.cost_baseline(stats, cfg, detected))
            .unionByName(baselines.zscore_anomalies(baselines.zscores(stats, cfg), cfg, detected)))


def compact_events(spark: SparkSession, paths: Paths, dates) -> None:
    """Maintenance for merge-on-read landing: one row per event_id in closed dates."""
    tables.compact(spark, paths.events, dates, ["event_id"], ["batch_id", "arrival_key"],
                   sort_cols=["model", "ts"], index=EVENT_INDEX)


def compact_rollups(spark: SparkSession, paths: Paths, dates) -> None:
    """Maintenance for appended rollups: one row per rollup key in closed dates."""
    tables.compact(spark, paths.rollups, dates, list(schemas.ROLLUP_KEY), ["batch_id"],
                   sort_cols=["model", "window_start"])


# ---------------------------------------------------------------------------- dedup

def dedup_stream(spark: SparkSession, raw: DataFrame, config: StreamConfig) -> DataFrame:
    """Drop re-deliveries of an event_id seen within the watermark delay (bounded
    state); the keyed upsert of ``landing`` is the unbounded guarantee."""
    return (accepted(spark, raw).withWatermark("ts", config.watermark)
            .dropDuplicatesWithinWatermark(["event_id"]))


def dedup_job(spark: SparkSession, raw: DataFrame, out: str, paths: Paths,
              config: StreamConfig, available_now: bool = False) -> StreamingQuery:
    """T8 as a job: first delivery of each event_id, appended to a Parquet folder."""
    rows = (dedup_stream(spark, raw, config)
            .drop(*ARRIVAL_COLUMNS)
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    writer = (rows.writeStream.queryName("dedup").format("parquet").option("path", out)
              .option("checkpointLocation", f"{paths.checkpoints}/dedup"))
    return _start(spark, writer, config.triggers.landing, available_now, config)


# ---------------------------------------------------------------------------- wiring

def start_all(spark: SparkSession, source: Callable[[], DataFrame], paths: Paths,
              config: StreamConfig | None = None, available_now: bool = False
              ) -> list[StreamingQuery]:
    """Start the three jobs, each on its own reader and checkpoint, without waiting on
    any of them (then ``spark.streams.awaitAnyTermination()``)."""
    config = config or StreamConfig()
    return [landing(spark, source(), paths, config, available_now),
            rollup_job(spark, source(), paths, config, available_now),
            anomaly_job(spark, source(), paths, config, available_now)]


def dropped_late_rows(query: StreamingQuery) -> int:
    """T5: rows dropped by the watermark over the query's recent progress."""
    total = 0
    for progress in query.recentProgress:
        ops = progress["stateOperators"] if isinstance(progress, dict) else progress.stateOperators
        for op in ops or []:
            n = op["numRowsDroppedByWatermark"] if isinstance(op, dict) \
                else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total
