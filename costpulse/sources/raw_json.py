"""Raw JSON event sources and the tolerant decoder.

A source yields one row per message with the JSON text in ``value`` plus arrival metadata
(``source``, ``arrival_key``) that orders duplicates of one event (last arrival wins).
Kafka is used where its connector is on the classpath; files of JSON lines serve tests and
replays. The decoder is a pure DataFrame -> DataFrame function shared by batch and stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse import schemas
from costpulse.functions import pricing, timefn

CORRUPT = "_corrupt_record"
_WIRE_WITH_CORRUPT = T.StructType(
    list(schemas.RAW_EVENT_WIRE.fields) + [T.StructField(CORRUPT, T.StringType())])
_DECODE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


# ---------------------------------------------------------------------------- readers

def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest", min_partitions: int | None = None,
                 max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Kafka topic as a stream; the consumer position lives in the query's
    checkpoint, so each query (landing, rollups, anomalies) reads independently.

    ``min_partitions`` splits the offset ranges of a topic with few partitions over more
    tasks (decode and checks are per-row CPU work); ``max_offsets_per_trigger`` bounds a
    micro-batch after downtime so a catch-up does not produce one huge batch.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", int(min_partitions))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.lit("kafka").alias("source"),
        F.format_string("%s/%010d/%020d", F.col("topic"), F.col("partition"), F.col("offset"))
         .alias("arrival_key"),
        F.col("timestamp").cast("timestamp_ntz").alias("arrival_time"),
    )


def numbered(raw: DataFrame) -> DataFrame:
    """Arrival keys with the line's place: a task reads the lines of a file block in order, so
    its row counter orders them. For batch frames (also those of a micro-batch); the counter
    can't run inside a stream."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return raw.withColumn("arrival_key", F.format_string("%s/%012d", F.col("arrival_key"), place))


def _file_rows(df: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return df.select(
        F.col("value"),
        F.lit("file").alias("source"),
        F.format_string("%020d/%s/%020d", F.unix_micros(meta["file_modification_time"]),
                        meta["file_path"], meta["file_block_start"]).alias("arrival_key"),
        meta["file_modification_time"].cast("timestamp_ntz").alias("arrival_time"),
    )


def json_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                      ) -> DataFrame:
    """JSON-lines files as a stream (one message per line)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return _file_rows(reader.load(path))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files as a batch (replays, backfills)."""
    return numbered(_file_rows(spark.read.format("text").load(path)))


# ---------------------------------------------------------------------------- codec

def decode(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """S4 + P2: tolerant decode.

    Missing fields become NULL; numeric fields arrive as text and are try-cast (integer text
    is accepted, fractions or words are not; a cost of 10^12 USD or more is no number); an
    unparsable message keeps its text in ``_corrupt_record``. Adds ``event_time`` (ms, NTZ). The raw text and arrival columns are
    kept for the quarantine.
    """
    passthrough = [c for c in raw.columns if c != "_parsed"]
    parsed = raw.select(*passthrough, F.from_json(F.col(value_col), _WIRE_WITH_CORRUPT,
                                                  _DECODE_OPTIONS).alias("_parsed"))
    j = F.col("_parsed")
    fields = [j.isNull().alias("_null_message"), j[CORRUPT].alias(CORRUPT)]
    for f in schemas.RAW_EVENT_WIRE.fields:
        c = j[f.name]
        if f.name in schemas.INT_FIELDS:
            fields += [c.try_cast("int").alias(f.name), c.alias(f"{f.name}_text")]
        elif f.name == "cost_usd":
            fields += [c.try_cast(schemas.WIRE_COST_TYPE).alias(f.name), c.alias("cost_usd_text")]
        else:
            fields.append(c.alias(f.name))
    fields.append(timefn.parse_event_time(j["timestamp"]).alias("event_time"))
    # The decoded fields come out of a generator, as plain attributes: Catalyst neither
    # inlines the parse into later projections nor pushes filters on decoded fields below
    # it (the JSON text is parsed once per message), and constraint propagation does not
    # see one alias per field (whose combinations grow exponentially with the checks).
    return parsed.select(*passthrough, F.inline(F.array(F.struct(*fields))))


def encode_column() -> Column:
    """Wire JSON of one landed event (the producer's field order and time format)."""
    body = F.struct(
        "event_id",
        timefn.format_wire_time(F.col("ts")).alias("timestamp"),
        "model", "provider", "user_id", "session_id", "prompt_tokens", "completion_tokens",
        "total_tokens", F.col("cost_usd").cast("double").alias("cost_usd"), "latency_ms",
        "status", "error_code", "request_id",
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def encode(events: DataFrame) -> DataFrame:
    """K4 (events) / P15: landed events back to wire JSON, keyed by user_id."""
    return events.select(F.col("user_id").alias("key"), encode_column().alias("value"))


def encode_anomalies(anomalies: DataFrame, *extra: str) -> DataFrame:
    """K4: anomaly rows as JSON with ISO-8601 timestamps (metric values as numbers), keyed
    by model; ``extra`` columns are passed through unencoded (e.g. a partition column)."""
    body = F.struct(*[
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(c)
        if c in ("detected_at", "window_start", "window_end") else
        (F.col(c).cast("double").alias(c) if c in ("metric_value", "threshold_value") else F.col(c))
        for c in anomalies.columns if c not in extra])
    return anomalies.select(F.col("model").alias("key"), F.to_json(body).alias("value"), *extra)


def kafka_write(messages: DataFrame, bootstrap: str, topic: str) -> None:
    """K4 sink for Kafka (key/value columns); needs the Kafka connector on the classpath."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def landed(decoded_good: DataFrame, *extra: str) -> DataFrame:
    """The 14-column landed shape (``event_time AS ts``), plus ``extra`` columns."""
    return decoded_good.select(
        "event_id", F.col("event_time").alias("ts"), "model", "provider", "user_id",
        "session_id", "prompt_tokens", "completion_tokens", "total_tokens", "cost_usd",
        "latency_ms", "status", "error_code", "request_id", *extra,
    )


def with_price(decoded: DataFrame, spark: SparkSession) -> DataFrame:
    """Attach catalogue provider and expected price (broadcast, size-checked)."""
    cat = pricing.catalogue(spark).select(
        "model", F.col("provider").alias("catalogue_provider"), "in_micro", "out_micro")
    return decoded.join(F.broadcast(cat), "model", "left")
