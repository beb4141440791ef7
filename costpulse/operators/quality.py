"""K7 + Q1-Q12: assess decoded events, split landed rows from the quarantine.

One projection adds ``accepted`` (no hard failure; a plain code-generated boolean used by
the filters), ``reasons`` (the hard failures: the row is quarantined) and ``warnings``
(soft business-rule failures: the row lands, the count is reported). Columns a caller does
not select are pruned: a plan that keeps only accepted rows never builds the arrays, and
the landing job builds them once per micro-batch for both of its outputs. No shuffle; the
catalogue lookup is a broadcast of the size-checked model table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import checks
from costpulse.sources import raw_json


def assess(decoded: DataFrame, spark: SparkSession) -> DataFrame:
    priced = raw_json.with_price(decoded, spark)
    hard = checks.hard_checks()
    return priced.select(
        "*",
        checks.passes(hard).alias("accepted"),
        checks.reasons(hard).alias("reasons"),
        checks.reasons(checks.soft_checks()).alias("warnings"),
    )


def good(assessed: DataFrame) -> DataFrame:
    """Rows the store accepts, in the landed 14-column shape plus arrival metadata."""
    ok = assessed.where(F.col("accepted"))
    meta = [c for c in ("source", "arrival_key", "arrival_time") if c in assessed.columns]
    return raw_json.landed(ok, *meta).withColumn(
        "cost_usd", F.col("cost_usd").try_cast(schemas.COST_TYPE))


def quarantined(assessed: DataFrame) -> DataFrame:
    """K7: dead-letter rows: original text, reasons, arrival metadata."""
    meta = [c for c in ("source", "arrival_key", "arrival_time") if c in assessed.columns]
    return (assessed.where(~F.col("accepted"))
                    .select("value", "reasons", *meta))


def reason_counts(assessed: DataFrame) -> DataFrame:
    """Counts per (kind, reason) over one batch; map-side combined before the shuffle."""
    hard = assessed.select(F.lit("quarantine").alias("kind"), F.explode("reasons").alias("reason"))
    soft = assessed.select(F.lit("warning").alias("kind"), F.explode("warnings").alias("reason"))
    return (hard.unionByName(soft).groupBy("kind", "reason")
                .agg(F.count(F.lit(1)).alias("events")))
