"""Model catalogue and call pricing.

The catalogue is reference data of a fixed, tiny size (one row per model). It is joined with
``broadcast`` after an explicit size check, so the event side is never shuffled for the
lookup. Prices are held as integer micro-dollars per 1k tokens: cost arithmetic is then
exact integer math and only the final value becomes DECIMAL(12,6).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costpulse import schemas

# See ``schemas.MODELS``.
MODELS = schemas.MODELS

# Largest catalogue we accept to broadcast. The catalogue is reference data that grows
# with the number of models offered, not with traffic; the bound makes that an invariant.
MAX_BROADCAST_CATALOGUE_ROWS = 10_000

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("provider", T.StringType(), False),
    T.StructField("in_micro", T.LongType(), False),
    T.StructField("out_micro", T.LongType(), False),
    T.StructField("base_ms", T.IntegerType(), False),
    T.StructField("lo", T.IntegerType(), False),
    T.StructField("hi", T.IntegerType(), False),
])


def catalogue_rows(models=MODELS) -> list[tuple]:
    """Catalogue rows with integer micro-dollar prices and cumulative weight bands in %."""
    rows, lo = [], 0
    for model, provider, price_in, price_out, base_ms, weight in models:
        hi = lo + int(Decimal(weight) * 100)
        rows.append((model, provider, int(Decimal(price_in) * 1_000_000),
                     int(Decimal(price_out) * 1_000_000), base_ms, lo, hi))
        lo = hi
    return rows


def catalogue(spark: SparkSession, models=MODELS) -> DataFrame:
    rows = catalogue_rows(models)
    if len(rows) > MAX_BROADCAST_CATALOGUE_ROWS:
        raise ValueError(f"catalogue has {len(rows)} rows; too large to broadcast")
    # A literal relation: planning and broadcasting it needs no job over Python rows.
    columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                        for f in CATALOGUE_SCHEMA.fields)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} "
                     f"AS t({', '.join(CATALOGUE_SCHEMA.fieldNames())})")


def _literal(value: str | int) -> str:
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_catalogue(events: DataFrame, cat: DataFrame, how: str = "left") -> DataFrame:
    """Price and provider lookup by model name (broadcast hash join, no event shuffle)."""
    return events.join(F.broadcast(cat.withColumnRenamed("provider", "catalogue_provider")),
                       "model", how)


def cost_micro(prompt_tokens: str = "prompt_tokens", completion_tokens: str = "completion_tokens",
               in_micro: str = "in_micro", out_micro: str = "out_micro") -> Column:
    """Price in integer micro-dollars, rounded half up: (p*in + c*out + 500) div 1000."""
    return F.expr(f"(CAST({prompt_tokens} AS BIGINT) * {in_micro} "
                  f"+ CAST({completion_tokens} AS BIGINT) * {out_micro} + 500) div 1000")


def micro_to_usd(micro: Column) -> Column:
    """Integer micro-dollars as DECIMAL(12,6), exact."""
    return (micro.cast("decimal(12,0)") * F.lit(Decimal("0.000001")).cast("decimal(7,6)")) \
        .cast(schemas.COST_TYPE)


def call_cost(status: Column, micro: Column) -> Column:
    """A call costs its price when it succeeded, else 0, as DECIMAL(12,6)."""
    return F.when(status == F.lit(schemas.SUCCESS), micro_to_usd(micro)) \
        .otherwise(F.lit(0)).cast(schemas.COST_TYPE)
