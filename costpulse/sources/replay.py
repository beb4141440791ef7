"""Wire-format replay of landed events, with deterministic damage for quality tests.

``messages`` turns every landed event back into its JSON message (the producer's format).
``damaged_messages`` additionally applies one rule per event, chosen by the event's numeric
id (and, for some rules, its status), so that each malformed-message case of the decoder and
each quality check is exercised on a known number of rows. All rows pass through; the rules
only change content.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.sources import raw_json


@dataclass(frozen=True)
class Damage:
    modulus: int
    name: str
    stage: str                                    # "field": before encoding, "text": on the JSON text
    outcomes: tuple[tuple[str, str], ...] = ()    # (kind, reason) expected; none: accepted
    on: str | None = None                         # only on calls that are a "success" / "failure"


def _bad(*reasons: str) -> tuple[tuple[str, str], ...]:
    return tuple(("quarantine", r) for r in reasons)


def _warn(*reasons: str) -> tuple[tuple[str, str], ...]:
    return tuple(("warning", r) for r in reasons)


# Checked in order; the first rule that applies to the event's status and whose modulus
# divides the id is taken.
RULES = (
    Damage(101, "not_json", "text", _bad("unparsable")),
    Damage(103, "truncated", "text", _bad("unparsable")),
    Damage(107, "empty", "text", _bad("unparsable")),
    Damage(109, "json_array", "text", _bad("unparsable")),
    Damage(113, "no_model", "text", _bad("missing:model")),
    Damage(127, "latency_word", "text", _bad("not_integer:latency_ms")),
    Damage(131, "latency_fraction", "text", _bad("not_integer:latency_ms")),
    Damage(137, "time_word", "text", _bad("bad_timestamp")),
    Damage(139, "id_not_uuid", "text", _bad("bad_uuid:event_id")),
    Damage(149, "prompt_as_text", "text"),
    Damage(151, "unlisted_model", "field", _warn("unknown_model")),
    Damage(157, "total_off_by_one", "field", _warn("total_mismatch")),
    Damage(163, "user_too_long", "field", _bad("too_long:user_id")),
    Damage(167, "cost_word", "text", _bad("not_number:cost_usd")),
    Damage(173, "cost_huge", "text", _bad("too_large:cost_usd") + _warn("cost_mismatch"), "success"),
    Damage(61, "other_provider", "field", _warn("provider_mismatch")),
    Damage(67, "latency_low", "field", _warn("latency_below_floor")),
    Damage(71, "free_call", "field", _warn("success_without_cost", "cost_mismatch"), "success"),
    Damage(73, "cost_off", "field", _warn("cost_mismatch"), "success"),
    Damage(79, "code_on_success", "field", _warn("bad_error_code"), "success"),
    Damage(5, "prompt_over", "field", _warn("prompt_out_of_range"), "failure"),
    Damage(7, "completion_over", "field", _warn("completion_out_of_range"), "failure"),
    Damage(11, "cost_on_failure", "field", _warn("failure_with_cost"), "failure"),
    Damage(13, "status_word", "field", _warn("bad_status"), "failure"),
)


def event_number(event_id: Column) -> Column:
    """Numeric id of a landed fixture event (last 12 characters of its UUID)."""
    return F.right(event_id, F.lit(12)).try_cast("bigint")


def rule_of(n: Column, status: Column) -> Column:
    """Name of the damage rule for event number ``n`` (NULL: undamaged)."""
    arms = []
    for r in RULES:
        cond = (n % r.modulus) == 0
        if r.on is not None:
            cond = cond & ((status == schemas.SUCCESS) == F.lit(r.on == "success"))
        arms.append(F.when(cond, F.lit(r.name)))
    return F.coalesce(*arms)


def messages(events: DataFrame) -> DataFrame:
    return raw_json.encode(events).select("value")


def _damaged_fields() -> dict[str, dict[str, Column]]:
    """Column -> rule -> damaged value."""
    over_prompt = F.lit(schemas.PROMPT_TOKENS_MAX + 1)
    over_completion = F.lit(schemas.COMPLETION_TOKENS_MAX + 1)
    return {
        "model": {"unlisted_model": F.lit("unlisted-model")},
        "provider": {"other_provider": F.lit("other")},
        "user_id": {"user_too_long": F.repeat(F.lit("u"), 120)},
        "total_tokens": {"total_off_by_one": F.col("total_tokens") + 1,
                         "prompt_over": over_prompt + F.col("completion_tokens"),
                         "completion_over": F.col("prompt_tokens") + over_completion},
        "prompt_tokens": {"prompt_over": over_prompt},
        "completion_tokens": {"completion_over": over_completion},
        "cost_usd": {"free_call": F.lit(0).cast(schemas.COST_TYPE),
                     "cost_off": (F.col("cost_usd") + F.lit("0.01").cast(schemas.COST_TYPE))
                     .cast(schemas.COST_TYPE),
                     "cost_on_failure": F.lit("0.5").cast(schemas.COST_TYPE)},
        "latency_ms": {"latency_low": F.lit(schemas.LATENCY_MS_MIN - 1)},
        "status": {"status_word": F.lit("unknown")},
        "error_code": {"code_on_success": F.lit(schemas.ERROR_CODES[-1])},
    }


def damaged_messages(events: DataFrame) -> DataFrame:
    rule = F.col("_rule")
    ev = events.withColumn("_rule", rule_of(event_number(F.col("event_id")), F.col("status")))
    damaged = {name: F.coalesce(*[F.when(rule == r, value) for r, value in by_rule.items()],
                                F.col(name))
               for name, by_rule in _damaged_fields().items()}
    ev = ev.withColumns(damaged)
    v = F.col("value")
    text = (F.when(rule == "not_json", F.lit("not json"))
             .when(rule == "truncated", F.expr("left(value, length(value) - 5)"))
             .when(rule == "empty", F.lit(""))
             .when(rule == "json_array", F.lit("[1,2]"))
             .when(rule == "no_model", F.regexp_replace(v, r'"model":"[^"]*",', ""))
             .when(rule == "latency_word",
                   F.regexp_replace(v, r'"latency_ms":[0-9]+', '"latency_ms":"x"'))
             .when(rule == "latency_fraction",
                   F.regexp_replace(v, r'"latency_ms":([0-9]+)', '"latency_ms":$1.7'))
             .when(rule == "time_word",
                   F.regexp_replace(v, r'"timestamp":"[^"]*"', '"timestamp":"yesterday"'))
             .when(rule == "id_not_uuid",
                   F.regexp_replace(v, r'"event_id":"[^"]*"', '"event_id":"not-a-uuid"'))
             .when(rule == "prompt_as_text",
                   F.regexp_replace(v, r'"prompt_tokens":([0-9]+)', '"prompt_tokens":"$1"'))
             .when(rule == "cost_word", F.regexp_replace(v, r'"cost_usd":[^,]*', '"cost_usd":"x"'))
             .when(rule == "cost_huge",
                   F.regexp_replace(v, r'"cost_usd":[^,]*', '"cost_usd":1500000.25'))
             .otherwise(v))
    encoded = ev.select("_rule", raw_json.encode_column().alias("value"))
    return encoded.select(text.alias("value"))
