"""Q1-Q12: per-row data-quality predicates as (reason, failing-condition) pairs.

``HARD`` checks mirror what the stored table would reject (NOT NULL, UUID type, column
lengths, an unparsable message or event time): such rows go to quarantine. ``SOFT`` checks
are the producer's business rules (token bounds, totals, cost and error-code rules,
catalogue agreement): they are reported, not dropped, as the store accepts those rows.

All conditions are built-in expressions; ``reasons`` folds them into one array column with
``filter(array(when(cond, reason)...), x -> x IS NOT NULL)`` in a single projection.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from costpulse import schemas
from costpulse.functions import pricing

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
REQUIRED = ("event_id", "timestamp", "model", "provider", "user_id", "session_id",
            "prompt_tokens", "completion_tokens", "total_tokens", "cost_usd", "latency_ms",
            "status", "request_id")
# One micro-dollar: the producer rounds a float price, ties may land one unit apart.
COST_TOLERANCE = Decimal("0.000001")


def c(name: str) -> Column:
    return F.col(name)


def hard_checks() -> list[tuple[str, Column]]:
    checks: list[tuple[str, Column]] = [
        # Q1: not JSON, not an object, empty or NULL message.
        ("unparsable", c("_null_message") | c("_corrupt_record").isNotNull()),
    ]
    parsed = ~c("_null_message") & c("_corrupt_record").isNull()
    # Q2: required fields present.
    for f in REQUIRED:
        col = c(f"{f}_text") if f in schemas.INT_FIELDS or f == "cost_usd" else c(f)
        checks.append((f"missing:{f}", parsed & col.isNull()))
    # Numbers that are present but not integers / not decimals.
    for f in schemas.INT_FIELDS:
        checks.append((f"not_integer:{f}", c(f"{f}_text").isNotNull() & c(f).isNull()))
    checks.append(("not_number:cost_usd",
                   c("cost_usd_text").isNotNull() & c("cost_usd").isNull()))
    # A cost the event table has no room for (the aggregation jobs still count it).
    checks.append(("too_large:cost_usd",
                   c("cost_usd").isNotNull() & c("cost_usd").try_cast(schemas.COST_TYPE).isNull()))
    # Q3: UUID columns.
    for f in ("event_id", "request_id"):
        checks.append((f"bad_uuid:{f}", c(f).isNotNull() & ~c(f).rlike(UUID_PATTERN)))
    # Q10: column lengths.
    for f, n in schemas.MAX_LENGTHS.items():
        checks.append((f"too_long:{f}", F.length(c(f)) > F.lit(n)))
    # Q12: event time parses.
    checks.append(("bad_timestamp", c("timestamp").isNotNull() & c("event_time").isNull()))
    return checks


def soft_checks() -> list[tuple[str, Column]]:
    """Needs ``catalogue_provider``, ``in_micro``, ``out_micro`` (``raw_json.with_price``)."""
    status, code = c("status"), c("error_code")
    success = status == F.lit(schemas.SUCCESS)
    expected = pricing.micro_to_usd(pricing.cost_micro())
    return [
        # Q4
        ("total_mismatch", c("total_tokens") != c("prompt_tokens") + c("completion_tokens")),
        # Q5
        ("prompt_out_of_range", ~c("prompt_tokens").between(schemas.PROMPT_TOKENS_MIN,
                                                             schemas.PROMPT_TOKENS_MAX)),
        ("completion_out_of_range", ~c("completion_tokens").between(
            schemas.COMPLETION_TOKENS_MIN, schemas.COMPLETION_TOKENS_MAX)),
        # Q6
        ("bad_status", ~status.isin(*schemas.STATUSES)),
        # Q7 / Q8 (per row)
        ("unknown_model", c("model").isNotNull() & c("catalogue_provider").isNull()),
        ("provider_mismatch", c("catalogue_provider").isNotNull()
         & (c("provider") != c("catalogue_provider"))),
        # Q9
        ("latency_below_floor", c("latency_ms") < F.lit(schemas.LATENCY_MS_MIN)),
        ("success_without_cost", success & (c("cost_usd") <= 0)),
        ("failure_with_cost", ~success & (c("cost_usd") != 0)),
        ("bad_error_code",
         F.when(status == "error", ~F.coalesce(code.isin(*schemas.ERROR_CODES), F.lit(False)))
          .when(status == "timeout",
                ~F.coalesce(code == F.lit(schemas.TIMEOUT_CODE), F.lit(False)))
          .when(success, code.isNotNull())
          .otherwise(F.lit(False))),
        # Q11: success cost agrees with the catalogue price (1 micro-dollar tolerance).
        ("cost_mismatch", success & c("in_micro").isNotNull()
         & (F.abs(c("cost_usd") - expected) > F.lit(COST_TOLERANCE))),
    ]


def passes(checks: list[tuple[str, Column]]) -> Column:
    """TRUE when no condition is TRUE: a plain boolean expression, code-generated and
    short-circuiting (the reasons array is built only for the rows that need it)."""
    ok = F.lit(True)
    for _, cond in checks:
        ok = ok & ~F.coalesce(cond, F.lit(False))
    return ok


def reasons(checks: list[tuple[str, Column]]) -> Column:
    """Array of the reasons whose condition is TRUE (NULL conditions do not fire)."""
    flagged = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])
    return F.filter(flagged, lambda x: x.isNotNull())
