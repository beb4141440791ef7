"""Event-time and window expressions (all built-in, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from costpulse import schemas

# See ``schemas.REPORT_RANGES``.
ALLOWED_RANGES = schemas.REPORT_RANGES
DEFAULT_RANGE = schemas.DEFAULT_REPORT_RANGE


def parse_event_time(raw: Column) -> Column:
    """First 26 characters as ``yyyy-MM-dd'T'HH:mm:ss.SSSSSS``, NULL when unparsable,
    truncated to milliseconds, as TIMESTAMP_NTZ (wall clock in UTC)."""
    parsed = F.try_to_timestamp(F.left(raw, F.lit(schemas.EVENT_TIME_PREFIX_LEN)),
                                F.lit(schemas.EVENT_TIME_FORMAT))
    return to_ms_ntz(parsed)


def to_ms_ntz(ts: Column) -> Column:
    """Truncate to milliseconds and return TIMESTAMP_NTZ (UTC session)."""
    return F.date_trunc("millisecond", ts).cast("timestamp_ntz")


def format_wire_time(ts: Column) -> Column:
    """Event time as the producer writes it: microseconds plus a ``+00:00`` suffix."""
    return F.date_format(ts, schemas.EVENT_TIME_WIRE_FORMAT)


def minutes_interval(minutes: int) -> str:
    if int(minutes) <= 0:
        raise ValueError("window length must be a positive number of minutes")
    return f"{int(minutes)} minutes"


def range_interval(range_: str) -> str:
    """validate a report range."""
    if range_ not in ALLOWED_RANGES:
        raise ValueError(f"range {range_!r} not in {ALLOWED_RANGES}")
    return range_


def range_start(as_of: dt.datetime, range_: str) -> dt.datetime:
    """Lower bound of a trailing range as a literal, so Parquet pushdown and partition
    pruning can use it (a lower bound only, as in the dashboard)."""
    amount, unit = range_interval(range_).split()
    delta = dt.timedelta(minutes=int(amount)) if unit.startswith("minute") \
        else dt.timedelta(hours=int(amount))
    return as_of - delta


def ntz_lit(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal with exactly this wall-clock value (no zone conversion)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def since(column: str, as_of: dt.datetime, range_: str) -> Column:
    """``column >= as_of - range`` with a literal bound."""
    return F.col(column) >= ntz_lit(range_start(as_of, range_))
