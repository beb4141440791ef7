"""Late rows kept and counted (T5 + K7): what the windowed jobs can no longer count.

The watermark drops a row whose window it has closed, silently. The landing job sees every row, so it
keeps those as dead letters with their reason, their text and the watermark that closed the
window, and counts them. The watermark before a micro-batch is the newest event time of the
batches before it, less the delay, as the windowed jobs have it; each batch records its newest
event time in a small ledger of its own, which a replay rewrites, so a restart goes on
where it stopped. The row itself still lands: only windows are closed.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costpulse.functions import timefn
from costpulse.sinks import tables

REASON = "late:rollups"
EPOCH = dt.datetime(1970, 1, 1)
KEPT = 4                       # ledger entries that stay: a replay needs the one before its batch


@dataclass(frozen=True)
class Windows:
    """Whose lateness is meant: window length and watermark delay of the windowed job."""
    minutes: int
    delay: str
    ledger: str


def _entries(spark: SparkSession, ledger: str) -> dict[int, str]:
    Path, fs = tables.filesystem(spark, ledger)
    found = fs.globStatus(Path(f"{ledger.rstrip('/')}/*")) or []
    names = {str(st.getPath().getName()): st.getPath().toString() for st in found}
    return {int(n): p for n, p in names.items() if re.fullmatch(r"\d+", n)}


def newest_before(spark: SparkSession, ledger: str, batch_id: int) -> dt.datetime | None:
    """The newest event time of the batches before ``batch_id``."""
    entries = _entries(spark, ledger)
    earlier = [i for i in entries if i < batch_id]
    if not earlier:
        return None
    Path, fs = tables.filesystem(spark, ledger)
    stream = fs.open(Path(entries[max(earlier)]))
    try:
        return EPOCH + dt.timedelta(microseconds=int(stream.readLong()))
    finally:
        stream.close()


def record(spark: SparkSession, ledger: str, batch_id: int, newest: dt.datetime | None) -> None:
    """Enter the newest event time up to and with ``batch_id``; older entries go."""
    before = newest_before(spark, ledger, batch_id)
    known = [t for t in (newest, before) if t is not None]
    if not known:
        return
    Path, fs = tables.filesystem(spark, ledger)
    out = fs.create(Path(f"{ledger.rstrip('/')}/{batch_id}"), True)
    try:
        out.writeLong((max(known) - EPOCH) // dt.timedelta(microseconds=1))
    finally:
        out.close()
    entries = _entries(spark, ledger)
    for i in sorted(entries)[:-KEPT]:
        fs.delete(Path(entries[i]), False)


def delay_of(text: str) -> dt.timedelta:
    amount, unit = text.split()
    return dt.timedelta(**{unit.rstrip("s") + "s": int(amount)})


def keep(spark: SparkSession, assessed: DataFrame, batch_id: int, path: str, windows: Windows) -> int:
    """Store the late rows of a micro-batch (decodable messages with an event time) and return how
    many there are, and enter the batch's newest event time in the ledger."""
    before = newest_before(spark, windows.ledger, batch_id)
    closed = F.lit(None).cast("timestamp_ntz") if before is None else \
        timefn.ntz_lit(before - delay_of(windows.delay))
    timed = (assessed.where(F.col("event_time").isNotNull())
             .withColumn("window_end", F.window("event_time", timefn.minutes_interval(windows.minutes))["end"])
             .withColumn("watermark", closed))
    behind = F.col("window_end") <= F.col("watermark")
    seen = timed.agg(F.max("event_time").alias("newest"), F.count_if(behind).alias("late")).first()
    meta = [c for c in ("source", "arrival_key", "arrival_time") if c in assessed.columns]
    rows = timed.where(behind).select("value", F.array(F.lit(REASON)).alias("reasons"), *meta, "event_id",
                                      "event_time", "window_end", "watermark",
                                      F.to_date("event_time").alias("dt"))
    tables.append_batch(rows, batch_id, path, ["dt"])     # also without rows: a replay clears its own
    record(spark, windows.ledger, batch_id, seen["newest"])
    return seen["late"]
