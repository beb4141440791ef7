"""Keyed state on top of closed windows: shared panes and rolling histories.

Both processors sit behind a native tumbling-window aggregate in append mode, so they see every
window once, when the watermark closes it, and never an event. Their state is keyed by model and
small by nature:

* ``PaneWindows`` passes each closed pane on and adds it to the longer window it lies in; an
  event-time timer emits that window when the watermark passes its end and drops it. One
  pass over the messages and one state per open pane serve both window lengths.
* ``WindowHistory`` keeps the last ``lookback`` windows of a model and sends them along with the
  next one, so baselines need neither files nor OVER clauses on a stream.

Times cross into Python as microseconds since 1970 in UTC, so no worker's zone matters.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from costpulse import schemas
from costpulse.functions import timefn
from costpulse.operators.rollups import failure_flag

MINUTE_US = 60_000_000
_COST = "decimal(28,6)"
LEVEL_ROWS = ("minutes int, start_us long, model string, requests long, latency_sum long, "
              f"latency_n long, failures long, cost {_COST}")


def _us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


class PaneWindows(StatefulProcessor):
    """Panes of ``pane`` minutes in, the same panes and windows of ``window`` minutes out."""

    def __init__(self, pane: int, window: int):
        if window % pane:
            raise ValueError("a window must hold whole panes")
        self.pane, self.window = pane, window

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState(
            "open", "start_us long", f"requests long, latency_sum long, latency_n long, "
                                     f"failures long, cost {_COST}")

    def _row(self, model, minutes, start, sums) -> Row:
        return Row(minutes=minutes, start_us=start, model=model, requests=sums[0],
                   latency_sum=sums[1], latency_n=sums[2], failures=sums[3], cost=sums[4])

    def handleInputRows(self, key, rows, timerValues):
        length = self.window * MINUTE_US
        sums: dict = {}
        for r in rows:
            pane = (r.requests, r.latency_sum or 0, r.latency_n, r.failures, r.cost)
            yield self._row(key[0], self.pane, r.start_us, pane)
            start = r.start_us - r.start_us % length
            sums[start] = _added(sums.get(start), pane)
        for start, more in sums.items():
            if self.open.containsKey((start,)):
                more = _added(tuple(self.open.getValue((start,))), more)
            else:
                self.handle.registerTimer((start + length) // 1000)
            self.open.updateValue((start,), more)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.window * MINUTE_US
        if self.open.containsKey((start,)):
            sums = tuple(self.open.getValue((start,)))
            self.open.removeKey((start,))
            yield self._row(key[0], self.window, start, sums)

    def close(self) -> None:
        pass


def _added(a: tuple | None, b: tuple) -> tuple:
    """Sums of two measures each; a missing cost (no call with one) adds nothing."""
    if a is None:
        return b
    cost = b[4] if a[4] is None else a[4] if b[4] is None else Decimal(a[4]) + Decimal(b[4])
    return (*(x + y for x, y in zip(a[:4], b[:4])), cost)


def panes(events: DataFrame, minutes: int) -> DataFrame:
    """Sums per (pane, model) of watermarked events: what longer windows add up."""
    window = F.window("ts", timefn.minutes_interval(minutes))
    latency = F.col("latency_ms").cast("bigint")
    return events.groupBy(window.alias("window"), "model").agg(
        F.count(F.lit(1)).alias("requests"), F.sum(latency).alias("latency_sum"),
        F.count(latency).alias("latency_n"),
        F.sum(failure_flag()).cast("bigint").alias("failures"),
        F.sum("cost_usd").cast(_COST).alias("cost")).select(
        "model", _us(F.col("window.start")).alias("start_us"), "requests", "latency_sum",
        "latency_n", "failures", "cost", F.window_time("window").alias("pane_time"))


def window_levels(events: DataFrame, pane: int, window: int) -> DataFrame:
    """Window statistics of both lengths from one stream of events: (minutes, window_start,
    window_end, model, total_requests, avg_latency_ms, error_rate, total_cost_usd)."""
    rows = panes(events, pane).groupBy("model").transformWithState(
        PaneWindows(pane, window), LEVEL_ROWS, "Append", "EventTime")
    length = F.col("minutes").cast("bigint") * MINUTE_US
    return rows.select(
        "minutes", F.timestamp_micros("start_us").alias("window_start"),
        F.timestamp_micros(F.col("start_us") + length).alias("window_end"), "model",
        F.col("requests").alias("total_requests"),
        F.when(F.col("latency_n") > 0, F.col("latency_sum").cast("double") / F.col("latency_n"))
         .alias("avg_latency_ms"),
        (F.col("failures").cast("double") / F.col("requests")).alias("error_rate"),
        F.col("cost").alias("total_cost_usd"))


# ---------------------------------------------------------------------------- histories

_P95, _TOTAL = schemas.LATENCY_TYPE.simpleString(), "decimal(22,6)"
_HISTORY_ROWS = (
    "start_us long, end_us long, model string, total_requests long, avg_latency_ms double, "
    f"error_rate double, total_cost_usd {_COST}, p95_latency_ms double, "
    f"previous_p95 array<{_P95}>, previous_cost array<{_TOTAL}>, "
    "previous_latency array<double>, previous_errors array<double>")
HISTORY = ("previous_p95", "previous_cost", "previous_latency", "previous_errors")


class WindowHistory(StatefulProcessor):
    """Closed windows in, each with the measures of the model's previous ``lookback`` ones out."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle) -> None:
        self.last = handle.getListState(
            "last", f"p95 {_P95}, cost {_TOTAL}, latency double, errors double")

    def handleInputRows(self, key, rows, timerValues):
        last = [tuple(r) for r in self.last.get()]
        for r in sorted(rows, key=lambda r: r.start_us):
            yield Row(start_us=r.start_us, end_us=r.end_us, model=key[0],
                      total_requests=r.total_requests, avg_latency_ms=r.avg_latency_ms,
                      error_rate=r.error_rate, total_cost_usd=r.total_cost_usd,
                      p95_latency_ms=r.p95_latency_ms,
                      **{name: [w[i] for w in last] for i, name in enumerate(HISTORY)})
            last = [*last, (r.p95, r.cost, r.avg_latency_ms, r.error_rate)][-self.lookback:]
        self.last.put(last)

    def close(self) -> None:
        pass


def with_history(stats: DataFrame, lookback: int) -> DataFrame:
    """Streamed window statistics (with p95) and four arrays of the model's previous windows, the
    oldest first; nulls stay in them."""
    slim = stats.select(
        "model", _us(F.col("window_start")).alias("start_us"), _us(F.col("window_end")).alias("end_us"),
        "total_requests", "avg_latency_ms", "error_rate",
        F.col("total_cost_usd").cast(_COST).alias("total_cost_usd"),
        F.col("p95_latency_ms").cast("double").alias("p95_latency_ms"),
        F.col("p95_latency_ms").cast(schemas.LATENCY_TYPE).alias("p95"),
        F.col("total_cost_usd").cast(_TOTAL).alias("cost"))
    rows = slim.groupBy("model").transformWithState(
        WindowHistory(lookback), _HISTORY_ROWS, "Append", "None")
    return rows.select(F.timestamp_micros("start_us").alias("window_start"),
                       F.timestamp_micros("end_us").alias("window_end"),
                       "model", "total_requests", "avg_latency_ms", "error_rate",
                       "total_cost_usd", "p95_latency_ms", *HISTORY)
