"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are put into a pseudo-random but fixed order and cut into blocks
of ``BLOCK`` documents. Time is counted in block slots. With weight w, the k-th block of a source
(k = 0, 1, ...) has release time floor(k / w) and deadline ceil((k + 1) / w); each slot goes to
the released block with the earliest deadline (ties: by source name). With one block a slot and
weights that add up to one this meets every deadline, so that at any slot a source has had
less than one block more or less than its share.

Weights are taken as they are written (0.67 is 67/100), so the bound holds against the given
weights over any number of slots. Brought to whole numbers without a common factor, their sum is
a period after which the schedule repeats, and block k of a source has a closed-form slot.
Nothing is dropped or repeated: when a source has no blocks left, a new phase starts in which
the others share the slots in proportion to their weights; the deviation bound holds within
every phase.

The driver holds, for each phase, the slots of one period or of the whole phase if that is
shorter, about 30 bytes a slot. Equal weights over n sources have a period of n slots, weights of two
decimals at most 100. Weights with many digits (1/3 as a float) have a period longer than any
phase: there the driver schedules every block, one slot for ``BLOCK`` documents, so such weights
should be rounded beforehand for more than some 10^8 documents (or by ``quantum``).

Bound on the number of sources: a phase ends whenever a source is used up and keeps an entry for
every source left, so S sources of different sizes need up to S^2 / 2 entries on the driver.
Meant for up to about 1,000 sources (5 * 10^5 entries); more should be grouped beforehand.

A third of all rows may belong to one source: documents are ranked within (source, hash range)
cells of about ``CELL`` rows and cells are numbered by a running sum over their counts.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
QUANTUM = 2520
CELL = 4096
HASH_SPAN = 1 << 62
SMALL_ROWS = 500_000     # of schedule tables, up to which they are broadcast (about 20 MB)


def parts(weights: dict[str, float], quantum: int = QUANTUM) -> dict[str, int]:
    """Slots per period of each source, at least one, by largest remainder; sums to the period
    (``quantum``, or the number of sources if that is larger)."""
    total = sum(weights.values())
    quantum = max(quantum, len(weights))
    exact = {s: w / total * quantum for s, w in weights.items()}
    got = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], s))
    at = 0
    while sum(got.values()) < quantum:
        got[order[at % len(order)]] += 1
        at += 1
    while sum(got.values()) > quantum:
        got[max(got, key=lambda s: (got[s], s))] -= 1
    return got


def exact(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers without a common factor in proportion to the weights as they are written."""
    as_written = {s: Fraction(w if isinstance(w, (int, Fraction, Decimal)) else str(w)) for s, w in weights.items()}
    if min(as_written.values()) <= 0:
        raise ValueError("weights must be positive")
    common = math.lcm(*(w.denominator for w in as_written.values()))
    whole = {s: int(w * common) for s, w in as_written.items()}
    factor = math.gcd(*whole.values())
    return {s: n // factor for s, n in whole.items()}


def window(k: int, part: int, length: int) -> tuple[int, int]:
    """(release time, deadline) of block k at weight ``part`` / ``length``."""
    return k * length // part, -(-(k + 1) * length // part)


def schedule(share: dict[str, int], left: dict[str, int]) -> np.ndarray:
    """The source (its number in order of name) of every slot of one period, earliest deadline
    first, or of the slots until a source has had its blocks ``left``."""
    length = sum(share.values())
    names = sorted(share)
    future: list = []                          # (release, deadline, source, block)
    ready: list = []                           # (deadline, source, block)
    for n, s in enumerate(names):
        future.append((*window(0, share[s], length), n, 0))
    heapq.heapify(future)
    out = array("i")
    for now in range(length):
        while future and future[0][0] <= now:
            heapq.heappush(ready, heapq.heappop(future)[1:])
        _, n, k = heapq.heappop(ready)
        out.append(n)
        s = names[n]
        if k + 1 == left.get(s):
            break
        if k + 1 < share[s]:
            heapq.heappush(future, (*window(k + 1, share[s], length), n, k + 1))
    return np.frombuffer(out, np.int32)


def period(slots: dict[str, int]) -> list[str]:
    """The source of every slot of one period."""
    names = sorted(slots)
    return [names[n] for n in schedule(slots, {})]


@dataclass(frozen=True)
class Phase:
    """Slots during which the same sources have blocks left."""

    slot: int                       # first slot
    first: dict[str, int]           # number of each source's first block in it
    length: int                     # slots
    period: int                     # slots after which the schedule repeats, if they are fewer
    places: dict[str, np.ndarray]   # the slots of each source in a period

    def used(self, source: str, slots: int) -> int:
        """Blocks of ``source`` in the first ``slots`` slots."""
        whole, rest = divmod(slots, self.period)
        return whole * len(self.places[source]) + int(np.searchsorted(self.places[source], rest))

    def slot_of(self, source: str, block: int) -> int:
        places = self.places[source]
        whole, k = divmod(block - self.first[source], len(places))
        return self.slot + whole * self.period + int(places[k])


def phases(blocks: dict[str, int], weights: dict[str, float], quantum: int | None = None) -> list[Phase]:
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(blocks, 0)
    slot, out = 0, []
    while left:
        given = {s: weights[s] for s in left}
        share = parts(given, quantum) if quantum else exact(given)
        order = schedule(share, left)
        names = sorted(share)
        by_source = np.argsort(order, kind="stable")
        sizes = np.bincount(order, minlength=len(names))
        places = {s: p for s, p in zip(names, np.split(by_source, np.cumsum(sizes)[:-1]))}
        length = len(order)
        if length == sum(share.values()):      # a whole period: again, until a source runs out
            whole = min(left[s] // share[s] for s in left)
            rest = {s: left[s] - whole * share[s] for s in left}
            length *= whole
            if all(rest.values()):
                length += 1 + min(int(places[s][n - 1]) for s, n in rest.items() if n <= share[s])
        phase = Phase(slot, {s: done[s] for s in left}, length, len(order), places)
        out.append(phase)
        slot += length
        for s in list(left):
            n = phase.used(s, length)
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
    return out


def _tables(plan: list[Phase], counts: dict[str, int], block: int):
    """Rows (source, phase, slot0, from, to, base, share, period, missing): blocks ``base`` + k of the
    source from ``from`` to ``to`` lie in the phase, ``missing`` documents short of full blocks
    before them; and an Arrow table (phase, source, k, offset): the slot of block k of a period."""
    spans, offsets = [], []
    short = []                                 # (slot, documents missing) of partial last blocks
    for p in plan:
        for s in p.first:
            last = -(-counts[s] // block) - 1
            if p.first[s] <= last < p.first[s] + p.used(s, p.length) and counts[s] % block:
                short.append((p.slot_of(s, last), block - counts[s] % block))
    short.sort()
    gone = np.cumsum([0, *(d for _, d in short)]).tolist()
    for n, p in enumerate(plan):
        for s, places in p.places.items():
            offsets.append((n, s, places))
        lo_at, hi_at = bisect_left(short, (p.slot,)), bisect_left(short, (p.slot + p.length,))
        edges = [0, *(at - p.slot + 1 for at, _ in short[lo_at:hi_at]), p.length]
        for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
            for s, base in p.first.items():
                begin, end = base + p.used(s, lo), base + p.used(s, hi)
                if end > begin:
                    spans.append((s, n, p.slot, begin, end, base, len(p.places[s]), p.period, gone[lo_at + i]))
    sizes = [len(places) for _, _, places in offsets]
    each = np.repeat(np.arange(len(offsets)), sizes)
    return spans, pa.table({
        "mix_phase": np.array([n for n, _, _ in offsets], np.int32)[each],
        "__mix_source": pa.array([s for _, s, _ in offsets], pa.string()).take(pa.array(each)),
        "__mix_k": np.concatenate([np.arange(k) for k in sizes] or [each]),
        "__mix_offset": np.concatenate([places for _, _, places in offsets] or [each])})


def mix(docs: DataFrame, weights: dict[str, float] | None = None, key: str = "doc_id",
        source: str = "source", block: int = BLOCK, quantum: int | None = None) -> DataFrame:
    """``docs`` with ``mix_phase`` (int), ``mix_slot`` (long: the block's slot) and
    ``mix_position`` (long: 0, 1, ... in mixed order, without gaps). All rows and columns stay.

    ``weights``: target weight of each source, positive; sources it does not name (null counts
    as '') get the smallest weight named; None weighs all sources alike. With ``quantum``, weights
    are first rounded to that many parts (``parts``) and the deviation bound holds against the
    rounded ones only. The counts by source are all that is gathered on the driver. The documents of a source are ordered by a hash of
    the key (of the whole row where the key is null), then the key, then a hash of the row, so
    repeated rows stay side by side. Columns of these three names are replaced. An empty table
    gives no rows."""
    spark = docs.sparkSession
    docs = docs.drop("mix_phase", "mix_slot", "mix_position")
    plain = [F.col(f"`{c}`") for c in docs.columns
             if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    own = F.xxhash64(*plain)
    named = (docs.withColumn("__mix_source", F.coalesce(F.col(source).cast("string"), F.lit("")))
             .withColumn("__mix_hash", F.pmod(F.when(F.col(key).isNull(), own).otherwise(
                 F.xxhash64(F.lit(29), key)), F.lit(HASH_SPAN))))
    counts = {r["__mix_source"]: r["count"] for r in named.groupBy("__mix_source").count().collect()}
    base = weights or {}
    least = min(base.values(), default=1.0)
    plan = phases({s: -(-n // block) for s, n in counts.items()},
                  {s: base.get(s, least) for s in counts}, quantum)
    spans, offsets = _tables(plan, counts, block)
    small = F.broadcast if len(offsets) + len(spans) <= SMALL_ROWS else (lambda df: df)
    cells = small(spark.createDataFrame([(s, -(-n // CELL)) for s, n in counts.items()],
                                        "__mix_source string, __mix_cells long"))
    span = small(spark.createDataFrame(
        spans, "__mix_source string, mix_phase int, __mix_slot0 long, __mix_from long, __mix_to long, __mix_base long, "
               "__mix_share long, __mix_period long, __mix_missing long"))
    at = small(spark.createDataFrame(offsets))

    celled = named.join(cells, "__mix_source").withColumn(
        "__mix_cell", F.expr(f"cast(__mix_hash / {float(HASH_SPAN)} * __mix_cells as long)"))
    sizes = celled.groupBy("__mix_source", "__mix_cell").agg(F.count("*").alias("__mix_n"))
    before = sizes.select("__mix_source", "__mix_cell", (F.sum("__mix_n").over(
        Window.partitionBy("__mix_source").orderBy("__mix_cell")) - F.col("__mix_n")).alias("__mix_before"))
    rank = F.row_number().over(Window.partitionBy("__mix_source", "__mix_cell").orderBy("__mix_hash", key, own)) - 1
    placed = (celled.withColumn("__mix_rank", rank).join(before, ["__mix_source", "__mix_cell"])
              .withColumn("__mix_at", F.col("__mix_before") + F.col("__mix_rank"))
              .withColumn("__mix_block", F.expr(f"__mix_at div {block}")))
    return (placed.join(span, "__mix_source").filter("__mix_block >= __mix_from and __mix_block < __mix_to")
            .withColumn("__mix_k", F.expr("(__mix_block - __mix_base) % __mix_share"))
            .join(at, ["mix_phase", "__mix_source", "__mix_k"])
            .withColumn("mix_slot", F.expr("__mix_slot0 + (__mix_block - __mix_base) div __mix_share * __mix_period + __mix_offset"))
            .withColumn("mix_position", F.expr(f"mix_slot * {block} - __mix_missing + __mix_at % {block}"))
            .select(*[F.col(f"`{c}`") for c in docs.columns], "mix_phase", "mix_slot", "mix_position"))
