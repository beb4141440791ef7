"""SimHash near-dedup with a bit-sliced comparison.

A fingerprint has bit i set where more than half the shingles' 64-bit hashes have it set.
Texts are lower-cased in A-Z, words are runs of non-whitespace (ASCII), shingles are three
words joined by a space with repeats; fewer words make one shingle of the whole sequence, no
words the fingerprint zero. Null text counts as empty. Two fingerprints link at ``RADIUS`` or
fewer differing bits; empty texts link like any other.

How pairs are found, without a quadratic scan:

* equal fingerprints are one node (copies never meet each other);
* the 64 bits are cut into ``BLOCKS`` parts; at most three differing bits leave at least
  ``BLOCKS - RADIUS`` parts equal, so every linked pair shares a bucket of one choice of
  parts (10 choices of 2 out of 5, about 25 bits each);
* inside a bucket (``buckets.collide``: tiles of bounded size) fingerprints are stored
  vertically, one bit plane per bit with 64 rows to a machine word. A plane is XORed against
  the other side, the result is added into carry-save counters (ones, twos, ... and a sticky
  overflow), 64 distances at a time; every few planes the words whose lanes have all
  overflowed are abandoned;
* a tile passes on only a spanning forest of its links; ``graph.components`` joins them.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from costpulse.llm import buckets, graph
from costpulse.llm.common import cut, fresh

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
BLOCKS = 5
ABANDON_EVERY = 8          # planes between two looks at the overflow words
WORDS_AT_ONCE = 1 << 13    # work arrays of 64 KB
SMALL = 64                 # groups up to this size are compared diagonal by diagonal
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text, as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    total = 0
    for at in range(0, n, 1 << 16):
        part = words[at:at + (1 << 16) + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.empty_like(ends)
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
        m = min(n - at, 1 << 16)
        last = ends[min(shingle, len(part)) - 1:][:m]
        hashes = np.fromiter(map(xxh64_intdigest, map(line.__getitem__, map(
            slice, starts[:m].tolist(), last.tolist())), repeat(SEED)), np.uint64, m)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(m, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += m
    on = (ones * 2 > total).astype(np.uint8)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def _fingerprints(text_at: int, shingle: int):
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(text_at).to_pylist()),
                              np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(b.columns) if i != text_at] + [pa.array(fps.view(np.int64))],
                [n for i, n in enumerate(b.schema.names) if i != text_at] + ["fp"])
    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(key, fp) for every row; fp is the fingerprint's bits as a signed long."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(_fingerprints(1, shingle), f"`{key}` {kind}, fp long")


def _parts() -> list[tuple[int, int]]:
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _keys(radius: int):
    choices = list(combinations(_parts(), BLOCKS - radius))

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for t, choice in enumerate(choices):
                key = np.full(len(fp), t, np.uint64)
                for at, width in choice:
                    key = (key << np.uint64(width)) | ((fp >> np.uint64(at))
                                                       & np.uint64((1 << width) - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["bucket", "id"])
    return run


# ---- bit-sliced comparison -------------------------------------------------------------

def planes(fp: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of every fingerprint, 64 fingerprints to a word."""
    pad = -len(fp) % 64
    rows = np.concatenate([fp, np.zeros(pad, np.uint64)]) if pad else fp
    bits = np.unpackbits(rows.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def scan(a: np.ndarray, ai: np.ndarray, b: np.ndarray, bi: np.ndarray, valid: np.ndarray,
         radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within ``radius``: for word n, the 64 distances between a[:, ai[n]] and b[:, bi[n]]
    are counted at once. Returns (word numbers, 64-bit lane masks); ``valid`` masks lanes."""
    order = radius.bit_length()
    lanes = valid.copy()
    where = np.flatnonzero(lanes)
    ai, bi, lanes = ai[where], bi[where], lanes[where]
    counters = np.zeros((order, len(where)), np.uint64)
    over = np.zeros(len(where), np.uint64)
    for plane in range(BITS):
        carry = a[plane][ai] ^ b[plane][bi]
        for c in counters:
            c_and = c & carry
            np.bitwise_xor(c, carry, out=c)
            carry = c_and
        over |= carry
        if plane % ABANDON_EVERY == ABANDON_EVERY - 1:
            alive = (lanes & ~over) != 0
            if not alive.all():
                where, ai, bi, lanes, over = where[alive], ai[alive], bi[alive], lanes[alive], over[alive]
                counters = counters[:, alive]
            if not len(where):
                break
    lanes = lanes & ~over
    if radius + 1 < 1 << order:        # counts above the radius that do not overflow
        above = np.zeros(len(lanes), np.uint64)
        equal = np.full(len(lanes), FULL)
        for bit in reversed(range(order)):
            if radius >> bit & 1:
                equal &= counters[bit]
            else:
                above |= equal & counters[bit]
                equal &= ~counters[bit]
        lanes &= ~above
    keep = lanes != 0
    return where[keep], lanes[keep]


def _lanes(words: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits = np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    n, lane = np.nonzero(bits)
    return words[n], lane


def diagonals(fp: np.ndarray, group: np.ndarray, radius: int):
    """Linked index pairs of many small groups laid end to end: row i against row i + k for
    k = 1, 2, ... as long as a group has rows that far apart."""
    p = planes(fp)
    words = p.shape[1]
    k = 0
    lefts, rights = [], []
    while True:
        k += 1
        if k >= len(fp):
            break
        same = np.zeros(words * 64, np.uint8)
        same[:len(fp) - k] = group[k:] == group[:-k]
        if not same.any():
            break
        valid = np.packbits(same, bitorder="little").view(np.uint64)
        skip, shift = divmod(k, 64)
        ahead = np.zeros((BITS, words + 1), np.uint64)
        ahead[:, :words - skip] = p[:, skip:]
        moved = (ahead[:, :-1] >> np.uint64(shift))
        if shift:
            moved |= ahead[:, 1:] << np.uint64(64 - shift)
        every = np.arange(words)
        w, masks = scan(p, every, moved, every, valid, radius)
        w, lane = _lanes(w, masks)
        lefts.append(w * 64 + lane)
        rights.append(w * 64 + lane + k)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (np.zeros(0, int),) * 2


def block(queries: np.ndarray, rows: np.ndarray, same: bool, radius: int):
    """Linked (query, row) index pairs of one tile; with ``same`` both sides are one list and
    only row > query counts."""
    p = planes(rows)
    words = p.shape[1]
    q = np.where(np.unpackbits(queries.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
                 != 0, FULL, np.uint64(0))
    full = np.full(words, FULL)
    if len(rows) % 64:
        full[-1] = np.uint64((1 << (len(rows) % 64)) - 1)
    step = max(1, WORDS_AT_ONCE // words)
    lefts, rights = [], []
    for at in range(0, len(queries), step):
        m = min(step, len(queries) - at)
        first = at // 64 if same else 0           # words before the first query are all lower
        ai = np.tile(np.arange(first, words), m)
        bi = np.repeat(np.arange(at, at + m), words - first)
        w, masks = scan(p, ai, q, bi, np.tile(full[first:], m), radius)
        n, lane = _lanes(w, masks)
        left, right = bi[n], ai[n] * 64 + lane
        if same:
            left, right = left[right > left], right[right > left]
        lefts.append(left)
        rights.append(right)
    return np.concatenate(lefts), np.concatenate(rights)


def _links(radius: int):
    """Spanning forests of the links inside the tiles of sorted (bucket, a, b, own, id) rows."""

    def run(batches):
        for t, starts in buckets.grouped(batches, 3):
            fp = t.column("id").to_numpy().view(np.uint64)
            a, b, own = (t.column(c).to_numpy() for c in ("a", "b", "own"))
            sizes = np.diff(np.append(starts, len(fp)))
            group = np.repeat(np.arange(len(starts)), sizes)
            little = (sizes <= SMALL) & (a[starts] == b[starts])
            at = np.flatnonzero(little[group])
            left, right = diagonals(fp[at], group[at], radius)
            found = [(at[left], at[right])]
            for s, n in zip(starts[~little], sizes[~little]):
                rows = np.arange(s, s + n)
                if a[s] == b[s]:
                    i, j = block(fp[rows], fp[rows], True, radius)
                    found.append((rows[i], rows[j]))
                else:
                    one, two = rows[own[rows] == a[s]], rows[own[rows] == b[s]]
                    if len(one) and len(two):
                        i, j = block(fp[one], fp[two], False, radius)
                        found.append((one[i], two[j]))
            ids = fp.view(np.int64)
            hi, lo = graph.forest(ids[np.concatenate([x for x, _ in found])],
                                  ids[np.concatenate([y for _, y in found])])
            yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo)], ["u", "v"])
    return run


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): edges between different fingerprints within ``radius`` bits that connect the
    same fingerprints as all such pairs do. ``fps``: one column ``fp``, no repeats needed."""
    if not 1 <= radius < BLOCKS:
        raise ValueError(f"radius must be 1 to {BLOCKS - 1}")
    keyed = fps.select("fp").mapInArrow(_keys(radius), "bucket long, id long")
    tiles = buckets.collide(keyed)
    return (tiles.select("bucket", "a", "b", "own", "id").repartition("bucket", "a", "b")
            .sortWithinPartitions("bucket", "a", "b").mapInArrow(_links(radius), "u long, v long"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id) for every row: component_id is the smallest key reachable.

    Null keys: such rows take the class of their fingerprint (null if it has no other key).
    Repeated rows give repeated rows. Empty table: no rows."""
    rows = cut(fingerprints(docs, key, text, shingle))
    nodes = rows.groupBy("fp").agg(F.min(key).alias("_least"))
    comps = graph.components(links(nodes, radius))
    named = (nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("component", F.coalesce("component", "fp")))
    least = named.groupBy("component").agg(F.min("_least").alias("component_id"))
    by_fp = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(key, "fp", "component_id")


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
               shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest key. All columns
    stay. Rows with a null key cannot be named and stay; a key that repeats is one document,
    of which the row with the smallest text hash stays."""
    gone, salt, rank = fresh(docs.columns, "gone", "salt", "rank")
    others = classes(docs.select(key, text), key, text, shingle, radius).filter(
        F.col(key) != F.col("component_id")).select(F.col(key).alias(gone))
    left = docs.join(others, F.col(key) == F.col(gone), "left_anti")
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    first = F.row_number().over(Window.partitionBy(key, salt).orderBy(F.xxhash64(text)))
    return (left.withColumn(salt, own).withColumn(rank, first)
            .filter(F.col(rank) == 1).select(*docs.columns))
