"""Rows that share a hash bucket, handed out in tiles of bounded size.

``collide`` takes (bucket, id) rows and returns (bucket, a, b, id) rows such that every two
different ids of a bucket meet in exactly one tile (bucket, a, b): ids of tile ``a`` meet those of
tile ``b``. Buckets up to ``TILE`` ids are one tile (0, 0). Larger ones are dealt by a hash of
the id over n tiles, and each id is sent to the n tile pairs it belongs to, so a bucket with a
third of all rows is compared by many tasks with bounded memory and no pair is left out.

``collide_packed`` does the same for rows that a task has put together by ranges of the bucket
number (``packed``): Spark shuffles and sorts one row for a hundred or so of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import cut
from costpulse.llm.textarrays import mix

TILE = 2048
OUT = "bucket long, id long, big boolean"
PACKED = "part int, pairs binary"
RANGE_BITS = 12, 16         # least and most bits of a bucket number that make its range
PACKED_AT_ONCE = 1 << 19    # pairs that a task puts together: 8 MB
HELD = 1 << 18              # pairs of one range that are held before crowded buckets are let go


def _renamed(k: np.ndarray, i: np.ndarray) -> np.ndarray:
    """A name by a hash of its ids for every bucket."""
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    name = mix(np.add.reduceat(mix(i.view(np.uint64)), first))
    return np.repeat(name.view(np.int64), np.diff(np.append(first, len(k))))


def _different(k: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, those of a bucket in the order of their ids."""
    same = k[1:] == k[:-1]
    several = np.flatnonzero(np.append(same, False) | np.append(False, same))
    order = several[np.lexsort((i[several], k[several]))]
    # buckets are sorted already, so equal ones stay at their places
    i = i.copy()
    i[several] = i[order]
    fresh = np.ones(len(k), bool)
    fresh[1:] = ~same | (i[1:] != i[:-1])
    return k[fresh], i[fresh]


def _batch(keys: np.ndarray, ids: np.ndarray, big: bool, merge: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(_renamed(keys, ids) if merge and not big else keys), pa.array(ids),
         pa.array(np.full(len(keys), big))], ["bucket", "id", "big"])


def _runs(tile: int, merge: bool):
    """Keeps the rows of buckets with two or more different ids; input sorted by bucket alone,
    which Spark sorts much faster than pairs. The different ids of a run are held until it
    ends or outgrows ``tile``; then its rows go on as ``big``, where an id may come again. With
    ``merge`` a small run is renamed by a hash of its ids, so that equal runs become one."""

    def run(batches):
        tail_k, tail_i, streaming = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.concatenate([tail_k, b.column(0).to_numpy()])
            i = np.concatenate([tail_i, b.column(1).to_numpy()])
            k, i = _different(k, i)
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            # the last run may go on in the next batch
            size = np.diff(np.append(first, len(k)))
            of = np.repeat(np.arange(len(first)), size)
            big = size > tile
            if streaming is not None:
                big |= k[first] == streaming
            whole = np.ones(len(first), bool)
            whole[-1] = False
            small = whole[of] & ~big[of] & (size[of] > 1)
            if small.any():
                yield _batch(k[small], i[small], False, merge)
            sent = big[of].copy()
            last = of == len(first) - 1
            if big[-1]:
                streaming = k[-1]
                tail_k, tail_i = tail_k[:0], tail_i[:0]
            else:
                tail_k, tail_i = k[last], i[last]
                streaming = None
            if sent.any():
                yield _batch(k[sent], i[sent], True, merge)
        if len(tail_k) > 1:
            yield _batch(tail_k, tail_i, False, merge)

    return run


def range_bits(rows: DataFrame) -> int:
    """Bits of a bucket number that make its range: some ranges for every shuffle partition."""
    least, most = RANGE_BITS
    shuffled = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, (4 * shuffled - 1).bit_length()), most)


def _pack(keys: np.ndarray, ids: np.ndarray, bits: int) -> pa.RecordBatch:
    part = (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    part = part[order]
    pairs = np.stack((keys[order], ids[order]), axis=1)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    ends = (np.append(first, len(part)) * pairs.itemsize * 2).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(first),
                                   [None, pa.py_buffer(ends), pa.py_buffer(pairs)])
    return pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int32)), column],
                                      ["part", "pairs"])


def packed(arrays, bits: int):
    """``PACKED`` rows of (bucket numbers, ids) arrays: one for every range of evenly spread bucket
    numbers and ``PACKED_AT_ONCE`` pairs or so, which holds its pairs one after another."""
    keys, ids, n = [], [], 0
    for k, i in arrays:
        keys.append(k)
        ids.append(i)
        n += len(k)
        if n >= PACKED_AT_ONCE:
            yield _pack(np.concatenate(keys), np.concatenate(ids), bits)
            keys, ids, n = [], [], 0
    if n:
        yield _pack(np.concatenate(keys), np.concatenate(ids), bits)


def _packed_runs(tile: int, merge: bool):
    """``_runs`` of ``PACKED`` rows sorted by range. Ranges that end are handled together; of one
    that outgrows ``HELD`` pairs, those of buckets above ``tile`` go on as ``big`` at once."""

    def settle(pairs, crowded, whole):
        """Batches of what is decided, the pairs that aren't, the buckets that have gone on."""
        order = np.argsort(pairs[:, 0])
        k, i = _different(pairs[order, 0], pairs[order, 1])
        if not len(k):
            return [], pairs, crowded
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        size = np.diff(np.append(first, len(k)))
        large = (size > tile) | np.isin(k[first], crowded)
        big, small = np.repeat(large, size), np.repeat(~large & (size > 1), size)
        out = [_batch(k[big], i[big], True, merge)] if big.any() else []
        if not whole:
            return out, np.stack((k[~big], i[~big]), axis=1), np.union1d(crowded, k[first][large])
        if small.any():
            out.append(_batch(k[small], i[small], False, merge))
        return out, pairs[:0], crowded

    def run(batches):
        none = np.zeros(0, np.int64)
        part, held, crowded, most = None, [], none, HELD
        for b in batches:
            if not b.num_rows:
                continue
            parts, column = b.column(0).to_numpy(), b.column(1).cast(pa.large_binary())
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
            pairs = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.int64)
            pairs = pairs.reshape(-1, 2)
            # the last range may go on in the next batch
            begin = int(np.searchsorted(parts, parts[-1]))
            if begin or parts[-1] != part:
                at = int(ends[begin] - ends[0]) // 16
                yield from settle(np.concatenate([*held, pairs[:at]]), crowded, True)[0]
                part, held, pairs, crowded, most = parts[-1], [], pairs[at:], none, HELD
            held.append(pairs)
            if sum(map(len, held)) > most:
                out, rest, crowded = settle(np.concatenate(held), crowded, False)
                yield from out
                # small buckets wait for the end of the range, looked at again when doubled
                held, most = [rest], max(HELD, 2 * len(rest))
        if held:
            yield from settle(np.concatenate(held), crowded, True)[0]

    return run


def collide_packed(rows: DataFrame, tile: int = TILE, merge: bool = False) -> DataFrame:
    """``collide`` of ``PACKED`` rows."""
    return _tiles(rows.repartition("part").sortWithinPartitions("part").mapInArrow(
        _packed_runs(tile, merge), OUT), tile, merge)


def collide(rows: DataFrame, tile: int = TILE, merge: bool = False) -> DataFrame:
    """See the module text. ``rows``: bucket long, id long, neither null; repeats count once.
    With ``merge``, buckets of the same ids (alike rows share many) are given out once, under
    a name of their own."""
    return _tiles(rows.select("bucket", "id").repartition("bucket").sortWithinPartitions(
        "bucket").mapInArrow(_runs(tile, merge), OUT), tile, merge)


def _tiles(found: DataFrame, tile: int, merge: bool) -> DataFrame:
    found = cut(found.distinct() if merge else found)
    small = found.filter(~F.col("big")).select("bucket", F.lit(0).alias("a"), F.lit(0).alias("b"),
                                               "id", F.lit(0).alias("own"))
    big = found.filter("big").select("bucket", "id").distinct()
    tiles = big.groupBy("bucket").agg(F.ceil(F.count("*") / tile).cast("int").alias("n"))
    dealt = (big.join(tiles, "bucket")
             .withColumn("own", F.pmod(F.xxhash64(F.lit(11), "id"), F.col("n")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, n - 1)"))))
    return small.unionByName(dealt.select(
        "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
        "id", "own"))


def grouped(batches, keys: int, most: int = 1 << 16):
    """Lists of whole groups from Arrow batches sorted by the first ``keys`` (integer) columns:
    (table, starts) with the groups' first rows; a group is never split."""
    held = []
    rows = 0

    def give(t, last):
        cols = [t.column(c).to_numpy() for c in range(keys)]
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        if last:
            return (t, starts), None
        if len(starts) == 1:
            return None, t
        return (t.slice(0, starts[-1]), starts[:-1]), t.slice(starts[-1])

    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= most:
            out, rest = give(pa.Table.from_batches(held), False)
            held = rest.combine_chunks().to_batches() if rest is not None else []
            rows = sum(x.num_rows for x in held)
            if out:
                yield out
    if held:
        out, _ = give(pa.Table.from_batches(held), True)
        yield out
