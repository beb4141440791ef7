"""Line dedup sends one row for many band keys: packed ranges give what plain rows give."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from costpulse.llm import buckets
from costpulse.llm import linededup as L


def _unpacked(batches):
    for b in batches:
        for part, blob in zip(*(c.to_pylist() for c in b.columns)):
            for k, i in np.frombuffer(blob, np.int64).reshape(-1, 2).tolist():
                yield part, k, i


def _spread(keys):
    """Evenly spread bucket numbers for small ones."""
    return buckets.mix(np.asarray(keys).astype(np.uint64)).view(np.int64)


@pytest.mark.parametrize("bits", buckets.RANGE_BITS)
def test_packed_rows_hold_every_pair_in_its_range(monkeypatch, bits):
    monkeypatch.setattr(buckets, "PACKED_AT_ONCE", 50)
    rng = np.random.default_rng(1)
    arrays = [(_spread(rng.integers(0, 90, n)), rng.integers(-99, 99, n)) for n in (0, 7, 60, 1, 200, 3)]
    got = list(_unpacked(buckets.packed(iter(arrays), bits)))
    assert Counter((k, i) for _, k, i in got) == Counter(
        (int(k), int(i)) for a, b in arrays for k, i in zip(a, b))
    assert all(part == (k % (1 << 64)) >> (64 - bits) for part, k, _ in got)
    assert list(buckets.packed(iter([]), bits)) == []


def test_bands_send_few_rows():
    """A row for every band of every line took most of the time."""
    rng = random.Random(7)
    lines = ["".join(rng.choices("abcdefgh ijk", k=30)).strip() for _ in range(4000)]
    texts = ["\n".join(lines[i:i + 8]) for i in range(0, len(lines), 8)] + [None, "", " \n "]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i:i + 100], pa.string())], ["text"])
               for i in range(0, len(texts), 100)]
    out = list(L._bands(8)(iter(batches)))
    assert sum(b.num_rows for b in out) == 256 and out[0].num_rows < len(lines) * L.BANDS / 100
    ids = [L.line_id(x) for x in dict.fromkeys(lines)]
    keys = L.band_keys(list(dict.fromkeys(lines)))
    want = {(int(k), i) for band in keys for k, i in zip(band, ids)}
    assert {(k, i) for _, k, i in _unpacked(out)} == want


@pytest.mark.parametrize("merge", [False, True])
@pytest.mark.parametrize("held", [1, 16, 1 << 18])
@pytest.mark.parametrize("size", [1, 3, 1000])
def test_packed_runs_are_those_of_plain_rows(monkeypatch, merge, held, size):
    monkeypatch.setattr(buckets, "HELD", held)
    monkeypatch.setattr(buckets, "PACKED_AT_ONCE", 40)
    rng = np.random.default_rng(8)
    keys = _spread(np.concatenate([rng.integers(0, 60, 200), np.full(90, 70), np.full(40, 80)]))
    ids = rng.integers(1, 26, len(keys))
    ids[keys == _spread([80])[0]] = 4              # one id many times is no bucket
    order = rng.permutation(len(keys))
    parts = (keys[order[i:i + 20]] for i in range(0, len(keys), 20))
    rows = pa.Table.from_batches(list(buckets.packed(
        ((k, ids[order[20 * n:20 * n + 20]]) for n, k in enumerate(parts)), 2)))
    batches = rows.sort_by("part").combine_chunks().to_batches(max_chunksize=size)
    got = {}
    for b in buckets._packed_runs(10, merge)(iter(batches)):
        for k, i, big in zip(*(c.to_pylist() for c in b.columns)):
            got.setdefault((k, big), set()).add(i)
    want = {int(k): {int(i) for i in ids[keys == k]} for k in set(keys)}
    want = {k: v for k, v in want.items() if len(v) > 1}
    assert {k: v for (k, big), v in got.items() if big} == {k: v for k, v in want.items() if len(v) > 10}
    small = {k: v for k, v in want.items() if len(v) <= 10}
    if merge:
        assert {tuple(sorted(v)) for (_, big), v in got.items() if not big} == \
            {tuple(sorted(v)) for v in small.values()}
    else:
        assert {k: v for (k, big), v in got.items() if not big} == small


def test_a_crowded_bucket_is_not_held(monkeypatch):
    monkeypatch.setattr(buckets, "HELD", 100)
    key = _spread([5])[0]
    batches = (b for n in range(50) for b in buckets.packed(
        iter([(np.full(60, key), np.arange(60 * n, 60 * n + 60))]), 12))
    out = list(buckets._packed_runs(10, True)(batches))
    assert max(b.num_rows for b in out) <= 120 and all(all(b.column(2).to_pylist()) for b in out)
    assert sorted(i for b in out for i in b.column(1).to_pylist()) == list(range(3000))


def test_tiles_of_packed_rows_equal_those_of_plain_rows(llm):
    rng = np.random.default_rng(3)
    keys = _spread(np.concatenate([rng.integers(0, 400, 1500), np.full(70, 9000)]))
    ids = np.concatenate([rng.integers(0, 50, 1500), np.arange(70)])
    plain = llm.createDataFrame([(int(k), int(i)) for k, i in zip(keys, ids)], "bucket long, id long")
    bits = buckets.range_bits(plain)

    def pack(batches):
        yield from buckets.packed(((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches), bits)

    want = buckets.collide(plain, tile=16).collect()
    got = buckets.collide_packed(plain.mapInArrow(pack, buckets.PACKED), tile=16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 1500
