"""Line dedup and its helpers in little memory and time: codes for shingles, buckets sorted by one
number, small work arrays."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from costpulse.llm import buckets, textarrays
from costpulse.llm import linededup as L


def _some_lines():
    rng = random.Random(5)
    letters = "abcdeé ÿ", "日本語のテキスト行です", "abc日本"
    lines = ["", "x", "1234567", "12345678", "a" * 40, "ÿ" * 9, "日" * 9]
    for _ in range(120):
        line = "".join(rng.choices(rng.choice(letters), k=rng.randrange(5, 60)))
        cut = rng.randrange(len(line))
        lines += [line, line[:cut] + rng.choice("é日z") + line[cut:]]
    return lines


def test_codes_count_shingles_as_sets_do():
    lines = [x for x in _some_lines() if x]
    sets, codes = [L.shingles(x) for x in lines], [L.shingle_codes(x)[0] for x in lines]
    for own, code in zip(sets, codes):
        assert len(own) == len(code) and code.dtype == np.uint64
    for i in range(0, len(lines), 3):
        for j in range(len(lines)):
            assert L._common(codes[i], codes[j]) == len(sets[i] & sets[j])


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_alike_lines_by_codes(threshold):
    lines = [x for x in _some_lines() if x]
    linker = L.Linker(dict(enumerate(lines)).__getitem__, threshold)
    sets = [L.shingles(x) for x in lines]
    for i in range(0, len(lines), 2):
        for j in range(i):
            common = len(sets[i] & sets[j])
            assert linker._alike(i, j) == (common >= threshold * (len(sets[i]) + len(sets[j]) - common))


def test_a_line_is_held_in_eight_bytes_a_shingle():
    """Sets of strings took over a hundred."""
    line = "".join(random.Random(2).choices("abcdefghij klmnop", k=5000))
    own, *_ = L.Linker({0: line}.__getitem__, 0.8)._set(0)
    assert own.nbytes == 8 * len(L.shingles(line))


@pytest.mark.parametrize("merge", [False, True])
@pytest.mark.parametrize("size", [1, 3, 50, 1000])
def test_ids_of_a_bucket_come_in_any_order(merge, size):
    rng = np.random.default_rng(8)
    keys = np.sort(np.concatenate([rng.integers(0, 60, 200), np.full(90, 70), np.full(40, 80)]))
    ids = rng.integers(1, 26, len(keys))
    ids[keys == 80] = 4                            # one id many times is no bucket
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + size]), pa.array(ids[i:i + size])],
                                          ["bucket", "id"]) for i in range(0, len(keys), size)]
    got = {}
    for b in buckets._runs(10, merge)(iter(batches)):
        for k, i, big in zip(*(c.to_pylist() for c in b.columns)):
            got.setdefault((k, big), []).append(i)
    want = {int(k): sorted({int(i) for i in ids[keys == k]}) for k in set(keys)}
    want = {k: v for k, v in want.items() if len(v) > 1}
    small = sorted(v for v in want.values() if len(v) <= 10)
    if merge:
        lists = sorted({tuple(sorted(set(v))) for (_, big), v in got.items() if not big})
        assert lists == sorted(set(map(tuple, small)))
    else:
        assert sorted(v for (_, big), v in got.items() if not big) == small
    assert {k: sorted(set(v)) for (k, big), v in got.items() if big} == \
        {k: v for k, v in want.items() if len(v) > 10}


@pytest.mark.parametrize("merge", [False, True])
def test_a_crowded_bucket_deals_every_id_once(llm, merge):
    ids = [*range(100)] * 30
    random.Random(4).shuffle(ids)
    rows = buckets.collide(llm.createDataFrame([(1, i) for i in ids], "bucket long, id long"),
                           tile=8, merge=merge).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    tiles = {}
    for r in rows:
        tiles.setdefault((r["a"], r["b"]), []).append(r["id"])
    met = {(min(x, y), max(x, y)) for t in tiles.values() for x in t for y in t if x != y}
    assert len(met) == 100 * 99 // 2


def test_tables_kept_by_a_worker_are_small():
    textarrays.word_hashes(*textarrays.utf8(pa.array(["some words of a text"])))
    kept = sum(a.nbytes for pair in textarrays._POWERS.values() for a in pair)
    assert kept <= 4 << 20


def test_word_hashes_do_not_depend_on_the_slice(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abé日", k=rng.randrange(1, 9))) for _ in range(n))
             for n in (0, 1, 50, 400)] + ["w" * 900, None]
    column = textarrays.utf8(pa.array(texts, pa.string()))
    whole = textarrays.word_hashes(*column)
    monkeypatch.setattr(textarrays, "SLICE", 64)
    monkeypatch.setattr(textarrays, "_POWERS", {})
    for a, b in zip(whole, textarrays.word_hashes(*column)):
        assert (a == b).all()
