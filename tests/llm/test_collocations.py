"""Collocations: DuckDB and plain counting against the tries, small bounds, exact arithmetic."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from costpulse.llm import collocations as C, phrase_sql, queries
from costpulse.plans.compare import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


def test_registered_query_equals_duckdb(llm):
    ok, message = compare(queries.op13_collocations(llm, SF), duckdb_connection(SF),
                          phrase_sql.collocations())
    assert ok, message


def _batches(rows, size=40):
    t = pa.table({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    return t.to_batches(max_chunksize=size)


def _sum(runs):
    total = Counter()
    for b in runs:
        for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            total[p] += n
    return total


def plain(rows, longest=3):
    total = Counter()
    for lang, text in rows:
        for words in C.pieces(text):
            total[f"{lang}\t"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    total[f"{lang}\t" + b" ".join(words[i:i + k]).decode()] += 1
    return total


@pytest.fixture(scope="module")
def rows(llm):
    return [(r["lang"] or "und", r["text"]) for r in
            llm.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.mark.parametrize("tight", [False, True])
def test_tries_count_like_plain_counting(rows, monkeypatch, tight):
    if tight:                       # every bound is met many times: spills, bursts, new ids
        for name, value in (("LIMIT", 300), ("WORDS", 200), ("BURST", 4), ("IDS_AT_ONCE", 30),
                            ("ROWS_AT_ONCE", 50)):
            monkeypatch.setattr(C, name, value)
    want = plain(rows)
    short = _sum(C._words_and_pairs(_batches(rows)))
    assert short == Counter({p: n for p, n in want.items() if p.count(" ") < 2})
    everything = b"\xff" * (C.FILTER_BITS // 8)
    assert _sum(C._triples(everything)(_batches(rows))) == Counter(
        {p: n for p, n in want.items() if p.count(" ") == 2})


def test_spilled_subtrees_are_whole_sorted_runs():
    t = C.Trie(3)
    t.add_triples((t.ids[a], t.ids[b], t.ids[c]) for a, b, c in
                  [(b"b", b"z", b"y"), (b"b", b"a", b"y"), (b"a", b"z", b"y"), (b"b", b"a", b"y")])
    runs = list(t.spill(1))
    assert runs == [[(b"b a y", 2), (b"b z y", 1)]] and t.size == 1
    assert list(t.spill(0)) == [[(b"a z y", 1)]] and t.size == 0


def test_pieces_and_case():
    assert list(C.pieces("A B,c\tD\x0bé Ü x\n\nIİ")) == [
        [b"a", b"b"], [b"c", b"d"], ["é Ü".encode(), b"x"], ["iİ".encode()]]
    assert list(C.pieces(None)) == list(C.pieces(" \t.,;")) == []


def test_scores_ties_cover_and_nulls(llm):
    rows = ([(None, "new york city")] * 12 + [("und", "new york")] * 13 + [("x\ty", "up down")] * 10
            + [("x\ty", "down up")] * 9 + [("x\ty", None), ("x\ty", ""), ("z", "one")]
            + [("r", "la la la la")] * 4)
    got = C.collocations(llm.createDataFrame(rows, "lang string, text string")).collect()
    by = {(r["lang"], r["phrase"]): r for r in got}
    # 12 of 25 occurrences lie in the triple: less than half, so the pair stays; "york city" goes
    assert ("und", "new york") in by and ("und", "york city") not in by
    r = by["und", "new york city"]
    assert (r["a"], r["l"], r["r"], r["n"]) == (12, 25, 12, 62)        # both cuts score 480000: k = 1
    assert r["score"] == 1000000 * 144 // (25 * 12)
    assert by["und", "new york"]["score"] == 1000000 * 625 // (25 * 25)
    assert set(p for _, p in by if _ == "x\ty") == {"up down"} and by["x\ty", "up down"]["rank"] == 1
    r = by["r", "la la"]                                            # overlaps count
    assert (r["a"], r["l"], r["r"], r["n"]) == (12, 16, 16, 16) and ("r", "la la la") not in by
    assert ("z", "one") not in by


def test_large_counts_do_not_overflow(llm):
    df = llm.createDataFrame([(10 ** 12, 10 ** 12, 3 * 10 ** 12), (7 * 10 ** 11, 10 ** 12, 10 ** 12)],
                             "a long, l long, r long")
    got = sorted(r[0] for r in df.select(C._score("a", "l", "r")).collect())
    assert got == [333333, 490000]


def test_odd_rows_and_top(llm, odd, empty):
    assert C.collocations(empty).count() == 0
    frequent = odd.sparkSession.createDataFrame(
        [("en", " ".join(f"a{i} b{i}" for i in range(6)))] * 11, "lang string, text string")
    once = C.collocations(odd.select("lang", "text").union(frequent), top=3)
    assert once.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {r["lang"]: r["count"] for r in once.groupBy("lang").count().collect()}.get("en", 0) == 3
    ranks = [r["rank"] for r in once.filter("lang = 'en'").orderBy("rank").collect()]
    assert ranks == [1, 2, 3]


def test_filter_keeps_every_frequent_pair():
    left = np.arange(1, 5000, dtype=np.uint64)
    slots = C._slots(left, left[::-1])
    assert slots.max() < C.FILTER_BITS and len(np.unique(slots)) > 4980


def test_a_word_is_looked_up_once_a_slice_and_phrases_leave_as_columns(monkeypatch):
    seen = []

    class Counted(C._Ids):
        def __getitem__(self, word):
            seen.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(C, "_Ids", Counted)
    some = [("en", "a b c. A b")] * 1000
    assert _sum(C._words_and_pairs(_batches(some, 1000))) == Counter(
        {p: n for p, n in plain(some, 2).items()})
    assert len(seen) <= 10                           # once it was 5,000


@pytest.mark.parametrize("name,value", [("READ_AT_ONCE", 7), ("BYTES_AT_ONCE", 20), ("SPAN", 1),
                                        ("BURST", 1), ("IDS_AT_ONCE", 1)])
def test_slices_spans_and_batches_lose_nothing(monkeypatch, name, value):
    rows = [("en", "one\ttwo  three.four\x01 five\x00,,;  six seven one two three"), ("en", None),
            ("en", " \t . "), ("é", "ÀÉ日本 語\x0bone two\r\nthree " + "long" * 50), ("en", "seven"),
            ("en", "six one two three four\x1f five six seven one two")] * 3
    monkeypatch.setattr(C, name, value)
    want = plain(rows)
    batches = list(C._words_and_pairs(_batches(rows, 5)))
    assert _sum(batches) == Counter({p: n for p, n in want.items() if p.count(" ") < 2})
    if name == "BYTES_AT_ONCE":
        assert all(b.num_rows == 1 or sum(map(len, b.column(0).to_pylist())) <= 40 for b in batches)
    everything = b"\xff" * (C.FILTER_BITS // 8)
    assert _sum(C._triples(everything)(_batches(rows, 5))) == Counter(
        {p: n for p, n in want.items() if p.count(" ") == 2})
