"""Toxicity: the models against a plain recursion, held-out accuracy, odd rows."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from costpulse.llm import queries, toxicity as T

SF = "/root/testdata/sf0.01"


def brute(words: dict, order: int):
    """word -> log ratio by the textbook recursion over dictionaries; ``words``: word ->
    (ordinary, toxic) counts."""
    raw = [defaultdict(lambda: [0, 0]) for _ in range(order + 1)]
    for w, c in words.items():
        s = T.START + w + T.END
        for k in range(1, order + 1):
            for j in range(len(s) - k + 1):
                for y in (0, 1):
                    raw[k][s[j:j + k]][y] += c[y]
    counts = [None]
    for k in range(1, order + 1):
        own = {}
        for g, c in raw[k].items():
            if k == order or g[0] == T.START:
                own[g] = tuple(c)
            else:
                left = [x for h, x in raw[k + 1].items() if h[1:] == g]
                own[g] = tuple(sum(x[y] > 0 for x in left) for y in (0, 1))
        counts.append(own)
    counts[1].pop(T.START)

    def discount(k, y):
        one, two = (sum(c[y] == n for c in counts[k].values()) for n in (1, 2))
        return min(0.95, max(0.4, one / (one + 2 * two))) if one else 0.5

    d = [None] + [[discount(k, y) for y in (0, 1)] for k in range(1, order + 1)]
    pooled = sum(map(sum, counts[1].values()))

    def p(context, c, y):
        k = len(context) + 1
        if k == 1:
            low = (sum(counts[1].get(c, (0, 0))) + 1) / (pooled + len(counts[1]) + 2)
        else:
            low = p(context[1:], c, y)
        own = {g: x for g, x in counts[k].items() if g[:-1] == context}
        n = sum(x[y] for x in own.values())
        if not n:
            return low
        kinds = sum(x[y] > 0 for x in own.values())
        seen = own.get(context + c, (0, 0))[y]
        return max(seen - d[k][y], 0) / n + d[k][y] * kinds / n * low

    def ratio(w):
        s = T.START + w + T.END
        return sum(math.log(p(s[max(0, j - order + 1):j], s[j], 1))
                   - math.log(p(s[max(0, j - order + 1):j], s[j], 0)) for j in range(1, len(s)))
    return ratio


def _model(llm, words, order):
    rows = llm.createDataFrame([(w, t, o) for w, (o, t) in words.items()],
                               "word string, toxic long, ordinary long")
    runs = rows.mapInArrow(T._run_counts(order), "run string, toxic long, ordinary long") \
        .groupBy("run").agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).collect()
    raw = {r["run"]: (r["o"], r["t"]) for r in runs}
    before = defaultdict(lambda: [0, 0])
    for g, c in raw.items():
        if len(g) > 1:
            for y in (0, 1):
                before[g[1:]][y] += c[y] > 0
    names = sorted(raw)
    return T.kneser_ney(names, np.array([raw[g] for g in names]),
                        np.array([before[g] for g in names]), order)


@pytest.mark.parametrize("order", [2, 4, 6])
def test_ratios_equal_the_plain_recursion(llm, order):
    rng = random.Random(order)
    words = {"".join(rng.choice("abcé日") for _ in range(rng.randint(1, 8))):
             (rng.choice([0, 1, 1, 2, 9]), rng.choice([0, 0, 1, 3])) for _ in range(150)}
    words["idiot"] = (0, 40)
    model, want = _model(llm, words, order), brute(words, order)
    probe = [*list(words)[:60], "idiots", "zzz", "a", "aaaaaaaaaaaaaaaaaaaa", "ié", "x日y"]
    got = T.ratios(model, probe)
    # a letter that no class has seen has the same shared probability in both
    assert got == pytest.approx([want(w) for w in probe], rel=1e-4, abs=1e-4)


def test_registered_query_finds_held_out_toxic_documents(llm):
    rows = queries.op11_toxicity(llm, SF).collect()
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    label = {r["doc_id"]: r["toxic"] for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    english = {r["doc_id"] for r in docs.filter("lang = 'en'").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label and r["doc_id"] in english]
    toxic = [r["predicted"] for r in held if label[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in held if label[r["doc_id"]] == 0]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_scores_depend_on_text_alone_and_copies_count_once(llm):
    base = [(i, f"plain words about gardens number {i} and water", 0) for i in range(60)]
    toxic = [(100 + i, f"you are an utter blockhead number {i} and water", 1) for i in range(30)]
    copies = [(1000 + i, base[0][1], 0) for i in range(300)]
    def fit(rows, copied=()):
        docs = llm.createDataFrame([(i, t) for i, t, _ in [*rows, *copied]], "doc_id long, text string")
        labels = llm.createDataFrame([(i, y) for i, _, y in [*rows, *copied]], "doc_id long, toxic int")
        return docs, T.fit(docs, labels, train=F.lit(True))
    docs, model = fit(base + toxic)
    _, again = fit(base + toxic, copies)
    assert np.array_equal(model.keys, again.keys) and np.allclose(model.ratio, again.ratio)
    s = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert min(s[i] for i, _, _ in toxic) > max(s[i] for i, _, _ in base)
    # inflected forms share the evidence
    new = llm.createDataFrame([(1, "what blockheads they are"), (2, "what gardens they are"), (3, None)],
                              "doc_id long, text string")
    t = {r["doc_id"]: r["score"] for r in T.score(new, model).collect()}
    assert t[1] > t[2] and t[3] == T.Scorer(model).score([""])[0]


def test_bound_on_runs_prunes_the_rarest(llm):
    rows = [(i, " ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j % 26)}word" for j in range(20)), i % 2)
            for i in range(80)]
    docs = llm.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    whole, small = (T.fit(docs, labels, train=F.lit(True), max_runs=m) for m in (1 << 20, 100))
    assert len(small.keys) < len(whole.keys) and len(small.keys) <= 100 + 40
    assert np.isfinite(T.ratios(small, ["waaword", "unseen"])).all()


@pytest.mark.parametrize("order", [3, 6])
def test_runs_beyond_the_bound_count_as_those_that_travel(llm, order):
    rng = random.Random(order)
    made = ["".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    rows = []
    for i in range(240):
        own = [w for j, w in enumerate(made) if j % 2 == i % 2 or j % 5 == 0]
        rows.append((i, " ".join(rng.choice(own) for _ in range(25)), i % 2))
    docs = llm.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    whole, small = (T.fit(docs, labels, train=F.lit(True), max_runs=m, order=order) for m in (1 << 20, 60))
    table = {r["run"]: r for r in small.table.collect()}
    assert len(table) == len(whole.keys) > len(small.keys) and whole.table is None
    for k in range(1, order + 1):
        runs = [g for g in table if len(g) == k]
        at = T._find(whole, T._row_hashes(T._codes(runs, k)))
        assert (at >= 0).all()
        assert whole.ratio[at] == pytest.approx([table[g]["ratio"] for g in runs], rel=1e-4, abs=1e-4)
        assert whole.backoff[at] == pytest.approx([table[g]["backoff"] for g in runs], rel=1e-4, abs=1e-4)
    # words and letters that no training text has, one word of great length, rows that repeat
    extra = [(900, made[0] * 3000), (901, "zzz qüx " + made[1] + "x " + "cab" * 7), (901, made[3]), (901, made[3]),
             (None, " ".join(made[:40])), (902, None), (903, "12 ..."), (904, "x".join(made[:9]))]
    probe = docs.limit(50).union(llm.createDataFrame(extra, "doc_id long, text string"))
    want, got = (sorted((r["doc_id"] or -1, r["score"]) for r in T.score(probe, m).collect())
                 for m in (whole, small))
    assert [i for i, _ in got] == [i for i, _ in want] and len({round(s, 6) for _, s in want}) > 20
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-4)


def test_odd_rows_empty_tables_and_missing_classes(llm, odd, empty):
    labels = llm.createDataFrame(
        [(1, 1), (4, 0), (5, 1), (None, 1), (7, None), (8, 0), (3, 0), (3, 1)], "doc_id long, toxic int")
    for docs in (odd, empty):
        model = T.fit(docs, labels)
        assert T.score(docs, model).count() == docs.count()
    none = T.fit(odd, labels.limit(0))
    assert {r["score"] for r in T.score(odd, none).collect()} == {0.5}
    assert T.score(odd, none).columns == ["doc_id", "score"]
