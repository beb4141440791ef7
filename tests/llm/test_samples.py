"""Fitting samples with long texts and many labels."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from costpulse.llm import langid, pii, quality
from costpulse.llm.common import bounded_sample

GOOD, BAD = "the river runs past the old mill and the town", "CLICK here buy now cheap $$$ win free"


def first_rank(llm, texts):
    """The text of lowest hash."""
    return llm.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64(F.lit(7), "t")).first()["t"]


def long_first(llm, others, make):
    """A long text that ranks before all ``others``."""
    lot = {make(n) for n in range(40 * len(others))}
    first = first_rank(llm, [*others, *lot])
    assert first in lot
    return first


def varied(words, n):
    random.seed(n)
    return " ".join(random.choices(words.split(), k=40)) + f" {n}"


def test_a_long_text_of_first_rank_is_skipped(llm):
    texts = [(y, varied(w, n)) for y, w in ((1, GOOD), (0, BAD)) for n in range(20)]
    long = long_first(llm, [t for _, t in texts], lambda n: f"{n} " + "long " * 3000)
    rows = llm.createDataFrame([(0, long), *texts], "y int, t string")
    got = bounded_sample(rows, "y", "t", 1500, 12000)
    assert sorted((y, t) for y, _, t in got) == sorted(texts)


def test_every_label_keeps_texts(llm):
    rows = [(f"l{y}", "é" * (50 + 37 * n) + f"{y} {n}") for y in range(60) for n in range(6)]
    got = bounded_sample(llm.createDataFrame(rows, "y string, t string"), "y", "t", 400, 6000)
    assert {y for y, _, _ in got} == {y for y, _ in rows}
    assert sum(len(t.encode()) for _, _, t in got) <= 6000
    assert all(any(own.startswith(t) for y, own in rows if y == label) for label, _, t in got)
    one = llm.createDataFrame([("a", "x" * 500), ("b", "short")], "y string, t string")
    assert [(y, t) for y, _, t in bounded_sample(one, "y", "t", 5, 105)] == [("a", "x" * 100), ("b", "short")]


def test_quality_fit_with_a_long_first_text(llm):
    texts = [(varied(w, n), y) for y, w in ((1, GOOD), (0, BAD)) for n in range(40)]
    long = long_first(llm, [t for t, _ in texts], lambda n: f"{n} " + "long " * 5000)
    rows = [(n, t, y) for n, (t, y) in enumerate([(long, 0), *texts])]
    docs = llm.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fit(docs, docs, max_bytes=24000, train=F.lit(True))
    kept = {r["doc_id"] for r in quality.accepted(docs, model).collect()}
    assert model.good and kept - {0} == {n for n, _, y in rows if y == 1}


def test_language_fit_with_a_long_first_text(llm):
    words = {"en": "the river runs past the old mill", "de": "der Fluss fliesst an der alten Muehle vorbei",
             "fi": "joki virtaa vanhan myllyn ohi kohti kaupunkia"}
    texts = [(y, varied(w, n)) for y, w in words.items() for n in range(12)]
    long = long_first(llm, [t for _, t in texts], lambda n: f"{n} " + "the old mill " * 2000)
    docs = llm.createDataFrame([(n, y, t) for n, (y, t) in enumerate([("en", long), *texts])],
                               "doc_id long, lang string, text string")
    model = langid.fit(docs, max_bytes=20000)
    assert set(model.langs) == set(words)
    got = langid.predict(docs, model).join(docs, "doc_id")
    assert got.filter("lang <> lang_pred").count() == 0


def test_pii_fit_with_a_long_first_text(llm):
    texts = [f"mail a{n}@host{n}.com or call +49 30 1234{n:04d} now" for n in range(30)]
    long = long_first(llm, texts, lambda n: f"{n} " + "nothing here 5 " * 4000)
    docs = llm.createDataFrame([(t,) for t in [long, *texts]], "text string")
    short = llm.createDataFrame([(t,) for t in texts], "text string")
    assert (pii.fit(docs, max_bytes=20000).weights == pii.fit(short, max_bytes=20000).weights).all()
