"""PII, language id, licences, quality, decontamination, chat against plain Python versions."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from costpulse.llm import chat, decontam, langid, licenses, pii, quality, queries
from costpulse.llm.common import fold, table
from tests.conftest import SF_MEDIUM, SF_SMALL

PATTERNS = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 1 and any(int(x) > 255 for x in m.group().split("."))
                    or kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits))
                    or kind == 3 and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    random.seed(3)
    pieces = ["@", ".", "1", "55", "4111111111111111", "+", "-", " ", "a", "(", ")", "a.b@c.d",
              "127.0.0.1", "256", "%", "é", "+49 (30) 123-456", "\n"]
    for _ in range(20000):
        text = "".join(random.choice(pieces) for _ in range(random.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_are_linear_on_hostile_texts():
    for text in ("a" * 300000, "1" * 300000, "1." * 150000, "+1 " * 100000, "1 " * 150000, "@" * 300000):
        pii.base_spans(text)


def test_crf_adds_rewritten_spans_and_leaves_plain_numbers(llm):
    model = pii.fit(table(llm, SF_MEDIUM, "documents"))
    for text, kind in (("mail me at joe at host dot com now", "email"), ("server 10[.]0[.]0[.]7 is up", "ip"),
                       ("pay 4111.1111.1111.1111 now", "card"), ("call 523-555-6688 now", "phone")):
        assert [pii.KINDS[k] for k, _, _ in pii.added_spans(text, pii.base_spans(text), model)] == [kind]
    for text in ("version 1.2.3 of 2024-01-02", "order 123456", "on 12 03 2024 at 10 15", "at the dot"):
        assert not pii.added_spans(text, pii.base_spans(text), model)


def test_crf_marginals_and_viterbi_equal_enumeration():
    rng = np.random.default_rng(0)
    spans = [(0, 2, 0, 2), (1, 3, 1, 3), (2, 4, 2, 4), (0, 4, 0, 4), (3, 4, 3, 4)]
    scores = rng.normal(size=(5, 4))

    def segmentations(t):
        if t >= 4:
            yield []
            return
        for rest in segmentations(t + 1):
            yield rest
        for k, s in enumerate(spans):
            if s[0] == t:
                for rest in segmentations(s[1]):
                    for y in range(4):
                        yield [(k, y), *rest]

    every = list(segmentations(0))
    value = np.array([sum(scores[k, y] for k, y in seg) for seg in every])
    log_z, p = pii.marginals(4, spans, scores)
    assert np.isclose(log_z, np.logaddexp.reduce(value))
    for k in range(5):
        for y in range(4):
            share = np.exp(value[[(k, y) in seg for seg in every]] - log_z).sum()
            assert np.isclose(share, p[k, y])
    best = pii.viterbi(4, spans, scores)
    assert np.isclose(sum(scores[k, y] for k, y in best), max(value.max(), 0))


def test_pii_query(llm, odd, empty):
    rows = {r["doc_id"]: r for r in queries.op2_pii(llm, SF_MEDIUM).collect()}
    for d in table(llm, SF_MEDIUM, "documents").collect():
        base = plain_spans(d["text"])
        named = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        r = rows[d["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(s[0] == k for s in base) for k in range(4)]
        assert not named or set(named.split(",")) <= set(r["spans"].split(","))
    model = pii.fit(empty)
    found = pii.find(odd, model).collect()
    assert len(found) == odd.count() and [r["n_ip"] for r in found if r["doc_id"] == 8] == [1]
    assert pii.find(empty, model).count() == 0


def test_language_id(llm, odd, empty):
    got = queries.op3_language_id(llm, "/root/testdata/sf0.1").alias("g").join(
        table(llm, "/root/testdata/sf0.1", "documents").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out and lang is not null")
    assert held.filter("lang = lang_pred").count() > 0.98 * held.count()
    assert got.filter("score < 0 or score > 1").count() == 0
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (1, 2, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "de", "fr")
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_license_base_equals_plain_search(llm, odd, empty):
    rows = {r["doc_id"]: r for r in queries.op4_license_scan(llm, SF_MEDIUM).collect()}
    for d in table(llm, SF_MEDIUM, "documents").collect():
        words = WORDS.findall(d["text"].lower())
        at = [(i, t.label) for t in licenses.BASE for i in range(len(words))
              if words[i:i + len(t.words)] == t.words]
        r = rows[d["doc_id"]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == (
            (min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    found = licenses.scan(odd, licenses.idf(odd)).select("doc_id", "n_words").collect()
    assert len(found) == odd.count() and [r[1] for r in found if r[0] == 3] == [60000]
    assert licenses.scan(empty, licenses.idf(empty)).count() == 0


def test_license_notices_and_repeats(llm):
    texts = ["x Under THE mit-license, under the MIT license!", "under the old mit license",
             "GNU General Public License, version 3.", "cc-by-nc cc by cc by nc", "mit " * 5000,
             "Redistribution and use in source and binary forms, with or without modification, are allowed"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan(docs, licenses.idf(docs)).select(
        "doc_id", licenses.labels_of(F.col("finds")).alias("l"), F.size("finds").alias("n")).collect()
    got = {r["doc_id"]: (r["l"], r["n"]) for r in rows}
    assert got[0] == ("mit", 2) and got[1] == ("", 0) and got[2] == ("gpl-3", 1)
    assert got[3] == ("cc-by-nc", 2) and got[4] == ("", 0) and got[5] == ("bsd", 1)


def test_quality(llm, odd, empty):
    docs = table(llm, "/root/testdata/sf0.1", "documents")
    labels = table(llm, "/root/testdata/sf0.1", "labels")
    got = queries.op9_quality(llm, "/root/testdata/sf0.1").join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97        # clean documents stay
    assert held[held.quality == 0].predicted.mean() < 0.25
    assert ((got.score >= 0) & (got.score <= 1)).all()
    model = quality.fit(docs, labels)
    scored = quality.score(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.accepted(odd, model, at=0.0).collect() == odd.collect()
    assert quality.accepted(odd, model, at=1.1).count() == 0
    none = quality.fit(empty, labels)
    assert quality.score(empty, none).count() == 0 and 0 < quality.Scorer(none).score("x") < 1


def test_folds(llm):
    rows = llm.range(50).select("id", fold("id", 3).alias("f")).collect()
    import zlib
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MEDIUM])
def test_leaks_equal_exact_containment(llm, sf):
    items = [(r["item_id"], decontam.words_of(r["text"])) for r in table(llm, sf, "benchmark").collect()]
    want = set()
    for d in table(llm, sf, "documents").collect():
        words = decontam.words_of(d["text"])
        for item, w in items:
            n = min(5, len(w))
            s = decontam.shingle_set(w, n)
            shared = len(s & decontam.shingle_set(words, n))
            if shared >= 0.8 * len(s):
                want.add((d["doc_id"], item, shared, len(s)))
    got = queries.op1_decontamination(llm, sf).collect()
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want)


def test_leaks_in_long_documents_and_odd_rows(llm, odd, empty):
    random.seed(5)
    vocabulary = [f"t{i}" for i in range(4000)]
    filler = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, filler(n)) for i, n in enumerate([2, 4, 5, 6, 9, 17, 40, 130, 700])]
    scattered = items[6][1].split()
    docs = [(100 + i, filler(20000) + " Start! " + t.upper().replace(" ", ", ") + " end " + filler(9000))
            for i, t in items]
    docs.append((200, filler(500) + " " + " ".join(scattered[:20]) + " zz " + " ".join(scattered[20:])))
    docs.append((201, filler(500) + " " + " ".join(scattered[:20])))
    bench = llm.createDataFrame(items + [(50, ""), (51, None), (None, "x"), (0, items[0][1])],
                                "item_id long, text string")
    found = decontam.leaks(llm.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert {(100 + i, i) for i, _ in items} <= pairs and (200, 6) in pairs and (201, 6) not in pairs
    assert decontam.leaks(odd, bench).count() == 0
    assert decontam.leaks(empty, bench).count() == 0
    assert decontam.leaks(odd, bench.limit(0)).count() == 0
    assert sorted(map(str, decontam.decontaminated(odd, bench).collect())) == sorted(map(str, odd.collect()))
    clean = decontam.decontaminated(llm.createDataFrame(docs, "doc_id long, text string"), bench)
    assert [r["doc_id"] for r in clean.collect()] == [201]


def test_chat_round_trip_and_machine(llm):
    hostile = [chat.ESC, chat.ESC + "c", chat.ESC + "s", "<|im_start|>", "<|im_end|>\n", "[INST]", "a", "\n",
               "<<SYS>>", "</s>", "\\", "é", "\U0001f600"]
    random.seed(1)
    rows = [(c, t, role, "".join(random.choices(hostile, k=random.randint(0, 6))))
            for c in range(40) for t, role in enumerate(["user", "assistant", "user", "assi\nstant"])]
    rows += [(90, 0, "system", "s"), (90, 1, "user", None), (90, 2, "assistant", "ok"),
             (91, 0, "assistant", "early"), (92, None, None, None), (93, 0, "user", "u"), (93, 0, "user", "u"),
             (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    turns = llm.createDataFrame([(*r, "extra") for r in rows],
                                "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(turns).withColumn("back", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("segments")))
    got = {r["conv_id"]: r for r in made.collect()}
    for c, r in got.items():
        own = sorted(((-1 if t is None else t), role or "", text or "")
                     for k, t, role, text in rows if k == c)
        assert [tuple(x) for x in r["back"]] == [x[1:] for x in own]
        assert r["loss"] == "".join(x[2] for x in own if x[1] == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        for s in r["segments"][1::3]:
            assert not any(x in s["text"] for x in chat.CHATML.controls)
    assert (got[90]["valid"], got[90]["error_turn"]) == (True, None) and got[None]["valid"]
    assert (got[91]["valid"], got[91]["error_turn"]) == (False, 0)
    assert (got[93]["valid"], got[93]["error_turn"]) == (False, 1)
    assert chat.format_conversations(turns.limit(0)).count() == 0
