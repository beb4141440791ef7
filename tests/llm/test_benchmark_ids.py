"""Benchmark items with a null id or an id that is no number."""

from __future__ import annotations

import pytest

from costpulse.llm import decontam

TEXTS = ["one two three four five six seven", "red orange yellow green blue indigo violet"]


@pytest.mark.parametrize("kind,ids", [("long", (None, 4)), ("string", (None, "mmlu/17")), ("int", (None, 4))])
def test_items_of_any_id_are_found(llm, kind, ids):
    bench = llm.createDataFrame([*zip(ids, TEXTS), (ids[0], TEXTS[0])], f"item_id {kind}, text string")
    docs = llm.createDataFrame([(n, f"begin {t} end") for n, t in enumerate([*TEXTS, "nothing of the kind"])],
                               "doc_id long, text string")
    found = decontam.leaks(docs, bench)
    assert found.schema["item_id"].dataType == bench.schema["item_id"].dataType
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(0, ids[0]), (1, ids[1])]
    assert [r["doc_id"] for r in decontam.decontaminated(docs, bench).collect()] == [2]
