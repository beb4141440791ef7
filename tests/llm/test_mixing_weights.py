"""Mixes against the weights as given, over many periods and sources."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest

from costpulse.llm import mixing


def deviation(blocks, weights, phase):
    """Largest distance in blocks of any source from its given share, over the slots of a phase."""
    total = sum(weights[s] for s in phase.first)
    order = sorted((phase.slot_of(s, b), s) for s, f in phase.first.items()
                   for b in range(f, f + phase.used(s, phase.length)))
    assert [t for t, _ in order] == list(range(phase.slot, phase.slot + phase.length))
    worst, got = Fraction(0), dict.fromkeys(phase.first, 0)
    for t, (_, s) in enumerate(order):         # a source is farthest off just before and after its slots
        worst = max(worst, weights[s] * t / total - got[s])
        got[s] += 1
        worst = max(worst, got[s] - weights[s] * (t + 1) / total)
    return max([worst, *(abs(weights[s] * len(order) / total - n) for s, n in got.items())])


@pytest.mark.parametrize("weights", [
    *(dict.fromkeys((f"s{i}" for i in range(n)), 1.0) for n in (11, 13, 17, 19)),
    {"a": 0.67, "b": 0.23, "c": 0.10}, {"a": 1 / 3, "b": 0.1234567, "c": 2.0},
    {"a": 1.0, "b": 1e-6}, {f"s{i:04}": 1.0 + i % 7 for i in range(3000)}])
def test_deviation_from_the_given_weights(weights):
    blocks = {s: max(1, int(30000 * w / sum(weights.values()))) + n % 3 for n, (s, w) in enumerate(weights.items())}
    plan = mixing.phases(blocks, weights)
    written = {s: Fraction(str(w)) for s, w in weights.items()}
    assert plan[0].length > 10000 or len(weights) < 3 or len(weights) > 2520
    for phase in plan[:4]:
        assert deviation(blocks, written, phase) < 1
    assert sum(p.length for p in plan) == sum(blocks.values())


def test_mix_keeps_the_given_weights(llm):
    random.seed(2)
    weights = {"a": 0.67, "b": 0.23, "c": 0.10}
    rows = [(i, s) for i, s in enumerate(random.choices(list(weights), weights.values(), k=30000))]
    out = mixing.mix(llm.createDataFrame(rows, "doc_id long, source string"), weights, block=2)
    out = out.orderBy("mix_position").collect()
    assert [r["mix_position"] for r in out] == list(range(len(rows)))
    got = dict.fromkeys(weights, 0)
    order = dict((r["mix_slot"], r["source"]) for r in out if r["mix_phase"] == 0)
    assert len(order) > 12000
    for t, slot in enumerate(sorted(order), 1):
        got[order[slot]] += 1
        assert all(abs(Fraction(str(w)) * t - got[s]) < 1 for s, w in weights.items())


def test_weights_must_be_positive():
    with pytest.raises(ValueError):
        mixing.phases({"a": 1, "b": 1}, {"a": 1.0, "b": 0.0})
