"""Recall of the line bands against all pairs just above the threshold."""

from __future__ import annotations

import random

import numpy as np

from costpulse.llm import linededup


def test_bands_meet_pairs_just_above_the_threshold():
    random.seed(4)
    pairs, letters = [], "abcdefghijklmnopqrstuvwxyz "
    while len(pairs) < 4000:
        line = "".join(random.choices(letters, k=100)).strip()
        a, b = line, line[:-11] + "".join(random.choices(letters, k=11)).strip()
        x, y = linededup.shingles(a), linededup.shingles(b)
        if 0.79 < len(x & y) / len(x | y) < 0.83 and len(x & y) >= 0.8 * len(x | y):
            pairs.append((a, b))
    left, right = (linededup.band_keys([p[i] for p in pairs]) for i in (0, 1))
    missed = int((~(left == right).any(axis=0)).sum())
    assert missed <= 2, missed
