"""Arrow text columns as flat numpy arrays: bytes, words, shingles and MinHash minima."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE = 1 << 18            # bytes handled at once, so that work arrays stay in cache and small
_RNG = np.random.default_rng(20240601)
_BASE = U64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _tables():
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    lower = np.arange(256)
    lower[65:91] += 32
    value = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)[lower]
    return word, value


IS_WORD, BYTE_VALUE = _tables()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int):
    size = max(SLICE, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        up = np.full(size, _BASE, U64)
        down = np.full(size, inverse, U64)
        up[0] = down[0] = U64(1)
        if size > SLICE:          # a single word longer than a slice: not worth keeping
            return np.cumprod(up), np.cumprod(down)
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text). Words are runs of ASCII letters
    (lower-cased), digits and non-ASCII bytes; slices are cut between words, so texts of any
    length take bounded memory besides the hashes."""
    hashes, starts_all = [], []
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and IS_WORD[data[end]] and IS_WORD[data[end - 1]] and not breaks[end]:
            back = np.flatnonzero(~IS_WORD[data[max(at, end - 4096):end]])
            if len(back) and max(at, end - 4096) + back[-1] > at:
                end = max(at, end - 4096) + int(back[-1])
            else:
                end = min(end + 4096, len(data))
        part = data[at:end]
        is_word, cut = IS_WORD[part], breaks[at:end + 1]
        before = np.empty(len(part), bool)
        before[0] = False
        before[1:] = is_word[:-1]
        first = np.flatnonzero(is_word & (~before | cut[:-1]))
        after = np.empty(len(part), bool)
        after[-1] = False
        after[:-1] = is_word[1:]
        last = np.flatnonzero(is_word & (~after | cut[1:])) + 1
        up, down = _powers(len(part))
        total = np.empty(len(part) + 1, U64)
        total[0] = 0
        np.cumsum(BYTE_VALUE[part] * up[:len(part)], out=total[1:])
        hashes.append(mix((total[last] - total[first]) * down[first]))
        starts_all.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(offsets) - 1, np.int64)
    starts = np.concatenate(starts_all)
    return np.concatenate(hashes), np.diff(np.searchsorted(starts, offsets))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, length: int):
    """(hash of every run of ``length`` words inside one text, number of runs per text)."""
    runs = np.maximum(counts - length + 1, 0)
    if runs.sum() == 0:
        return np.zeros(0, U64), runs
    n = len(words) - length + 1
    acc = np.zeros(n, U64)
    for j in range(length):
        acc = acc * U64(0xD6E8FEB86659FD93) + words[j:j + n]
    text_of = np.repeat(np.arange(len(counts)), counts)
    return mix(acc[text_of[:n] == text_of[length - 1:]]), runs


def permutations(k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` (mask, odd factor) pairs; x -> (x ^ mask) * factor is a bijection on 32 bits."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, k, dtype=np.uint32),
            rng.integers(0, 1 << 31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1))


def minima(values: np.ndarray, starts: np.ndarray, perms) -> np.ndarray:
    """MinHash: for each permutation the minimum over every segment (none may be empty);
    shape (permutations, segments)."""
    masks, factors = perms
    out = np.empty((len(masks), len(starts)), np.uint32)
    step = 1 << 18                      # segments are handled in blocks of about this many values
    edges = np.append(starts, len(values))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + step)) - 1)
        hi = min(hi, len(starts))
        part, local = values[edges[lo]:edges[hi]], starts[lo:hi] - edges[lo]
        work = np.empty(len(part), np.uint32)
        for p in range(len(masks)):
            np.bitwise_xor(part, masks[p], out=work)
            np.multiply(work, factors[p], out=work)
            out[p, lo:hi] = np.minimum.reduceat(work, local)
        lo = hi
    return out
