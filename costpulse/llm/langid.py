"""Language identification by nearest centroid.

A text becomes the vector of its character 1- to 3-gram counts (letters lower-cased in A-Z,
everything that is no letter one space, grams hashed into ``DIM`` slots), weighted by
tf-idf with tf = 1 + ln(count) and normalised. Each language has up to ``CENTROIDS`` centroids found
by spherical k-means, and a text gets the language of the centroid with the largest cosine.
The cosine is the score. Distance-based rejection: a text whose cosine lies below that of
all but a ``REJECT`` share of the training texts of its nearest language is marked ``rejected``.

Document frequencies are counted over all training rows in one distributed pass. The k-means
runs on a bounded sample (``PER_LANG`` texts a language, ``MAX_BYTES`` in all, of which
every language has its share). Null text or text
without a letter is ``und`` with score 0, as is every text when there is nothing to learn from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import bounded_sample
from costpulse.llm.textarrays import utf8

DIM = 8192
CENTROIDS = 4
PER_LANG = 400
MAX_BYTES = 16 << 20
ROUNDS = 12
REJECT = 0.005
FOLDS, HELD = 5, 0
UNKNOWN = "und"
BYTES_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 256

_CLASS = np.zeros(256, np.uint8)                 # 0: no letter
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27 + np.arange(128) % 100         # bytes of other letters


def _grams(part: np.ndarray, offsets: np.ndarray):
    """(text number, slot) of every 1-, 2- and 3-gram of consecutive texts."""
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    codes = _CLASS[part].astype(np.uint32)
    if len(codes) > 1:                           # runs of non-letters count as one space
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == 0) & (codes[:-1] == 0) & (text_of[1:] == text_of[:-1])
        codes, text_of = codes[~again], text_of[~again]
    one = codes * np.uint32(0x9E3779B1)
    out = [(text_of, one)]
    for n in (2, 3):
        if len(codes) < n:
            break
        key = (out[-1][1][:-1] ^ np.uint32(0x85EBCA6B * n & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) \
            + one[n - 1:]
        out.append((text_of[:len(key)], key))
    for n, (owner, key) in enumerate(out):
        same = owner == text_of[n:n + len(owner)] if n else slice(None)
        slot = (key ^ (key >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield owner[same], slot[same] >> np.uint32(32 - DIM.bit_length() + 1)


def counts(column):
    """Yields (first row, matrix of gram counts) for blocks of rows of an Arrow string column."""
    data, offsets = utf8(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + BYTES_AT_ONCE, "right")) - 1
        end = min(max(at + 1, end), at + ROWS_AT_ONCE, n)
        out = np.zeros((end - at) * DIM, np.float32)
        if end == at + 1:                        # one text of any length, in slices
            pieces = range(int(offsets[at]), int(offsets[end]), BYTES_AT_ONCE)
            for p in pieces:
                part = data[p:min(p + BYTES_AT_ONCE + 2, offsets[end])]
                for _, slot in _grams(part, np.array([0, len(part)])):
                    out += np.bincount(slot, minlength=DIM)
        else:
            for owner, slot in _grams(data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]):
                out += np.bincount(owner * DIM + slot, minlength=len(out))
        yield at, out.reshape(end - at, DIM)
        at = end


@dataclass(frozen=True)
class Model:
    langs: list          # language of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray   # cosine below which a text nearest to the centroid's language is rejected

    def vectors(self, matrix: np.ndarray) -> np.ndarray:
        v = np.where(matrix > 0, 1 + np.log(np.maximum(matrix, 1)), 0).astype(np.float32) * self.idf
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def nearest(self, matrix: np.ndarray):
        cosines = self.vectors(matrix) @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, np.clip(cosines[np.arange(len(best)), best], 0, 1)


def _frequencies(batches):
    df, rows = np.zeros(DIM, np.int64), 0
    for b in batches:
        for _, matrix in counts(b.column(0)):
            df += (matrix > 0).sum(axis=0)
            rows += len(matrix)
    slots = np.append(np.arange(DIM), -1)        # slot -1: number of texts
    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.append(df, rows))], ["slot", "n"])


def _kmeans(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the mean and the texts farthest from what is chosen."""
    centres = [v.mean(axis=0)]
    while len(centres) < min(k, len(v)):
        unit = np.array([c / max(np.linalg.norm(c), 1e-12) for c in centres])
        centres.append(v[(v @ unit.T).max(axis=1).argmin()])
    c = np.array([x / max(np.linalg.norm(x), 1e-12) for x in centres])
    for _ in range(ROUNDS):
        own = (v @ c.T).argmax(axis=1)
        for i in range(len(c)):
            if (own == i).any():
                m = v[own == i].sum(axis=0)
                c[i] = m / max(np.linalg.norm(m), 1e-12)
    return c


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", per_lang: int = PER_LANG,
        max_bytes: int = MAX_BYTES) -> Model | None:
    """Learn from every row given (rows with a null language or text are ignored)."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text"))
    found = (rows.select("_text").mapInArrow(_frequencies, "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).collect())    # DIM + 1 rows
    n = dict((r["slot"], r["n"]) for r in found)
    total = n.pop(-1, 0)
    sample = bounded_sample(rows, "_lang", "_text", per_lang, max_bytes)
    if not sample:
        return None
    df = np.array([n.get(i, 0) for i in range(DIM)], np.float64)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    blank = Model([], np.zeros((0, DIM), np.float32), idf, np.zeros(0))
    langs, centres, floors = [], [], []
    for name in sorted({r[0] for r in sample}):
        texts = pa.array([r[2] for r in sample if r[0] == name], pa.string())
        v = np.concatenate([blank.vectors(m) for _, m in counts(texts)])
        c = _kmeans(v, CENTROIDS).astype(np.float32)
        floor = float(np.quantile((v @ c.T).max(axis=1), REJECT))
        langs += [name] * len(c)
        floors += [floor] * len(c)
        centres.append(c)
    return Model(langs, np.concatenate(centres), idf, np.array(floors))


def _predict(model: Model | None, text_at: int):
    def run(batches):
        for b in batches:
            texts = b.column(text_at)
            lang, score, rejected = [], [], []
            if model is None:
                lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            else:
                letters = b.column(text_at + 1).to_pylist()
                for at, matrix in counts(texts):
                    best, cos = model.nearest(matrix)
                    for i, (k, c) in enumerate(zip(best.tolist(), cos.tolist())):
                        known = letters[at + i]
                        lang.append(model.langs[k] if known else UNKNOWN)
                        score.append(c if known else 0.0)
                        rejected.append(not known or c < model.floors[k])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], [b.schema.names[0], "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, rejected) of every row; only the text is an input."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"),
                       F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(_predict(model, 1),
                           f"`{key}` {kind}, lang_pred string, score double, rejected boolean")
