"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained, one from documents labelled 1 and one from documents labelled
0. A text is cut into pieces of ``PIECE`` bytes, every piece is compressed with either
dictionary, and the normalised difference

    d = (size with the bad dictionary - size with the good one) / (sum of both)

over the whole text says which kind it resembles. A logistic curve fitted on other labelled
documents turns d into the score, the probability of label 1. Empty and null texts have d = 0.

Fitting uses a bounded sample (``PER_LABEL`` rows of each label, ``MAX_BYTES`` of text);
how often each label occurs is counted over all labelled rows, and every text is scored whole.
An id labelled both 0 and 1 is left out of the fit. Without documents of both labels the
score is the share of label 1 (0.5 if there are no labels).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import bounded_sample, fold

PIECE = 1024
LEVEL = 3
DICT_BYTES = 48 << 10
PER_LABEL = 1500
MAX_BYTES = 24 << 20
FOLDS, HELD = 3, 1


@dataclass(frozen=True)
class Model:
    """Dictionary contents and the calibration score = sigmoid(slope * d + intercept)."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


class Scorer:
    """Compressors of a model; one per task."""

    def __init__(self, model: Model):
        self.model = model
        self.pair = [zstandard.ZstdCompressor(dict_data=self._dict(d), write_content_size=False)
                     if d else None for d in (model.good, model.bad)]

    @staticmethod
    def _dict(data: bytes):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        return d

    def difference(self, text: str | None) -> float:
        pieces = _pieces(text)
        if not pieces or None in self.pair:
            return 0.0
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.pair)
        return (bad - good) / (bad + good)

    def score(self, text: str | None) -> float:
        x = self.model.slope * self.difference(text) + self.model.intercept
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def _dictionary(texts: list[str]) -> bytes:
    """A dictionary of the texts' pieces; raw content where there is too little to train on."""
    pieces = [p for t in texts for p in _pieces(t) if len(p) >= 16]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(pieces)[-DICT_BYTES:]


def _logistic(d: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on d by Newton steps, with a small ridge on the slope."""
    scale = max(float(d.std()), 1e-9)
    x = np.column_stack([d / scale, np.ones(len(d))])
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-6]) * w.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge @ beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, grad)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality", per_label: int = PER_LABEL, max_bytes: int = MAX_BYTES,
        train=None) -> Model:
    """Fit on the labelled documents for which the boolean column ``train`` (default: outside
    the held-out fold) holds. Null ids, texts and labels are ignored."""
    train = (fold(key, FOLDS) != HELD) if train is None else train
    marks = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).filter(train)
             .groupBy(key).agg(F.min(label).alias("_lo"), F.max(label).alias("_y"))
             .filter("_lo = _y").select(key, "_y"))
    rows = docs.filter(train & F.col(text).isNotNull()).select(key, F.col(text).alias("_text"))
    share = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    sample = bounded_sample(rows, "_y", "_text", per_label, max_bytes, marks, key)
    good = [t for y, _, t in sample if y == 1]
    bad = [t for y, _, t in sample if y == 0]
    ones, zeros = share.get(1, 0), share.get(0, 0)
    prior = math.log((ones + 0.5) / (zeros + 0.5))
    if len(good) < 2 or len(bad) < 2:
        return Model(b"", b"", 0.0, prior)
    dictionaries = _dictionary(good[::2]), _dictionary(bad[::2])
    probe = Scorer(Model(*dictionaries, 0.0, 0.0))
    rest = [(probe.difference(t), y, n / k) for part, y, n, k in
            ((good[1::2], 1.0, ones, len(good)), (bad[1::2], 0.0, zeros, len(bad))) for t in part]
    d, y, w = (np.array(c) for c in zip(*rest))
    slope, intercept = _logistic(d, y, w / w.sum() * len(w))
    return Model(*dictionaries, slope, intercept)


def _scores(model: Model, text_at: int, keep_from: float | None):
    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            scores = np.fromiter((scorer.score(t) for t in b.column(text_at).to_pylist()),
                                 np.float64, b.num_rows)
            if keep_from is not None:
                yield b.filter(pa.array(scores >= keep_from))
            else:
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(b.columns) if i != text_at] + [pa.array(scores)],
                    [n for i, n in enumerate(b.schema.names) if i != text_at] + ["score"])
    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, in the order of the input's partitions."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(_scores(model, 1, None), f"`{key}` {kind}, score double")


def accepted(docs: DataFrame, model: Model, text: str = "text", at: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``at``; all columns stay."""
    return docs.mapInArrow(_scores(model, docs.columns.index(text), at), docs.schema)
