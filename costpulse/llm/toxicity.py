"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

A toxic and an ordinary model give every word (a run of letters, lower-cased, with its start
and end) a probability, letter after letter, from the up to ``ORDER - 1`` letters before, so
inflected and compound forms of an expression share its evidence. Both models are
interpolated Kneser-Ney: the longest context by its counts, shorter ones by the number of
different letters before them, each class discounted by its own count-of-counts; the last
backoff level is one table of counts shared by both, and a letter run that the shared counts
hold too seldom has no entry in either class, so it is judged by its shorter runs alone.

A document's evidence is the length-normalised difference of the two log-likelihoods: its words'
log ratios above ``MARGIN`` nats, summed and divided by the number of words plus ``PRIOR``. Ratios
below the margin, either sign, are the noise of the smaller class and count as no difference.
A logistic curve fitted on labelled documents outside the count turns it into the score.

Counts cover every labelled training row and grow with them: words by class, then letter runs
of the different words, all added by Spark. Copies of a text count once per label. What
travels to the tasks is bounded by ``MAX_RUNS`` letter runs (16 bytes each). With more, Spark
computes the models order by order over all runs, and only the most frequent runs travel. A
task settles the words they decide (the longest run possible at every letter is among them);
the other words get their ratios by joins with the table of all runs, so both ways give the
same evidence. The calibration collects one row per evidence step and label.

Null and empty texts and those without letters have no evidence and get the score of none. Ids
labelled both ways, null ids and null labels are left out of the fit. Without training
texts of both classes the score is the share of label 1 (0.5 without labels). Repeated rows are
scored each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costpulse.llm.common import cut, fold
from costpulse.llm.quality import _logistic as logistic
from costpulse.llm.textarrays import mix
from costpulse.session import scratch_path

ORDER = 6
MARGIN = 2.0
PRIOR = 50
MAX_RUNS = 3 << 18
FOLDS, HELD = 4, 2
CALIBRATE = 5                  # every fifth training document calibrates
WORDS_AT_ONCE = 200_000        # different words or runs held by a task before it passes them on
STEP = 0.02                    # evidence steps of the calibration
START, END = "\x02", "\x03"
AT = 0.3

_WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


# ------------------------------------------------------------------------ counts on Spark

def _word_counts(batches):
    """(word, toxic, ordinary) of labelled texts; a task hands on what it holds at times."""
    held = (Counter(), Counter())

    def give():
        names = list(held[0].keys() | held[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([held[1][w] for w in names], pa.int64()),
             pa.array([held[0][w] for w in names], pa.int64())], ["word", "toxic", "ordinary"])
        held[0].clear()
        held[1].clear()
        return out

    for b in batches:
        for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held[1 if y == 1 else 0].update(words(text))
            if len(held[0]) + len(held[1]) > WORDS_AT_ONCE:
                yield give()
    if held[0] or held[1]:
        yield give()


def _run_counts(order: int):
    """(run, toxic, ordinary): occurrences of the letter runs of counted words."""
    def run(batches):
        toxic, ordinary = Counter(), Counter()

        def give():
            names = list(toxic.keys() | ordinary.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([toxic[g] for g in names], pa.int64()),
                 pa.array([ordinary[g] for g in names], pa.int64())], ["run", "toxic", "ordinary"])
            toxic.clear()
            ordinary.clear()
            return out

        for b in batches:
            for w, t, o in zip(*(c.to_pylist() for c in b.columns)):
                s = START + w + END
                runs = [s[i:j] for j in range(1, len(s) + 1)
                        for i in range(max(0, j - order), j)]
                for g in runs:
                    if t:
                        toxic[g] += t
                    if o:
                        ordinary[g] += o
                if len(toxic) + len(ordinary) > WORDS_AT_ONCE:
                    yield give()
        if toxic or ordinary:
            yield give()
    return run


def _training(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
              train: Column) -> DataFrame:
    """(key, _y, _text) of labelled training texts, each different text once per label."""
    marks = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).filter(train)
             .groupBy(key).agg(F.min(label).alias("_lo"), F.max(label).alias("_y"))
             .filter("_lo = _y").select(key, (F.col("_y") == 1).cast("int").alias("_y")))
    rows = docs.filter(train & F.col(text).isNotNull()).select(
        key, F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(23), "_text"))
    picks = (rows.select(key, "_h").join(marks, key).groupBy("_h", "_y")
             .agg(F.min(key).alias(key)))
    # a repeated row (same id, same text) would come twice
    return rows.join(picks, [key, "_h"]).select(key, "_h", "_y", "_text")


# ------------------------------------------------------------------------ models

def _hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 1..order the 64-bit hashes of the runs of k codes that end at each place (the
    first k - 1 places of an array have none that is meaningful)."""
    value = codes.astype(np.uint64) + np.uint64(1)
    out, h = [], np.zeros(len(codes), np.uint64)
    for k in range(1, order + 1):
        before = np.zeros(len(codes), np.uint64)
        if k > 1:
            before[1:] = h[:-1]
        h = before * _BASE + mix(value * np.uint64(0xD6E8FEB86659FD93))
        out.append(mix(h ^ np.uint64(k << 56)))
    return out


def _codes(runs: list[str], k: int) -> np.ndarray:
    """(runs, k) code points of runs of length ``k``."""
    text = "".join(runs).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(text, np.uint32).reshape(-1, k)


def _row_hashes(codes: np.ndarray) -> np.ndarray:
    k = codes.shape[1]
    return _hashes(np.ascontiguousarray(codes).reshape(-1), k)[k - 1][k - 1::k]


@dataclass(frozen=True)
class Model:
    """Log ratios (toxic over ordinary) of letter runs and of the backoff below them, by the
    sorted hash of the run, and the calibration. ``table`` has all runs (run, ratio, backoff)
    where the arrays hold the most frequent ones only."""

    keys: np.ndarray
    ratio: np.ndarray
    backoff: np.ndarray
    bottom: float              # backoff ratio of the empty context
    slope: float = 0.0
    intercept: float = 0.0
    order: int = ORDER
    table: DataFrame | None = None


def _discount(one: int, two: int) -> float:
    """From the numbers of runs counted once and twice."""
    return min(0.95, max(0.4, one / (one + 2 * two))) if one else 0.5


def kneser_ney(runs: list[str], raw: np.ndarray, before: np.ndarray, order: int = ORDER) -> Model:
    """Models from letter runs with their counts ``raw`` (runs, 2) by class (ordinary, toxic) and
    the numbers ``before`` of different letters before them. Runs of the full order and those
    at a word's start use ``raw``, the others ``before``."""
    length = np.fromiter(map(len, runs), np.int64, len(runs))
    starts = np.fromiter((g[0] == START for g in runs), bool, len(runs))
    counts = np.where(((length == order) | starts)[:, None], raw, before).astype(np.float64)
    counts[starts & (length == 1)] = 0          # a context only: a start is never predicted
    by_order = [np.flatnonzero(length == k) for k in range(order + 1)]
    codes = [None] + [_codes([runs[i] for i in at], k) for k, at in enumerate(by_order[1:], 1)]
    keys = np.zeros(len(runs), np.uint64)
    for k in range(1, order + 1):
        keys[by_order[k]] = _row_hashes(codes[k])

    def find(part: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Index of the run with the codes of each row of ``part``, -1 for none."""
        wanted, ranked = _row_hashes(part), among[np.argsort(keys[among])]
        at = np.minimum(np.searchsorted(keys[ranked], wanted), len(ranked) - 1)
        return np.where(keys[ranked[at]] == wanted, ranked[at], -1) if len(ranked) \
            else np.full(len(wanted), -1)

    prob = np.zeros((len(runs), 2))
    total, kinds = np.zeros((len(runs), 2)), np.zeros((len(runs), 2))
    gamma = np.ones((len(runs), 2))
    ones = by_order[1]
    pooled = counts[ones].sum()
    bottom = 0.0
    for k in range(1, order + 1):
        at = by_order[k]
        if not len(at):
            continue
        c = counts[at]
        d = np.array([_discount(int((c[:, y] == 1).sum()), int((c[:, y] == 2).sum()))
                      for y in (0, 1)])
        if k == 1:
            n, kind = c.sum(axis=0), (c > 0).sum(axis=0)
            low = ((c.sum(axis=1) + 1) / (pooled + len(at) + 1))[:, None]
            g = np.where(n > 0, d * kind / np.maximum(n, 1), 1.0)
            prob[at] = np.where(n > 0, np.maximum(c - d, 0) / np.maximum(n, 1), 0) + g * low
            bottom = float(np.log(g[1]) - np.log(g[0]))
            continue
        context = find(codes[k][:, :-1], by_order[k - 1])
        lower = find(codes[k][:, 1:], by_order[k - 1])
        known = context >= 0
        np.add.at(total, context[known], c[known])
        np.add.at(kinds, context[known], (c > 0)[known])
        n, kind = total[context], kinds[context]
        n[~known], kind[~known] = 0, 0
        g = np.where(n > 0, d * kind / np.maximum(n, 1), 1.0)
        prob[at] = (np.where(n > 0, np.maximum(c - d, 0) / np.maximum(n, 1), 0)
                    + g * prob[lower])
        gamma[context[known]] = g[known]
    by_key = np.argsort(keys)
    ratio = np.log(np.maximum(prob[:, 1], 1e-300)) - np.log(np.maximum(prob[:, 0], 1e-300))
    backoff = np.log(gamma[:, 1]) - np.log(gamma[:, 0])
    return Model(keys[by_key], ratio[by_key].astype(np.float32),
                 backoff[by_key].astype(np.float32), bottom, order=order)


def _kept(df: DataFrame) -> DataFrame:
    """``df`` materialised like ``cut``, but compressed: rows of runs and words are many and short."""
    path = scratch_path(df.sparkSession, "toxicity")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _probabilities(runs: DataFrame, longer: DataFrame, order: int) -> tuple[DataFrame, float]:
    """``kneser_ney`` over any number of runs: (run, often, ratio, backoff) of each, and the bottom.
    A run's share of its context needs the runs of that context only, its lower
    probability is that of the run without its first letter, one order below."""
    size = F.length("run")
    whole = (size == order) | F.startswith("run", F.lit(START))
    counted = _kept(runs.join(longer, "run", "left").select(
        "run", size.alias("k"), (F.col("toxic") + F.col("ordinary")).alias("often"),
        *(F.when(F.col("run") == START, 0).when(whole, F.col(raw))
          .otherwise(F.coalesce(before, F.lit(0))).cast("long").alias(c)
          for c, raw, before in (("c0", "ordinary", "bo"), ("c1", "toxic", "bt")))))

    def times(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    level = {r["k"]: r for r in counted.groupBy("k").agg(
        F.count("*").alias("runs"),
        *(a.alias(f"{name}{y}") for y in (0, 1) for c in [F.col(f"c{y}")] for name, a in (
            ("n", F.sum(c)), ("kinds", times(c > 0)), ("one", times(c == 1)),
            ("two", times(c == 2))))).collect()}
    d = {k: [_discount(r[f"one{y}"], r[f"two{y}"]) for y in (0, 1)] for k, r in level.items()}
    ones = level[1]
    low = (F.col("c0") + F.col("c1") + 1) / (ones["n0"] + ones["n1"] + ones["runs"] + 1)
    rest = [d[1][y] * ones[f"kinds{y}"] / ones[f"n{y}"] if ones[f"n{y}"] else 1.0 for y in (0, 1)]
    bottom = math.log(rest[1]) - math.log(rest[0])

    def share(y: int, cut_off: Column, n: Column) -> Column:
        return F.when(n > 0, F.greatest(F.col(f"c{y}") - cut_off, F.lit(0.0)) / n).otherwise(0.0)

    context = Window.partitionBy("context")
    by_order = F.create_map(*(F.lit(x) for k, pair in d.items() for x in (10 * k, pair[0], 10 * k + 1, pair[1])))
    parts = counted.filter("k > 1").withColumn("context", F.expr("substr(run, 1, k - 1)"))
    for y in (0, 1):
        c = F.col(f"c{y}")
        parts = parts.withColumns({f"n{y}": F.sum(c).over(context),
                                   f"kinds{y}": times(c > 0).over(context),
                                   f"d{y}": by_order[F.col("k") * 10 + y]})
    parts = _kept(parts.select(
        "run", "k", "often", "context", *(x for y in (0, 1) for n in [F.col(f"n{y}")] for x in (
            share(y, F.col(f"d{y}"), n).alias(f"a{y}"),
            F.when(n > 0, F.col(f"d{y}") * F.col(f"kinds{y}") / n).otherwise(1.0).alias(f"g{y}")))))
    below = counted.filter("k = 1").select("run", "often", *(
        (share(y, F.lit(d[1][y]), F.lit(float(ones[f"n{y}"]))) + rest[y] * low).alias(f"p{y}")
        for y in (0, 1)))
    every = [below]
    for k in range(2, order + 1):
        lower = below.select(F.col("run").alias("lower"), F.col("p0").alias("l0"), F.col("p1").alias("l1"))
        below = _kept(parts.filter(F.col("k") == k).withColumn("lower", F.expr("substr(run, 2)"))
                    .join(lower, "lower").select("run", "often", *(
                        (F.col(f"a{y}") + F.col(f"g{y}") * F.col(f"l{y}")).alias(f"p{y}") for y in (0, 1))))
        every.append(below)
    table = every[0]
    for one in every[1:]:
        table = table.union(one)
    least = F.lit(1e-300)
    backoffs = parts.groupBy(F.col("context").alias("run")).agg(
        F.max(F.log("g1") - F.log("g0")).alias("backoff"))
    return _kept(table.join(backoffs, "run", "left").select(
        "run", "often", (F.log(F.greatest("p1", least)) - F.log(F.greatest("p0", least))).alias("ratio"),
        F.coalesce("backoff", F.lit(0.0)).alias("backoff"))), bottom


def _frequent(table: DataFrame, least: int, bottom: float, order: int) -> Model:
    """The runs that occur ``least`` times and all letters as a model, beside the whole table."""
    few = (table.filter((F.col("often") >= least) | (F.length("run") == 1))
           .select("run", "ratio", "backoff").toArrow())
    runs = few.column("run").to_pylist()
    length = np.fromiter(map(len, runs), np.int64, len(runs))
    keys = np.zeros(len(runs), np.uint64)
    for k in range(1, order + 1):
        at = np.flatnonzero(length == k)
        if len(at):
            keys[at] = _row_hashes(_codes([runs[i] for i in at], k))
    by_key = np.argsort(keys)
    ratio, backoff = (few.column(c).to_numpy()[by_key].astype(np.float32) for c in ("ratio", "backoff"))
    return Model(keys[by_key], ratio, backoff, bottom, order=order,
                 table=table.select("run", "ratio", "backoff"))


def _find(model: Model, wanted: np.ndarray) -> np.ndarray:
    """Index of every key, -1 where there is none."""
    at = np.minimum(np.searchsorted(model.keys, wanted), len(model.keys) - 1)
    return np.where(model.keys[at] == wanted, at, -1)


def _by_letter(model: Model, names: list[str]) -> tuple:
    """Of marked words one after the other: the first place of each, the log ratio of every letter,
    and whether the longest run possible there is in the model (a larger one agrees)."""
    marked = [START + w + END for w in names]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(codes)) - np.repeat(first, sizes)
    hashes = _hashes(codes, model.order)
    value = np.zeros(len(codes))
    sure = inside == 0
    open_ = np.flatnonzero(inside > 0)          # a word's start is given, not predicted
    for k in range(model.order, 0, -1):
        able = inside[open_] >= k - 1
        at = open_[able]
        hit = _find(model, hashes[k - 1][at])
        found = hit >= 0
        value[at[found]] += model.ratio[hit[found]]
        sure[at[found]] = np.minimum(inside[at[found]] + 1, model.order) == k
        miss = at[~found]
        if k > 1:
            context = _find(model, hashes[k - 2][miss - 1])
            value[miss] += np.where(context >= 0, model.backoff[context], 0.0)
        else:
            value[miss] += model.bottom
        open_ = np.concatenate([open_[~able], miss])
    return first, value, sure


def ratios(model: Model, names: list[str]) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of non-empty words, by the runs in the arrays."""
    if not len(model.keys) or not names:
        return np.zeros(len(names))
    first, value, _ = _by_letter(model, names)
    return np.add.reduceat(value, first)


class Scorer:
    """Evidence of texts; one per task. Ratios of words are kept, within a bound; with
    ``partial`` the words that the model doesn't decide are left ``open`` and add nothing."""

    def __init__(self, model: Model, partial: bool = False):
        self.model = model
        self.partial = partial
        self.known: dict[str, float] = {}
        self.open: set[str] = set()

    def _over(self, names: list[str]) -> np.ndarray:
        if not self.partial:
            return np.maximum(ratios(self.model, names) - MARGIN, 0.0)
        first, value, sure = _by_letter(self.model, names)
        decided = np.logical_and.reduceat(sure, first)
        self.open.update(names[i] for i in np.flatnonzero(~decided).tolist())
        return np.where(decided, np.maximum(np.add.reduceat(value, first) - MARGIN, 0.0), 0.0)

    def _words(self, texts: list) -> list[list[str]]:
        parts = [words(t) for t in texts]
        fresh = list({w for ws in parts for w in ws if w not in self.known})
        if len(self.known) + len(fresh) > 2 * WORDS_AT_ONCE:
            self.known.clear()
            self.open.clear()
            fresh = list({w for ws in parts for w in ws})
        for lo in range(0, len(fresh), 20_000):
            some = fresh[lo:lo + 20_000]
            self.known.update(zip(some, self._over(some).tolist()))
        return parts

    def evidence(self, texts: list) -> np.ndarray:
        parts, known = self._words(texts), self.known
        return np.array([sum(map(known.__getitem__, ws)) / (len(ws) + PRIOR) for ws in parts])

    def parts(self, texts: list) -> list[tuple[int, float, Counter]]:
        """Of each text its words, what the decided ones add, and the others."""
        return [(len(ws), float(sum(map(self.known.__getitem__, ws))),
                 Counter(filter(self.open.__contains__, ws))) for ws in self._words(texts)]

    def score(self, texts: list) -> np.ndarray:
        x = self.model.slope * curve(self.evidence(texts)) + self.model.intercept
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def curve(evidence: np.ndarray) -> np.ndarray:
    return np.log1p(100 * evidence)


def _steps(model: Model):
    def run(batches):
        scorer = Scorer(model)
        for b in batches:
            if b.num_rows:
                step = np.round(curve(scorer.evidence(b.column(1).to_pylist())) / STEP)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(step.astype(np.int32))], ["y", "step"])
    return run


# ------------------------------------------------------------------------ more runs than travel

def _split_texts(sent, keep: str):
    """(_id, kept column, _n, _near, _left): words, what the decided ones add, the others."""
    def run(batches):
        scorer = Scorer(sent.value, partial=True)
        for b in batches:
            if b.num_rows:
                n, near, left = zip(*scorer.parts(b.column(2).to_pylist()))
                ends = np.cumsum([0, *map(len, left)])
                pairs = pa.StructArray.from_arrays(
                    [pa.array([w for ws in left for w in ws], pa.string()),
                     pa.array([c for ws in left for c in ws.values()], pa.int64())], ["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(near, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
                    ["_id", keep, "_n", "_near", "_left"])
    return run


def _open_places(sent):
    """(w, sure, run, times): for the undecided letters of words the longest runs possible there;
    a word's first row has what its decided letters add."""
    def run(batches):
        model = sent.value
        for b in batches:
            ids, names = b.column(0).to_numpy(), b.column(1).to_pylist()
            for lo in range(0, len(names), 5000):
                some = names[lo:lo + 5000]
                first, value, sure = _by_letter(model, some)
                decided = np.add.reduceat(np.where(sure, value, 0.0), first)
                text = "".join([START + w + END for w in some])
                at = np.flatnonzero(~sure)
                word = np.searchsorted(first, at, "right") - 1
                begin = np.maximum(at + 1 - model.order, first[word])
                runs = Counter(zip(word.tolist(), (text[i:j + 1] for i, j in zip(begin.tolist(), at.tolist()))))
                word = np.fromiter((w for w, _ in runs), np.int64, len(runs))
                leads = np.diff(word, prepend=-1) > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + word]), pa.array(np.where(leads, decided[word], 0.0)),
                     pa.array([g for _, g in runs], pa.string()),
                     pa.array(list(runs.values()), pa.int64())], ["w", "sure", "run", "times"])
    return run


def _run_ratios(runs: DataFrame, model: Model) -> DataFrame:
    """(run, value): the log ratio of the last letter of each run after the others. A run that
    the table lacks has that of its longest suffix there, and the backoffs above it."""
    looked = _kept(runs.join(model.table.select("run", "ratio"), "run", "left"))
    lacking = looked.filter("ratio is null").select(
        F.col("run").alias("of"), F.explode(F.expr("sequence(1, length(run))")).alias("k"))
    parts = lacking.withColumn("suffix", F.expr("right(of, k)")).select("of", "k", F.explode(F.expr(
        "array(named_struct('own', true, 'run', suffix),"
        " named_struct('own', false, 'run', substr(suffix, 1, k - 1)))")).alias("part")).select(
        "of", "k", "part.own", "part.run").filter("run not in ('', of)")
    found = (parts.join(model.table, "run").groupBy(F.col("of").alias("run")).agg(
        F.max(F.when(F.col("own"), F.struct("k", "ratio"))).alias("best"),
        F.collect_list(F.when(~F.col("own"), F.struct("k", "backoff"))).alias("above")))
    backed = found.select("run", (F.coalesce("best.ratio", F.lit(model.bottom)) + F.expr(
        "aggregate(filter(above, x -> x.k > coalesce(best.k, 0)), 0d, (s, x) -> s + x.backoff)")).alias("backed"))
    return looked.join(backed, "run", "left").select(
        "run", F.coalesce("ratio", "backed", F.lit(model.bottom)).alias("value"))


def _evidence(rows: DataFrame, keep: str, text: str, model: Model) -> DataFrame:
    """(keep, evidence) of every row by all runs of ``model.table``."""
    slim = rows.select(F.monotonically_increasing_id().alias("_id"), F.col(keep), F.col(text).alias("_text"))
    kind = slim.schema[keep].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(replace(model, table=None))
    split = _kept(slim.mapInArrow(
        _split_texts(sent, keep),
        f"_id long, `{keep}` {kind}, _n long, _near double, _left array<struct<word:string,times:long>>"))
    left = split.select("_id", F.explode("_left").alias("_w")).select("_id", "_w.word", "_w.times")
    names = _kept(left.select("word").distinct()
                  .select(F.monotonically_increasing_id().alias("w"), "word"))
    places = _kept(names.mapInArrow(_open_places(sent), "w long, sure double, run string, times long"))
    ratio = _run_ratios(places.select("run").distinct(), model)
    over = places.join(ratio, "run").groupBy("w").agg(
        (F.sum(F.col("sure") + F.col("times") * F.col("value")) - MARGIN).alias("over")).filter("over > 0")
    over = _kept(over.join(names, "w").select("word", "over"))
    # few words are sent to the rows, so a common one needs no task of its own
    over = F.broadcast(over) if over.count() <= WORDS_AT_ONCE else over
    more = left.join(over, "word").groupBy("_id").agg(F.sum(F.col("times") * F.col("over")).alias("_more"))
    return split.join(more, "_id", "left").select(keep, (
        (F.col("_near") + F.coalesce("_more", F.lit(0.0))) / (F.col("_n") + PRIOR)).alias("evidence"))


# ------------------------------------------------------------------------ fit and score

def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", train: Column | None = None, max_runs: int = MAX_RUNS,
        order: int = ORDER) -> Model:
    """Models and calibration from the labelled documents for which ``train`` (default: outside
    the held-out fold) holds."""
    train = (fold(key, FOLDS) != HELD) if train is None else train
    rows = _training(docs, labels, key, text, label, train)
    part = F.pmod("_h", F.lit(CALIBRATE)) == 0
    vocabulary = (rows.filter(~part).select("_y", "_text")
                  .mapInArrow(_word_counts, "word string, toxic long, ordinary long")
                  .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    runs = cut(vocabulary.mapInArrow(_run_counts(order), "run string, toxic long, ordinary long")
               .groupBy("run").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))
    # how often a run must occur to travel: once, or more if there are too many runs
    sizes = (runs.groupBy(F.floor(F.log2(F.col("toxic") + F.col("ordinary"))).cast("int").alias("e"))
             .agg(F.count("*").alias("count"), F.sum("toxic").alias("toxic"),
                 F.sum("ordinary").alias("ordinary")).collect())
    least, kept = 1, sum(r["count"] for r in sizes)
    for r in sorted(sizes, key=lambda r: r["e"]):
        if kept <= max_runs:
            break
        kept -= r["count"]
        least = 2 ** (r["e"] + 1)
    longer = (runs.filter(F.length("run") > 1)
              .groupBy(F.expr("substr(run, 2)").alias("run"))
              .agg(F.sum((F.col("toxic") > 0).cast("int")).alias("bt"),
                   F.sum((F.col("ordinary") > 0).cast("int")).alias("bo")))
    share = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    ones, zeros = share.get(1, 0), share.get(0, 0)
    prior = math.log((ones + 0.5) / (zeros + 0.5))
    if not all(any(r[c] for r in sizes) for c in ("toxic", "ordinary")):
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.float32), 0.0,
                     0.0, prior, order)
    judged = rows.filter(part).select("_y", "_text")
    if least > 1:
        # runs of one letter are as many as letters; the others that travel at most ``max_runs``
        table, bottom = _probabilities(runs, longer, order)
        model = _frequent(table, least, bottom, order)
        steps = _evidence(judged, "_y", "_text", model).select(
            F.col("_y").alias("y"), F.rint(F.log1p(100 * F.col("evidence")) / STEP).alias("step"))
    else:
        table = runs.join(longer, "run", "left").select(
            "run", "ordinary", "toxic", F.coalesce("bo", F.lit(0)).cast("long").alias("bo"),
            F.coalesce("bt", F.lit(0)).cast("long").alias("bt")).toArrow()
        raw, before = (np.column_stack([table.column(c).to_numpy() for c in pair]).reshape(-1, 2)
                       for pair in (("ordinary", "toxic"), ("bo", "bt")))
        model = kneser_ney(table.column("run").to_pylist(), raw, before, order)
        steps = judged.mapInArrow(_steps(model), "y int, step int")
    seen = steps.groupBy("y", "step").count().collect()
    if len({r["y"] for r in seen}) < 2:
        return replace(model, slope=1.0, intercept=prior)
    x, y, w = (np.array([float(r[c]) for r in seen]) for c in ("step", "y", "count"))
    slope, intercept = logistic(x * STEP, y, w / w.sum() * len(w))
    return replace(model, slope=slope, intercept=intercept)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    if model.table is not None:
        x = model.slope * F.log1p(100 * F.col("evidence")) + model.intercept
        return _evidence(docs.withColumn(text, F.col(text).cast("string")), key, text, model).select(
            key, (1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(500.0)), F.lit(-500.0))))).alias("score"))
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = slim.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)     # at most max_runs entries

    def run(batches):
        scorer = Scorer(sent.value)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(scorer.score(b.column(1).to_pylist()))], [key, "score"])

    return slim.mapInArrow(run, f"`{key}` {kind}, score double")
