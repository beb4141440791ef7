"""Phrase collocations: n-gram counts by HAT-tries in the tasks, merged by prefix on Spark.

A text is lower-cased (A-Z only), cut at ``. , ; : ! ?`` and the line ends ``\\x0A-\\x0D`` into
pieces, and those at spaces and tabs into words. Phrases are runs of words within a piece;
everything is counted per language (null: ``und``; a null text is empty).

Counting. A task keeps one HAT-trie per language (``Trie``): a shallow trie over word ids whose
nodes are found by the first word, with a hash container of suffix counts below each. Most
words have few followers, so containers of pairs are hybrid: each holds the pairs of ``SPAN``
first words. A container of triples that outgrows ``BURST`` bursts into one per next word. When the tries
of a task hold ``LIMIT`` entries, the largest subtrees are spilled whole, as one sorted run of
(phrase, count) rows, until half is left; the ids start anew when there are ``WORDS`` of
them. A run is sorted by the ranks of its words, and Arrow writes its phrases column by
column, so no phrase becomes a Python object. Runs are dealt by a hash of the phrase, the full path in the trie, so that a prefix
that a third of all rows share is spread over all tasks, and merged there. The tries have
combined repeats before, so a phrase has at most one row per run.

Two passes keep the shuffle small and lose nothing: words and pairs first; then the triples
whose two pairs both occur ``least`` times, as every frequent triple's do. The pairs reach the
tasks as a filter of fixed size (2 MB of bits); a pair that falls on another's bit only adds
triples that the count then drops.

Empty tables, texts without words and languages without candidates give no rows; repeated rows
count each time; null ids don't matter, as ids aren't used.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from costpulse.llm.common import cut
from costpulse.llm.textarrays import mix

LEAST = 10                     # occurrences of a candidate
COVERED = 50                   # per cent of its occurrences inside one longer candidate
TOP = 2000
BURST = 1 << 12                # suffixes in a container of triples
SPAN = 1 << 10                 # first words of a container of pairs
LIMIT = 3 << 19                # suffixes in all containers of a task (about 150 MB)
WORDS = 1 << 19                # word ids of a task
ROWS_AT_ONCE = 1 << 16
BYTES_AT_ONCE = 1 << 24        # of the phrases of a batch, if it has several
READ_AT_ONCE = 1 << 21         # bytes of text split into words at once
FILTER_BITS = 1 << 24          # 2 MB, whatever the input
IDS_AT_ONCE = 1 << 18
SALTS = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"\xff"                # never part of UTF-8
_TABLE = bytes(255 if c in _BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
_BETWEEN = re.compile(b"[ \xff]")
RUN = "phrase string, n long"  # the phrase follows its language and a tab


def pieces(text: str | None):
    """The words of every piece, as UTF-8."""
    for piece in (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split(_BREAK):
        words = piece.split()      # only spaces are left to split at
        if words:
            yield words


def _words(texts: list[bytes]):
    """The words of ``texts`` as Arrow columns, each with the numbers of the words' pieces."""
    data = _BREAK.join([*texts, b""]).translate(_TABLE)
    at = piece = 0
    while at < len(data):
        cut_at = _BETWEEN.search(data, at + READ_AT_ONCE)
        end = cut_at.start() if cut_at else len(data)
        part = np.frombuffer(data, np.uint8, end - at, at)
        stops = np.flatnonzero(part == _BREAK[0])
        inside = part != ord(" ")
        inside[stops] = False
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts = edges[::2]
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(edges[1::2] - starts, out=offsets[1:])
        yield (pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(offsets), pa.py_buffer(part[inside])]),
            piece + np.searchsorted(stops, starts))
        piece += len(stops)
        at = end


def _groups(column: np.ndarray):
    """(value, start, end) of the runs of equal values."""
    starts = np.flatnonzero(np.diff(column, prepend=-1))
    at = [*starts.tolist(), len(column)]
    return zip(column[starts].tolist(), at, at[1:])


class _Ids(dict):
    """Ids of words; a new word gets the next one."""

    def __init__(self, words: list):
        self.words = words

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.words)
        self.words.append(word)
        return i


class Trie:
    """Counts of the pairs (``depth`` 2) or triples (3) of one language: containers by first word
    or range of first words. Word id 0 ends a piece."""

    def __init__(self, depth: int):
        self.depth = depth
        self.clear()

    def clear(self):
        self.words: list[bytes] = [b""]
        self.nodes: dict = defaultdict(Counter)
        self.ids = _Ids(self.words)
        self.hashes = np.zeros(1, np.uint64)        # of the words, as far as asked for
        self.size = self.total = 0

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The word ids of texts and those that follow them; 0 follows the last of a piece.
        Arrow finds the different words, so each is looked up once a slice of text."""
        ids, pieces_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for words, piece in _words(texts):
            coded = words.dictionary_encode()
            own = np.fromiter(map(self.ids.__getitem__, coded.dictionary.to_pylist()), np.int64,
                              len(coded.dictionary))
            ids.append(own[coded.indices.to_numpy()])
            pieces_of.append(piece)
        here, piece = np.concatenate(ids), np.concatenate(pieces_of)
        after = np.zeros_like(here)
        after[:-1] = np.where(piece[1:] == piece[:-1], here[1:], 0)
        self.total += len(here)
        return here, after

    def _count(self, held: Counter, keys: np.ndarray):
        self.size -= len(held)
        held.update(keys.tolist())
        self.size += len(held)

    def add_pairs(self, here: np.ndarray, after: np.ndarray):
        """Counts every word with the one that follows it, one container after the other."""
        for lo in range(0, len(here), 2 * IDS_AT_ONCE):
            some = slice(lo, lo + 2 * IDS_AT_ONCE)
            keys = np.sort(here[some] << 32 | after[some])
            for node, start, end in _groups((keys >> 32) // SPAN):
                self._count(self.nodes[node], keys[start:end])

    def add_triples(self, triples):
        """Counts triples of ids (rows), one container after the other."""
        rows = triples if isinstance(triples, np.ndarray) else np.array(list(triples), np.int64)
        first, keys = rows[:, 0], rows[:, 1] << 32 | rows[:, 2]
        order = np.lexsort((keys, first))
        first, keys = first[order], keys[order]
        for node, start, end in _groups(first):
            held, own = self.nodes[node], keys[start:end]
            if type(held) is list:              # burst: containers by second word
                for b, lo, hi in _groups(own >> 32):
                    self._count(held[0][b], own[lo:hi] & 0xFFFFFFFF)
            else:
                self._count(held, own)
                if len(held) > BURST:
                    self._burst(node)

    def _burst(self, a: int):
        below: dict = defaultdict(Counter)
        for key, n in self.nodes[a].items():
            below[key >> 32][key & 0xFFFFFFFF] = n
        self.nodes[a] = [below]

    def _held(self, a: int) -> int:
        node = self.nodes[a]
        return sum(map(len, node[0].values())) if type(node) is list else len(node)

    def _entries(self, chosen: list[int]) -> tuple[np.ndarray, ...]:
        """The subtrees ``chosen``, taken out: a column of ids for every word of a phrase and one
        of counts; pairs come with the words themselves (second id 0)."""
        below, above = [], []                      # containers with the words that lead to each
        for node in chosen:
            held = self.nodes.pop(node)
            if type(held) is list:
                below += held[0].values()
                above += [(node, b) for b in held[0]]
            else:
                below.append(held)
                above.append((node, -1))
        sizes = np.fromiter(map(len, below), np.int64, len(below))
        size = int(sizes.sum())
        self.size -= size
        keys = np.fromiter(chain.from_iterable(below), np.int64, size)
        n = np.fromiter(chain.from_iterable(d.values() for d in below), np.int64, size)
        if self.depth == 2:
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first, second = keys >> 32, keys & 0xFFFFFFFF
            starts, pairs = np.flatnonzero(np.diff(first, prepend=0)), second > 0
            return (np.append(first[pairs], first[starts]),
                    np.append(second[pairs], np.zeros(len(starts), np.int64)),
                    np.append(n[pairs], np.add.reduceat(n, starts)))
        first, second = np.repeat(np.array(above, np.int64), sizes, axis=0).T
        return first, np.where(second < 0, keys >> 32, second), keys & 0xFFFFFFFF, n

    def _largest(self) -> list[tuple[int, int]]:
        """(entries, node) of every subtree, the largest first."""
        return sorted(((self._held(node), node) for node in self.nodes), reverse=True)

    def run(self, keep: int, head: bytes = b""):
        """Batches of the sorted run (by first word, then the next) of the largest subtrees, until
        at most ``keep`` entries are left; ``head`` goes before every phrase."""
        left, chosen = self.size, []
        for size, node in self._largest():
            if left <= keep:
                break
            left -= size
            chosen.append(node)
        if not chosen:
            return
        *ids, n = self._entries(chosen)
        words = pa.array(self.words, pa.large_binary())
        by_name = pc.sort_indices(words)
        words, ranks = words.take(by_name), np.empty(len(words), np.int64)
        ranks[by_name.to_numpy()] = np.arange(len(words))       # the empty word 0 stays 0
        ids = [ranks[column] for column in ids]
        order = (np.argsort(ids[0] << 32 | ids[1]) if len(ids) == 2 else np.lexsort(ids[::-1]))
        ids, n = [column[order] for column in ids], n[order]
        starts = pc.binary_join_element_wise(pa.scalar(head, pa.large_binary()), words,
                                             pa.scalar(b"", pa.large_binary()))
        lengths = pc.binary_length(words).to_numpy() + 1
        ends = np.cumsum(len(head) + sum(lengths[column] for column in ids))
        at = 0
        while at < len(n):
            room = BYTES_AT_ONCE + (int(ends[at - 1]) if at else 0)
            end = max(at + 1, min(at + ROWS_AT_ONCE, int(np.searchsorted(ends, room, "right"))))
            yield _batch(starts, words, [column[at:end] for column in ids], n[at:end])
            at = end

    def spill(self, keep: int):
        """The runs of ``run`` as a list of (phrase, count) per subtree, the largest first."""
        while self.size > keep:
            yield [(p.encode(), n) for b in self.run(self.size - 1)
                   for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]


def _batch(starts: pa.Array, words: pa.Array, ids: list[np.ndarray], n: np.ndarray):
    """Phrases of word ids, the first from ``starts``; a second id 0 stands for none."""
    space = pa.scalar(b" ", pa.large_binary())
    first, rest = starts.take(pa.array(ids[0])), [words.take(pa.array(i)) for i in ids[1:]]
    phrase = pc.binary_join_element_wise(first, *rest, space)
    if len(ids) == 2:
        phrase = pc.if_else(pa.array(ids[1] > 0), phrase, first)
    return pa.RecordBatch.from_arrays([phrase.cast(pa.string()), pa.array(n)], ["phrase", "n"])


def _head(lang: str) -> bytes:
    return lang.encode("utf-8", "surrogatepass") + b"\t"


def _spilled(tries: dict[str, Trie], everything: bool = False):
    if everything or sum(t.size for t in tries.values()) > LIMIT:
        keep = 0 if everything else LIMIT // 2 // len(tries)
        for lang, t in tries.items():
            yield from t.run(keep, _head(lang))
    if everything or sum(len(t.words) for t in tries.values()) > WORDS:
        for lang, t in tries.items():
            yield from t.run(0, _head(lang))
            if t.depth == 2 and t.total:
                yield _total(lang, t.total)
            t.clear()


def _total(lang: str, n: int):
    return pa.RecordBatch.from_arrays([pa.array([lang + "\t"]), pa.array([n], pa.int64())],
                                      ["phrase", "n"])


def _read(batches, tries: dict[str, Trie], depth: int):
    """(language, trie, what it read) of about ``IDS_AT_ONCE`` words or one long text at a time."""
    for batch in batches:
        texts: dict = {}
        for lang, text in zip(batch.column(0).to_pylist(),
                              batch.column(1).cast(pa.binary()).to_pylist()):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            t, at = tries.setdefault(lang, Trie(depth)), 0
            while at < len(own):
                end, size = at, 0
                while end < len(own) and size < 8 * IDS_AT_ONCE:
                    size += len(own[end])
                    end += 1
                yield lang, t, *t.read(own[at:end])
                at = end


def _words_and_pairs(batches):
    """Runs of words (their subtrees' sums) and pairs; an empty phrase counts all words."""
    tries: dict[str, Trie] = {}
    for _, t, here, after in _read(batches, tries, 2):
        t.add_pairs(here, after)
        yield from _spilled(tries)
    yield from _spilled(tries, everything=True)


@lru_cache(1 << 10)
def _lang_hash(lang: str) -> int:
    return xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def word_hash(lang: str, word: bytes) -> int:
    return xxh64_intdigest(word, _lang_hash(lang))


def _slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b) & np.uint64(FILTER_BITS - 1)


def _pair_slots(batches):
    for b in batches:
        left, right = [], []
        for name in b.column(0).to_pylist():
            lang, _, phrase = name.rpartition("\t")
            one, two = phrase.encode("utf-8").split(b" ")
            left.append(word_hash(lang, one))
            right.append(word_hash(lang, two))
        slots = _slots(np.array(left, np.uint64), np.array(right, np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64))], ["slot"])


def _pair_filter(pairs: DataFrame) -> bytes:
    """One bit for every slot that a pair falls into."""
    words = (pairs.select("phrase").mapInArrow(_pair_slots, "slot long")
             .groupBy(F.expr("shiftright(slot, 6)").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.tobytes()


def _triples(bits: bytes):
    """Runs of the triples whose pairs pass the filter."""
    def run(batches):
        table = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
        tries: dict[str, Trie] = {}

        for lang, t, here, after in _read(batches, tries, 3):
            seed = _lang_hash(lang)
            fresh = [xxh64_intdigest(w, seed) for w in t.words[len(t.hashes):]]
            t.hashes = np.append(t.hashes, np.array(fresh, np.uint64))
            pair = table[_slots(t.hashes[here], t.hashes[after])] & (after > 0)
            at = np.flatnonzero(pair[:-1] & pair[1:])
            t.add_triples(np.column_stack([here[at], after[at], after[at + 1]]))
            yield from _spilled(tries)
        yield from _spilled(tries, everything=True)
    return run


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """Counts of the phrases that occur ``least`` times, and of all words (empty phrases)."""
    return (runs.repartition("phrase").groupBy("phrase").agg(F.sum("n").alias("n"))
            .filter((F.col("n") >= least) | F.col("phrase").endswith("\t")))


def counts(docs: DataFrame, lang: str = "lang", text: str = "text",
           least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of one to three words with f >= ``least``
    occurrences, and (lang, '', 0, n) with the number n of all word occurrences."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull())
    short = cut(_merged(rows.mapInArrow(_words_and_pairs, RUN), least))
    bits = _pair_filter(short.filter(F.col("phrase").contains(" ")))
    long = _merged(rows.mapInArrow(_triples(bits), RUN), least)
    phrase = F.substring_index("phrase", "\t", -1)
    name = F.left("phrase", F.length("phrase") - F.length(phrase) - 1)
    spaces = F.length(phrase) - F.length(F.replace(phrase, F.lit(" ")))
    return cut(short.unionByName(long).select(
        name.alias("lang"), phrase.alias("phrase"),
        F.when(phrase == "", 0).otherwise(spaces + 1).alias("words"), F.col("n").alias("f")))


def _score(a: str, l: str, r: str):
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * "
                  f"cast({a} as decimal(15,0))) div "
                  f"(cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST,
                 covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two or
    three words with a >= ``least`` occurrences, by score, then a, both falling, then phrase
    in byte order. A cut after the first word or the first two gives the counts l and r of
    the parts and the score floor(1000000 a a / (l r)); the lowest score counts, at ties that
    of the shorter first part. A pair is dropped when a candidate triple that holds it has at
    least ``covered`` per cent of its occurrences."""
    found = counts(docs, lang, text, least)
    parts = found.filter("words > 0")
    head = F.substring_index("phrase", " ", 1)
    tail = F.expr("substr(phrase, instr(phrase, ' ') + 1)")
    first_two, last = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -1)

    def with_count(rows: DataFrame, part: str, name: str) -> DataFrame:
        side = parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        return rows.join(side, ["lang", part])

    pairs = found.filter("words = 2").select("lang", "phrase", F.col("f").alias("a"),
                                             head.alias("_h"), tail.alias("_t"))
    pairs = with_count(with_count(pairs, "_h", "l"), "_t", "r")
    triples = found.filter("words = 3").select(
        "lang", "phrase", F.col("f").alias("a"), head.alias("_h"), tail.alias("_t"),
        first_two.alias("_hh"), last.alias("_tt"))
    for part, name in (("_h", "l1"), ("_t", "r1"), ("_hh", "l2"), ("_tt", "r2")):
        triples = with_count(triples, part, name)
    inside = (triples.select("lang", "a", F.explode(F.array("_t", "_hh")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    pairs = (pairs.join(inside, ["lang", "phrase"], "left")
             .filter(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
             .select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score")))
    triples = triples.withColumn("_s1", _score("a", "l1", "r1")).withColumn(
        "_s2", _score("a", "l2", "r2"))
    early = F.col("_s1") <= F.col("_s2")
    triples = triples.select("lang", "phrase", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                             F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                             F.least("_s1", "_s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every salted part of a language first: no task ranks a whole language
    some = pairs.unionByName(triples).withColumn(
        "_salt", F.pmod(F.xxhash64(F.lit(17), "phrase"), F.lit(SALTS)))
    some = some.withColumn("_rank", F.row_number().over(
        Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
