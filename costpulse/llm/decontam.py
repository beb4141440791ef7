"""Benchmark decontamination: size-partitioned MinHash containment search.

An item leaks into a document when at least ``THRESHOLD`` of the item's different five-word
shingles occur in the document. Words are runs of letters (lower-cased A-Z), digits and
non-ASCII characters, so case and punctuation don't hide a passage. An item of fewer words
is one shingle of its whole sequence; an item without words never leaks.

MinHash estimates resemblance, which for a short item in a long document is near zero, so sets
are partitioned by size. Items are put into classes of 2^c to 2^(c+1)-1 shingles, and for
each class every document is indexed as blocks of about 2^(c+1) consecutive shingles, sets of
the items' own size. Of the MinHash values of a block, as many are looked up in those of the
class's items as the size bounds demand: with block size u, item size n and threshold t, the
blocks of a document that contains the item agree with it in

    sum over blocks |Q and B| / |Q or B|  >=  t n / (n + u)

of the values on average; ``EXPECTED`` agreements are asked for, so a leak is missed with
probability about exp(-EXPECTED) = 6e-5. The blocks of a class are merged from those of the
class below by taking minima, so a text is hashed once for all classes. Every candidate is
verified by exact containment of shingle texts over the whole document.

Documents never shuffle: items are the stated query set, sent to the tasks in blocks of at most
``BLOCK_BYTES`` of text, each with a pass of its own.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from costpulse.llm.textarrays import minima, permutations, shingle_hashes, utf8, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
EXPECTED = 9.7
BLOCK_BYTES = 8 << 20
TEXT_BYTES_AT_ONCE = 1 << 20
SEED = 17
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def shingle_set(words: list[bytes], length: int) -> set[bytes]:
    return {b" ".join(words[i:i + length]) for i in range(len(words) - length + 1)}


class Index:
    """Items by shingle length and size class, with the MinHash values of each class."""

    def __init__(self, items: list[tuple[object, str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.items = []                      # (item id, shingle set, shingle length, hashes)
        by_class: dict[tuple[int, int], list[int]] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            length = min(SHINGLE, len(words))
            data, offsets = utf8(pa.array([text], pa.string()))
            hashes = np.unique(shingle_hashes(*word_hashes(data, offsets), length)[0])
            shingles = shingle_set(words, length)
            by_class.setdefault((length, len(shingles).bit_length() - 1), []).append(len(self.items))
            self.items.append((item, shingles, length, hashes))
        self.levels: dict[int, list] = {}    # shingle length -> [(class, values, owners)]
        for (length, size), members in sorted(by_class.items()):
            u, n = 2 << size, 1 << size
            k = math.ceil(EXPECTED * (n + u) / (threshold * n))
            perms = permutations(k, SEED)
            hashes = [(self.items[m][3] >> np.uint64(32)).astype(np.uint32) for m in members]
            starts = np.cumsum([0] + [len(h) for h in hashes[:-1]])
            mins = minima(np.concatenate(hashes), starts, perms)
            order = np.argsort(mins, axis=1, kind="stable")
            self.levels.setdefault(length, []).append(
                (size, np.take_along_axis(mins, order, 1), np.array(members)[order]))

    def candidates(self, hashes: np.ndarray, runs: np.ndarray, length: int) -> set[tuple[int, int]]:
        """(text, item) pairs whose blocks agree in a MinHash value; ``hashes`` holds the
        shingles of all texts one after the other, ``runs`` how many each has."""
        if not len(hashes):
            return set()
        values = (hashes >> np.uint64(32)).astype(np.uint32)
        found: set[tuple[int, int]] = set()
        levels = self.levels[length]
        finest = 2 << levels[0][0]
        k = max(v.shape[0] for _, v, _ in levels)
        blocks = -(-runs // finest)
        first = np.cumsum(runs) - runs
        text_of = np.repeat(np.arange(len(runs)), blocks)
        number = np.arange(len(text_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        mins = minima(values, first[text_of] + number * finest, permutations(k, SEED))
        step = levels[0][0]
        for size, table, owners in levels:
            while step < size:               # merge neighbouring blocks of the same text
                start = np.flatnonzero(number % 2 == 0)
                mins = np.minimum.reduceat(mins, start, axis=1)
                text_of, number = text_of[start], number[start] // 2
                step += 1
            for p in range(table.shape[0]):
                at = np.searchsorted(table[p], mins[p])
                at[at == table.shape[1]] = 0
                for n in np.flatnonzero(table[p][at] == mins[p]):
                    j = at[n]
                    while j < table.shape[1] and table[p][j] == mins[p][n]:
                        found.add((int(text_of[n]), int(owners[p][j])))
                        j += 1
        return found

    def leaks(self, texts, slice_bytes: int = TEXT_BYTES_AT_ONCE):
        """(row, item id, shared shingles, item's shingles) of an Arrow string column."""
        data, offsets = utf8(texts)
        out = []
        at = 0
        while at < len(offsets) - 1:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + slice_bytes, "right")) - 1)
            part = data[offsets[at]:offsets[end]]
            words, counts = word_hashes(part, offsets[at:end + 1] - offsets[at])
            sets: dict[tuple[int, int], set[bytes]] = {}
            for length in self.levels:
                hashes, runs = shingle_hashes(words, counts, length)
                first = np.cumsum(runs) - runs
                for row, m in sorted(self.candidates(hashes, runs, length)):
                    item, shingles, _, wanted = self.items[m]
                    own = hashes[first[row]:first[row] + runs[row]]
                    if np.isin(wanted, own).sum() < self.threshold * len(shingles):
                        continue
                    if (row, length) not in sets:
                        text = part[offsets[at + row] - offsets[at]:offsets[at + row + 1] - offsets[at]]
                        sets[row, length] = shingle_set(_WORD.findall(text.tobytes().lower()), length)
                    shared = len(shingles & sets[row, length])
                    if shared >= self.threshold * len(shingles):
                        out.append((at + row, item, shared, len(shingles)))
            at = end
        return out


def _blocks(benchmark: DataFrame, key: str, text: str) -> list[list]:
    """The items in blocks of bounded text; copies of an item id (null too) and text count once."""
    blocks, size = [[]], 0
    rows = (benchmark.filter(F.col(text).isNotNull())
            .select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
            .distinct().orderBy("k", "t"))
    for r in rows.toLocalIterator():
        n = len(r["t"]) * 4
        if blocks[-1] and size + n > BLOCK_BYTES:
            blocks.append([])
            size = 0
        blocks[-1].append((r["k"], r["t"]))
        size += n
    return [b for b in blocks if b]


def _search(items: list, text_at: int, threshold: float, id_type: pa.DataType):
    def run(batches):
        index = Index(items, threshold)
        for b in batches:
            out = index.leaks(b.column(text_at))
            rows = pa.array([r for r, *_ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), pa.array([x[1] for x in out], id_type),
                 pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64()),
                 pa.array([x[2] / x[3] for x in out], pa.float64())],
                [b.schema.names[0], "item_id", "n_shared", "n_item", "containment"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row and item it contains: key, item_id, n_shared, n_item,
    containment. Items or documents with null text match nothing; documents or items with a null
    key are reported with it, in the key's own type; items that share an id but not a text are searched one by one. An
    empty table on either side gives no rows."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = slim.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item_key].dataType
    schema = f"`{key}` {kind}, item_id {item_kind.simpleString()}, n_shared long, n_item long, containment double"
    found = None
    for items in _blocks(benchmark, item_key, item_text) or [[]]:
        part = slim.mapInArrow(_search(items, 1, threshold, to_arrow_type(item_kind)), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _clean(items: list, text_at: int, threshold: float):
    def run(batches):
        index = Index(items, threshold)
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[r for r, *_ in index.leaks(b.column(text_at))]] = False
            yield b.filter(pa.array(keep))
    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                   item_key: str = "item_id", item_text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item, whatever its id; all columns stay."""
    for items in _blocks(benchmark, item_key, item_text):
        docs = docs.mapInArrow(_clean(items, docs.columns.index(text), threshold), docs.schema)
    return docs
