"""Fuzzy line dedup: MinHash bands over character shingles, exact Jaccard, union-find.

A line is a maximal piece of text without ``\\n``, compared after stripping white space; blank
lines take no part and always stay. Lines are alike when the Jaccard similarity of their
sets of ``SHINGLE``-character shingles (a shorter line is one shingle) is at least
``THRESHOLD``; equal lines always are. Of every connected component the first line stays, in the
order of ids (of any type that sorts), then of a hash of the text where ids repeat, then of
line numbers. Of rows equal in id and text one counts as the first, the least by a hash of the
whole row, and the others lose all their lines. Documents with a null id pass unchanged and
take no part.

1. Every line gets a 64-bit id (XXH64 of its text), so copies of a line are one node: a line
   that half of all documents hold costs one node and map-side counts. (Among 10^10
   different lines about 3 pairs of ids collide.)
2. ``BANDS`` bands of ``ROWS`` MinHash values: a pair at similarity 0.8 shares a band with
   probability 1 - (1 - 0.8^4)^20 = 0.99997, at 0.85 with 0.9999999; unrelated prose stays near
   0.01 and almost never collides.
3. Lines that share a band meet in tiles of bounded size (``buckets.collide_packed``) and are compared
   exactly. Small tiles with the same smallest id are compared by one task, which reads the text
   of a line once for all of them; comparisons inside one known component are skipped, nothing
   else is. Larger tiles, as of a crowded bucket, have a task each.
4. ``graph.components`` joins the links of all tiles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from xxhash import xxh64_intdigest

from costpulse.llm import buckets, graph
from costpulse.llm.common import cut, fresh
from costpulse.llm.textarrays import mix, minima, permutations

SHINGLE = 8
THRESHOLD = 0.8
ROWS = 4
BANDS = 20
FILTER_BITS = 1 << 25          # the candidate filter sent to tasks: 4 MB, whatever the input
CHARS_AT_ONCE = 1 << 17
LINES_AT_ONCE = 1 << 14
TILE, SMALL = 512, 64          # lines of a tile; of one that shares its task with others
SLOTS = 1 << 11                # of the quick bound on common shingles
FACTOR, SLOT_SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - SLOTS.bit_length() + 1)
SHINGLES_HELD = 1 << 20         # shingles a comparison of tiles keeps at a time


def line_id(line: str) -> int:
    """Signed 64-bit id of a stripped line."""
    h = xxh64_intdigest(line.encode("utf-8", "surrogatepass"), 5)
    return h - (1 << 64) if h >> 63 else h


def shingles(line: str) -> set[str]:
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def _lines(batches):
    """(key, hash, pos, id, head) of every non-blank line of (key, hash, text) rows; ``head`` is 1
    at the first one of a row, else 0."""
    for b in batches:
        row, pos, ids, head = [], [], [], []
        for i, text in enumerate(b.column(2).to_pylist()):
            for n, line in enumerate((text or "").split("\n")):
                if line := line.strip():
                    head.append(int(not row or row[-1] != i))
                    row.append(i)
                    pos.append(n)
                    ids.append(line_id(line))
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(at), b.column(1).take(at), pa.array(pos, pa.int32()),
             pa.array(ids, pa.int64()), pa.array(head, pa.int32())],
            ["key", "hash", "pos", "id", "head"])


def _distinct(batch, column: int):
    return list({line: None for text in batch.column(column).to_pylist() if text
                 for line in map(str.strip, text.split("\n")) if line})


def band_keys(lines: list[str], rows: int = ROWS, bands: int = BANDS, seed: int = 3) -> np.ndarray:
    """(bands, lines) bucket keys of stripped, non-empty lines."""
    perms = permutations(rows * bands, seed)
    out = []
    at = 0
    while at < len(lines):
        end, chars = at, 0
        while end < len(lines) and (end == at or chars + len(lines[end]) < CHARS_AT_ONCE):
            chars += len(lines[end])
            end += 1
        part = [x if len(x) >= SHINGLE else x + "\n" * (SHINGLE - len(x)) for x in lines[at:end]]
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        span, base = 1, 0x9DDFEA08EB382D69       # doubling: 1, 2, 4, 8 characters
        while span < SHINGLE:
            h = h[:-span] * np.uint64(base) + h[span:]
            span, base = span * 2, base * base % (1 << 64)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        first = np.cumsum(sizes) - sizes
        counts = sizes - SHINGLE + 1
        keep = np.ones(len(codes), bool)         # shingles that run over into the next line
        for j in range(1, SHINGLE):
            keep[first + sizes - j] = False
        values = (mix(h[keep[:len(h)]]) >> np.uint64(32)).astype(np.uint32)
        mins = minima(values, np.cumsum(counts) - counts, perms).astype(np.uint64)
        keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[:, None], len(part), axis=1)
        for row in range(rows):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + mins[row::rows])
        out.append(keys)
        at = end
    return np.concatenate(out, axis=1).view(np.int64)


def _bands(bits: int):
    """``buckets.PACKED`` rows of (band key, line id)."""
    def keyed(batches):
        for b in batches:
            lines = _distinct(b, 0)
            for at in range(0, len(lines), LINES_AT_ONCE):
                part = lines[at:at + LINES_AT_ONCE]
                ids = np.fromiter(map(line_id, part), np.int64, len(part))
                yield band_keys(part).ravel(), np.tile(ids, BANDS)

    def run(batches):
        yield from buckets.packed(keyed(batches), bits)
    return run


def _slots(ids: np.ndarray) -> np.ndarray:
    return ids.view(np.uint64) & np.uint64(FILTER_BITS - 1)


def _texts(bits: bytes):
    """(id, line) of the lines whose id may be a candidate."""
    def run(batches):
        table = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)
        for b in batches:
            lines = _distinct(b, 0)
            ids = np.fromiter(map(line_id, lines), np.int64, len(lines))
            hit = np.flatnonzero(table[_slots(ids)]) if len(ids) else ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[hit], pa.int64()), pa.array([lines[i] for i in hit], pa.string())],
                ["id", "line"])
    return run


def _candidate_filter(ids: DataFrame) -> bytes:
    """One bit for each slot that a candidate id falls into; fixed size, so with very many
    candidates it only lets more lines through to the join that follows."""
    words = (ids.select(F.expr(f"id & {FILTER_BITS - 1}").alias("slot"))
             .groupBy(F.expr("shiftright(slot, 5)").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits"))).toPandas()
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return table.tobytes()


def _different(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    first = np.empty(len(codes), bool)
    first[:1] = True
    np.not_equal(codes[1:], codes[:-1], out=first[1:])
    return codes[first]


def shingle_codes(line: str) -> tuple[np.ndarray, bool]:
    """(sorted 64-bit codes of the different shingles, whether some stand for more than themselves).
    Eight characters below U+0100 are their own code, others have a hash."""
    if len(line) < SHINGLE:
        line += "\n" * (SHINGLE - len(line))
    try:
        data = line.encode("latin-1")
        return _different(np.ndarray(len(data) - SHINGLE + 1, "<u8", data, strides=(1,))), False
    except UnicodeEncodeError:
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    wide, code = points > 255, points & np.uint64(255)
    h, span, base = points + np.uint64(0x9E3779B97F4A7C15), 1, 0x9DDFEA08EB382D69
    while span < SHINGLE:                          # doubling: 1, 2, 4, 8 characters
        wide = wide[:-span] | wide[span:]
        code = code[:-span] | (code[span:] << np.uint64(8 * span))
        h = h[:-span] * np.uint64(base) + h[span:]
        span, base = span * 2, base * base % (1 << 64)
    return _different(np.where(wide, mix(h), code)), True


def _described(own: np.ndarray, hashed: bool = False) -> tuple[np.ndarray, int, int, bool]:
    """Codes, a number with one bit for each slot that one falls into, how many share theirs."""
    bits = np.zeros(SLOTS, bool)
    bits[((own * FACTOR) >> SLOT_SHIFT).view(np.int64)] = True
    slots = int.from_bytes(np.packbits(bits).data, "big")
    return own, slots, len(own) - slots.bit_count(), hashed


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort(kind="stable")              # merges the two sorted runs
    return int(np.count_nonzero(both[1:] == both[:-1]))


class Linker:
    """Compares lines tile after tile and knows which are connected already."""

    def __init__(self, line_of, threshold: float):
        self.line_of, self.threshold = line_of, threshold
        self.parent: dict = {}
        self.sets: dict = {}
        self.held = 0

    def _top(self, x):
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def _set(self, x) -> tuple[np.ndarray, int, int, bool]:
        """What ``_described`` says of a line."""
        found = self.sets.get(x)
        if found is None:
            if self.held > SHINGLES_HELD:
                self.sets.clear()
                self.held = 0
            found = self.sets[x] = _described(*shingle_codes(self.line_of(x)))
            self.held += len(found[0])
        return found

    def _alike(self, x, y) -> bool:
        a, of_a, more_a, hashed_a = self.sets.get(x) or self._set(x)
        b, of_b, more_b, hashed_b = self.sets.get(y) or self._set(y)
        # every slot that only one line has stands for a shingle that the other lacks: at most so
        # many are common, and most unlike pairs need no look at the shingles themselves
        most = (of_a & of_b).bit_count() + min(more_a, more_b)
        if most * (1 + self.threshold) < self.threshold * (len(a) + len(b)) - 1e-6:
            return False
        common = _common(a, b)
        if common < self.threshold * (len(a) + len(b) - common):
            return False
        if not (hashed_a or hashed_b):
            return True
        own, other = shingles(self.line_of(x)), shingles(self.line_of(y))
        common = len(own & other)
        return common >= self.threshold * (len(own) + len(other) - common)

    def tile(self, left: list, right: list | None = None) -> list[tuple]:
        """Links between members (``left`` among themselves, or ``left`` with ``right``) that join
        the same components as all their alike pairs do."""
        groups: dict = {}
        for j in right or ():
            groups.setdefault(self._top(j), []).append(j)
        found = []
        for i in left:
            here = self._top(i)
            for root in list(groups):
                if root == here or root not in groups:
                    continue
                j = next((j for j in groups[root] if self._alike(i, j)), None)
                if j is not None:
                    found.append((i, j))
                    self.parent[root] = here
                    groups[here] = groups.pop(root) + groups.get(here, [])
            if right is None:
                groups.setdefault(here, []).append(i)
        return found


def similar_links(sets: list[set], left: list[int], right: list[int] | None,
                  threshold: float) -> list[tuple[int, int]]:
    """``Linker.tile`` over given shingle sets."""
    number: dict = {}
    linker = Linker(None, threshold)
    linker.sets = {i: _described(_different(np.array(
        [number.setdefault(x, len(number)) for x in own], np.uint64))) for i, own in enumerate(sets)}
    return linker.tile(left, right)


def _verified(threshold: float):
    """Links of (lead, kind, bucket, a, b, own, id, line) rows sorted by the first five columns:
    the lines of a lead (kind 0), then the members of its tiles."""
    def run(batches):
        for t, starts in buckets.grouped(batches, 1, most=1 << 12):
            ids, lines = t.column("id").to_pylist(), t.column("line").to_pylist()
            kind, bucket, a, b, own = (t.column(c).to_numpy()
                                       for c in ("kind", "bucket", "a", "b", "own"))
            new = np.ones(len(ids), bool)
            new[1:] = ((kind[1:] != kind[:-1]) | (bucket[1:] != bucket[:-1])
                       | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            us, vs = [], []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                first = s + int(np.searchsorted(kind[s:e], 1))
                linker = Linker(dict(zip(ids[s:first], lines[s:first])).__getitem__, threshold)
                edges = [*(first + np.flatnonzero(new[first:e])).tolist(), e]
                if edges[0] != first:
                    edges.insert(0, first)
                for lo, hi in zip(edges, edges[1:]):
                    if a[lo] == b[lo]:
                        found = linker.tile(ids[lo:hi])
                    else:
                        side = own[lo:hi] == a[lo]
                        members = np.arange(lo, hi)
                        found = linker.tile([ids[i] for i in members[side]],
                                            [ids[i] for i in members[~side]])
                    us += [u for u, _ in found]
                    vs += [v for _, v in found]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())],
                                             ["u", "v"])
    return run


def links(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(u, v) ids of different lines that are alike, enough to connect every component."""
    texts = docs.select(F.col(text).cast("string").alias("text"))
    bands = texts.mapInArrow(_bands(buckets.range_bits(texts)), buckets.PACKED)
    tiles = buckets.collide_packed(bands, TILE, merge=True)
    # small tiles of one smallest id go to one task, larger ones keep tasks of their own
    tile = Window.partitionBy("bucket", "a", "b")
    together = (F.col("a") == F.col("b")) & (F.count("*").over(tile) <= SMALL)
    tiles = cut(tiles.withColumn("lead", F.when(together, F.min("id").over(tile))
                                 .otherwise(F.xxhash64("bucket", "a", "b"))))
    bits = _candidate_filter(tiles)
    lines = (texts.mapInArrow(_texts(bits), "id long, line string")
             .groupBy("id").agg(F.first("line").alias("line")))
    none = F.lit(None).cast("string")
    members = tiles.select("lead", F.lit(1).alias("kind"), "bucket", "a", "b", "own", "id",
                           none.alias("line"))
    read = tiles.select("lead", "id").distinct().join(lines, "id").select(
        "lead", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("a"),
        F.lit(0).alias("b"), F.lit(0).alias("own"), "id", "line")
    return (read.unionByName(members).repartition("lead")
            .sortWithinPartitions("lead", "kind", "bucket", "a", "b")
            .mapInArrow(_verified(threshold), "u long, v long"))


def _places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, hash, pos, id, head) of the non-blank lines of every row that has an id."""
    named = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), _hash(text).alias("hash"), F.col(text).cast("string").alias("text"))
    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(_lines, f"key {kind}, hash long, pos int, id long, head int")


def _hash(text: str):
    """What tells rows of one id apart."""
    return F.xxhash64(F.lit(9), F.col(text).cast("string"))


def _place(rows: DataFrame):
    """Column that orders lines by (key, hash, pos). Whole-number ids share one number with the
    upper bits of the hash and the line number, which Spark adds up faster than a struct."""
    if rows.schema["key"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        wide = "decimal(38,0)"
        return (F.col("key").cast(wide) * F.lit(1 << 62).cast("decimal(19,0)")
                + F.shiftrightunsigned("hash", 33).cast(wide) * F.lit(1 << 31).cast("decimal(10,0)")
                + F.col("pos")).cast(wide)
    return F.struct("key", "hash", "pos")


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """(key, hash, copies, n_lines, removed): for every different id and text (``hash``) with
    non-blank lines how many rows have them, the number of lines and the sorted numbers
    (from 0) of those that go from the first copy. No documents, no rows."""
    rows = cut(_places(docs, key, text))
    place = _place(rows)
    classes = rows.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    comps = graph.components(links(docs.filter(F.col(key).isNotNull()), text, threshold)) \
        .withColumnRenamed("node", "id")
    joined = classes.join(comps, "id", "left")
    keepers = (joined.filter("component is not null").groupBy("component")
               .agg(F.min("first").alias("keeper")))
    marked = (joined.filter("n > 1 or component is not null").join(keepers, "component", "left")
              .select("id", F.coalesce("keeper", "first").alias("keeper")))
    gone = (rows.join(marked, "id").filter(place != F.col("keeper"))
            .groupBy("key", "hash").agg(F.sort_array(F.collect_set("pos")).alias("removed")))
    counts = rows.groupBy("key", "hash").agg(F.sum("head").alias("copies"), F.count("*").alias("n"))
    none = F.array().cast("array<int>")
    return (counts.join(gone, ["key", "hash"], "left")
            .select(F.col("key").alias(key), "hash", "copies", F.expr("n div copies").alias("n_lines"),
                    F.coalesce("removed", none).alias("removed")))


SALTS = 64


def decided(docs: DataFrame, key: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three columns more and their names: the number of non-blank lines (0 for
    none), the numbers of those that go, and whether all of them go (a repeated row)."""
    hashed, lines, gone, again, salt, rank, k, h, n = fresh(
        docs.columns, "hash", "n_lines", "removed", "repeated", "salt", "rank", "key_", "hash_", "copies")
    # short rows, written once: joined below and asked for repeated rows
    found = cut(removals(docs.select(key, text), key, text, threshold).select(
        F.col(key).alias(k), F.col("hash").alias(h), F.col("copies").alias(n),
        F.col("n_lines").alias(lines), F.col("removed").alias(gone)))
    marked, same = docs.withColumn(hashed, _hash(text)), (F.col(key) == F.col(k)) & (F.col(hashed) == F.col(h))
    copies = found.filter(F.col(n) > 1).select(k, h)
    if copies.isEmpty():
        marked = marked.withColumn(again, F.lit(False))
    else:
        # the first of every salted part, then the first of those: no task ranks all copies
        several = cut(marked.join(copies, same, "left_semi").withColumn(
            salt, F.monotonically_increasing_id() % SALTS))
        row = F.xxhash64(*[c for c in docs.columns if not isinstance(docs.schema[c].dataType, MapType)])
        ranked = several.withColumn(rank, F.row_number().over(
            Window.partitionBy(key, hashed, salt).orderBy(row)))
        heads = ranked.filter(F.col(rank) == 1).withColumn(again, F.row_number().over(
            Window.partitionBy(key, hashed).orderBy(row, salt)) > 1)
        rest = ranked.filter(F.col(rank) > 1).withColumn(again, F.lit(True))
        single = marked.join(copies, same, "left_anti").withColumn(again, F.lit(False))
        marked = heads.unionByName(rest).drop(salt, rank).unionByName(single)
    joined = marked.join(found, same, "left")
    none = F.array().cast("array<int>")
    return (joined.select(*docs.columns, F.coalesce(lines, F.lit(0).cast("long")).alias(lines),
                          F.coalesce(gone, none).alias(gone), again), lines, gone, again)


def _without(text_at: int, count_at: int | None, width: int):
    def run(batches):
        for b in batches:
            gone, again = b.column(width).to_pylist(), b.column(width + 1).to_pylist()
            texts = b.column(text_at).to_pylist()
            for i, (numbers, all_) in enumerate(zip(gone, again)):
                if numbers or all_:
                    drop = set(numbers)
                    texts[i] = "\n".join(x for n, x in enumerate((texts[i] or "").split("\n"))
                                         if n not in drop and not (all_ and x.strip()))
            columns = b.columns[:width]
            changed = [bool(g) or a for g, a in zip(gone, again)]
            columns[text_at] = pa.array(texts, pa.string())
            if count_at is not None:
                kind = columns[count_at].type
                columns[count_at] = pa.array(
                    [len(x or "") if g else old for x, g, old in
                     zip(texts, changed, columns[count_at].to_pylist())], kind)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:width])
    return run


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                threshold: float = THRESHOLD, count: str | None = "n_chars") -> DataFrame:
    """``docs`` without the repeated lines; every row and column stays, a text whose lines all
    go becomes empty, and ``count`` (if there is such a column) is set to the new length."""
    rows, lines, gone, again = decided(docs, key, text, threshold)
    at = docs.columns.index(count) if count in docs.columns else None
    return rows.select(*docs.columns, gone, again).mapInArrow(
        _without(docs.columns.index(text), at, len(docs.columns)), docs.schema)
