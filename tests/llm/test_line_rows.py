"""Line dedup by rows: repeated ids, equal rows, ids of any type, clashing columns, crowded tiles."""

from __future__ import annotations

import random

import pytest

from costpulse.llm import linededup as L


def brute(rows):
    """Texts that stay of (id, text) rows, by all pairs in the order of (id, hash, line), where
    equal rows follow each other. Returns a multiset as a sorted list of (id, text)."""
    import pyspark.sql.functions as F  # noqa: F401
    order = sorted(range(len(rows)), key=lambda i: rows[i][:1] + rows[i][2:])
    lines = [(i, n, x.strip()) for i in order for n, x in enumerate((rows[i][1] or "").split("\n")) if x.strip()]
    sets = [L.shingles(x) for _, _, x in lines]
    top = list(range(len(lines)))

    def find(a):
        while top[a] != a:
            a = top[a]
        return a
    for a in range(len(lines)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if lines[a][2] == lines[b][2] or common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    gone = {(i, n) for a, (i, n, _) in enumerate(lines) if find(a) != a}
    return sorted((rows[i][0], "\n".join(x for n, x in enumerate((rows[i][1] or "").split("\n"))
                                         if (i, n) not in gone)) for i in range(len(rows)))


def run(llm, rows, kind):
    import pyspark.sql.functions as F
    df = llm.createDataFrame([(k, t) for k, t in rows], f"doc_id {kind}, text string")
    hashes = [r["h"] for r in df.withColumn("h", L._hash("text")).collect()]
    # integer ids are ordered by the upper bits of the hash, without its sign
    tie = [(h % (1 << 64)) >> 33 if kind == "long" else h for h in hashes]
    got = sorted((r["doc_id"], r["text"]) for r in L.dedup_lines(df.withColumn("n", F.lit(1))).collect())
    return got, brute([(k, t, h) for (k, t), h in zip(rows, tie)])


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_that_repeat_an_id_keep_their_unique_lines(llm, kind):
    cast = int if kind == "long" else (lambda i: f"doc-{i}")
    rows = [(cast(1), "alpha beta gamma one\nunique line number two here"),
            (cast(1), "third text completely other\nalpha beta gamma one"),
            (cast(2), "twice the very same row\nand its second line"),
            (cast(2), "twice the very same row\nand its second line"),
            (cast(2), "twice the very same row\nand its second line"), (cast(3), ""), (cast(3), ""),
            (cast(-4), "alpha beta gamma one, nearly")]
    rng = random.Random(3)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    for i in range(40):
        line = " ".join(rng.choices(words, k=12))
        near = line[:-2] + "zz"
        rows += [(cast(rng.randrange(10, 20)), f"{line}\nown {i} {rng.random()} text"), (cast(rng.randrange(10, 20)), near)]
    got, want = run(llm, rows, kind)
    assert got == want
    assert any("unique line number two here" in t for _, t in got)
    assert sum("its second line" in t for _, t in got) == 1


def test_columns_that_clash_stay_as_they_are(llm):
    shape = ("doc_id long, text string, __removed int, __key string, hash long, n_lines long, removed long,"
             "repeated string, salt int, `rank` int, key_ int, hash_ int, copies int, n_chars long")
    row = [7, "k", 1, 2, 3, "r", 4, 5, 6, 7, 8, 99]
    df = llm.createDataFrame([(1, "the same line of text\nmine", *row), (2, "the same line of text", *row),
                              (2, "the same line of text", *row), (None, "the same line of text", *row)], shape)
    got = L.dedup_lines(df)
    assert got.columns == df.columns
    out = [tuple(r) for r in got.orderBy("doc_id").collect()]
    assert [r[1] for r in out] == ["the same line of text", "the same line of text\nmine", "", ""]
    assert all(list(r[2:-1]) == row[:-1] for r in out)
    assert [r[-1] for r in out] == [99, 99, 0, 0]


def test_maps_and_nested_columns_pass(llm):
    df = llm.createDataFrame([(1, "one line of text here", {"a": 1}, [1]), (1, "one line of text here", {"a": 1}, [1])],
                             "doc_id long, text string, m map<string,int>, v array<int>")
    assert sorted(r["text"] for r in L.dedup_lines(df).collect()) == ["", "one line of text here"]


def test_linker_remembers_components_over_tiles():
    lines = {i: "abcdefghijklmnopqrstuvwxyz" * 3 + str(i) for i in range(4)}
    read = []
    linker = L.Linker(lambda i: read.append(i) or lines[i], 0.8)
    assert len(linker.tile([0, 1, 2, 3])) == 3
    assert linker.tile([0, 1, 2, 3]) == [] and linker.tile([0], [1, 2, 3]) == []
    assert sorted(read) == [0, 1, 2, 3]


def test_near_dedup_keeps_columns_that_share_its_names(llm):
    from costpulse.llm import simhash
    df = llm.createDataFrame([(1, "one two three four", "a", 1, 2), (2, "one two three four", "b", 3, 4),
                              (None, "one two three four", "c", 5, 6)],
                             "doc_id long, text string, gone string, `rank` int, __salt int")
    got = simhash.near_dedup(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "one two three four", "a", 1, 2), (None, "one two three four", "c", 5, 6)]
