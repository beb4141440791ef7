"""Embedding near-dedup by Euclidean (p-stable) hashing, verified by exact cosine.

Vectors are normalised, so cosine >= t means Euclidean distance <= sqrt(2 - 2t). Each of ``TABLES``
tables has ``HASHES`` functions floor((a.v + b) / WIDTH) with Gaussian a and uniform b; a table's
quantised values together are its bucket. At cosine 0.9 (distance 0.447) one function agrees with
probability 0.82 and for unrelated vectors (distance 1.41) with 0.49, so a table of 10 agrees
with 0.14 and 0.0007, and 40 tables find a pair at the very threshold with 0.998.

Vectors that share a bucket meet in tiles of bounded size (``buckets.collide``) and are compared
by cosine in double precision. To count links without listing pairs, a pair counts only in the
first table whose bucket it shares. Equal vectors are one node with a multiplicity.

Null, zero, or non-finite vectors, and vectors with null components, link with nothing. Only
vectors of equal length can link. Every row is a vector of its own: a repeated row is an equal
vector. Null ids don't name a component unless nothing else can (then it is null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm import buckets, graph
from costpulse.llm.common import cut

THRESHOLD = 0.9
TABLES = 40
HASHES = 10
WIDTH = 2.0
TILE = 1024


def _projections(dim: int):
    rng = np.random.default_rng(1000 + dim)
    return (rng.standard_normal((dim, TABLES * HASHES)), rng.random(TABLES * HASHES) * WIDTH)


def _matrix(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(row numbers, unit vectors)] by dimension, of a column of arrays without nulls."""
    sizes = np.array([len(x) for x in column], np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(sizes)
    out = []
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        m = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
        # scaled by the largest component first, so that squares neither overflow nor vanish
        m = m / np.abs(m).max(axis=1, keepdims=True)
        out.append((rows, m / np.sqrt((m * m).sum(axis=1, keepdims=True))))
    return out


def _hash(batches):
    """Adds to each (node, vector) its bucket numbers in all tables."""
    for b in batches:
        keys = np.zeros((b.num_rows, TABLES), np.int32)
        for rows, unit in _matrix(b.column(1)):
            a, shift = _projections(unit.shape[1])
            q = np.floor((unit @ a + shift) / WIDTH).astype(np.int64).astype(np.uint64)
            h = np.full((len(rows), TABLES), unit.shape[1], np.uint64)
            for n in range(HASHES):
                h = (h ^ q[:, n::HASHES]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            keys[rows] = (h >> np.uint64(32)).astype(np.uint32).view(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(list(keys), pa.list_(pa.int32()))],
            ["id", "v", "keys"])


def _compare(threshold: float):
    """Links inside tiles: (u, v, -) forest edges and (node, null, n) counts of linked vectors."""

    def run(batches):
        for t, starts in buckets.grouped(batches, 3, most=1 << 13):
            ids, own = t.column("id").to_numpy(), t.column("own").to_numpy()
            weight = t.column("n").to_numpy()
            a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
            table = (t.column("bucket").to_numpy() >> 32).astype(np.int64)
            keys = np.stack(t.column("keys").to_numpy())
            vectors = t.column("v").combine_chunks()
            us, vs, nodes, counts = [], [], [], []
            ends = np.append(starts[1:], len(ids))
            for s, e in zip(starts.tolist(), ends.tolist()):
                for rows, unit in _matrix(vectors.slice(s, e - s)):
                    rows = rows + s
                    if a[s] == b[s]:
                        left = right = np.arange(len(rows))
                    else:
                        left, right = np.flatnonzero(own[rows] == a[s]), np.flatnonzero(own[rows] == b[s])
                    i, j = np.nonzero(unit[left] @ unit[right].T >= threshold)
                    i, j = left[i], right[j]
                    if a[s] == b[s]:
                        i, j = i[i < j], j[i < j]
                    if not len(i):
                        continue
                    i, j = rows[i], rows[j]
                    for at in range(0, len(i), 1 << 16):
                        x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                        new = ~(keys[x, :table[s]] == keys[y, :table[s]]).any(axis=1)
                        nodes += [ids[x[new]], ids[y[new]]]
                        counts += [weight[y[new]], weight[x[new]]]
                    u, v = graph.forest(ids[i], ids[j])
                    us.append(u)
                    vs.append(v)
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u), pa.array(v), pa.nulls(len(u), pa.int64())], ["u", "v", "n"])
            if nodes:
                node, inverse = np.unique(np.concatenate(nodes), return_inverse=True)
                n = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(n)], ["u", "v", "n"])
    return run


def near_dups(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
              threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) of every row. Empty table: no rows."""
    slim = vectors.select(F.col(key).cast("long").alias("vec"), F.col(vector).alias("raw"))
    usable = ("raw is not null and size(raw) > 0 and forall(raw, x -> x is not null and not isnan(x) "
              "and abs(x) < double('infinity')) and exists(raw, x -> x <> 0)")
    marked = slim.withColumn("v", F.when(F.expr(usable), F.col("raw").cast("array<double>"))).drop("raw")
    # equal vectors are one node, named by a hash of the components (-0.0 as 0.0)
    even = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    marked = cut(marked.withColumn("v", even).withColumn(
        "id", F.when(F.col("v").isNotNull(), F.xxhash64("v"))))
    nodes = (marked.filter("v is not null").groupBy("id").agg(
        F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec").alias("least")))
    hashed = cut(nodes.select("id", "v").mapInArrow(
        _hash, "id long, v array<double>, keys array<int>"))
    rows = hashed.select("id", F.posexplode("keys").alias("t", "k")).select(
        F.expr("shiftleft(cast(t as long), 32) + (cast(k as long) & 4294967295)").alias("bucket"), "id")
    payload = hashed.join(nodes.select("id", "n"), "id")
    tiles = (buckets.collide(rows, TILE).join(payload, "id")
             .select("bucket", "a", "b", "own", "id", "n", "v", "keys")
             .repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b"))
    found = cut(tiles.mapInArrow(_compare(threshold), "u long, v long, n long"))
    comps = graph.components(found.filter("v is not null").select("u", "v"))
    linked = (found.filter("n is not null").groupBy(F.col("u").alias("id"))
              .agg(F.sum("n").alias("others")))
    named = (nodes.select("id", "n", "least").join(comps.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    least = named.groupBy("component").agg(F.min("least").alias("smallest"))
    facts = (named.join(least, "component").join(linked, "id", "left").select(
        "id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"), "smallest"))
    component = F.when(F.col("id").isNull(), F.col("vec")).otherwise(F.col("smallest"))
    return (marked.select("vec", "id").join(facts, "id", "left").select(
        F.col("vec").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec").eqNullSafe(component).alias("kept")))
