"""Connected components of edges held in a DataFrame (distributed union-find)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import cut

FLUSH = 200_000


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component: hook to the smaller root, then jump."""
    parent = np.arange(n)
    while len(left):
        a, b = parent[left], parent[right]
        alive = a != b
        left, right, a, b = left[alive], right[alive], a[alive], b[alive]
        if not len(left):
            break
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star (node, smallest node of its component) for each component of the edges."""
    nodes, index = np.unique(np.concatenate([left, right]), return_inverse=True)
    half = len(left)
    top = roots(len(nodes), index[:half], index[half:])
    own = top != np.arange(len(nodes))
    return nodes[own], nodes[top[own]]


def _contract(batches):
    """Forests of the edges of one partition, a bounded number of edges at a time."""
    hi, lo, held = [], [], 0

    def flush():
        a, b = forest(np.concatenate(hi), np.concatenate(lo))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["hi", "lo"])

    for batch in batches:
        if batch.num_rows:
            hi.append(batch.column(0).to_numpy(zero_copy_only=False))
            lo.append(batch.column(1).to_numpy(zero_copy_only=False))
            held += batch.num_rows
        if held >= FLUSH:
            yield flush()
            hi, lo, held = [], [], 0
    if held:
        yield flush()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node that has an edge to another node; component is the
    smallest node id reachable.

    Partitions first contract their own edges, then large-star and small-star rounds run until
    nothing changes. A round groups by node with a map-side minimum and joins that back, so a
    hub of any degree is never gathered (skewed joins are split at run time). Every round is
    written to the checkpoint folder. Null ends and loops are ignored; no edges, no rows."""
    pairs = (edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
             .filter("u is not null and v is not null and u <> v")
             .selectExpr("greatest(u, v) as hi", "least(u, v) as lo"))
    links = cut(pairs.mapInArrow(_contract, "hi long, lo long").distinct())
    seen = None
    while True:
        state = links.agg(F.count("*").alias("n"),
                          F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["s"])
        both = links.selectExpr("hi as x", "lo as y").union(links.selectExpr("lo as x", "hi as y"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).selectExpr("x", "least(x, m) as m")
        large = (both.join(least, "x").filter("y > x").selectExpr("y as hi", "m as lo")
                 .filter("hi <> lo").distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi")
                 .select(F.explode(F.expr("array(struct(lo as hi, m as lo), struct(hi, m as lo))"))
                         .alias("e")).select("e.*").filter("hi <> lo").distinct())
        links = cut(small)
    return links.selectExpr("hi as node", "lo as component").union(
        links.selectExpr("lo as node", "lo as component").distinct())
