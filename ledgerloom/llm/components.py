"""Union-find grouping of links, distributed.

Each task first joins its own links by union-find and passes on a forest;
stars are then contracted until nothing changes (every node linked to the
smallest of its neighbourhood, larger and smaller sides in turn). No task and
no driver holds the links of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialise


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while (p := parent.get(root, root)) != root:
        root = p
    while (p := parent.get(x, x)) != root:
        parent[x] = root
        x = p
    return root


def union(parent: dict[int, int], a: int, b: int) -> bool:
    """Join two sets under the smaller root; False if they were one."""
    a, b = find(parent, a), find(parent, b)
    if a == b:
        return False
    parent[max(a, b)] = min(a, b)
    parent.setdefault(min(a, b), min(a, b))
    return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            union(parent, a, b)
    rows = [(x, root) for x in parent if (root := find(parent, x)) != x]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["u", "v"])


#: Links of one node that are expected in one task.
SPOKES = 1_000_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns); component is the smallest node reachable. Links to null are dropped.

    A hub's neighbours are dealt out by a salt, so that no task gets all of them.
    """
    a, b = links.columns
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u != v")
    edges = materialise(edges.mapInArrow(_forest, "u long, v long").distinct(), "forest")
    mark, n_edges = None, edges.count()
    while True:
        # Large star: every larger neighbour to the least of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(1 + n_edges // SPOKES)))
        least = both.groupBy("u", "salt").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        if n_edges >= SPOKES:  # the least of all parts, for each part
            least = least.groupBy("u").agg(F.min("m").alias("m")).join(least.select("u", "salt"), "u")
        edges = both.filter("v > u").join(least, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every smaller neighbour, and the node itself, to the least.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u != v").distinct()
        edges = materialise(edges, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark, n_edges = now, now[0]
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
