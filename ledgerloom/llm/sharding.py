"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups of equal texts go together. What the driver packs is bounded whatever
the corpus: small groups are dealt into ``CELLS`` cells by the hash of their
text, and each heavy one has ``PARTS`` cells of its own, by document (there are
at most shards * ``HEAVY`` such groups). Each small cell and each heavy group,
largest first, goes whole to the shard whose residual capacity has the highest
dot product with it; a heavy group only to one in which its bytes, tokens and
rows all fit. If it fits none and is over 1/``SPLIT`` of a shard in any of them,
its cells are placed one by one.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, materialise, text_of

CELLS = 16_384
#: A group is heavy if it holds more than this part of a shard's bytes, tokens or rows.
HEAVY = 64
PARTS = 64
#: A heavy group that fits no shard is split if it holds more than this part of a shard's bytes, tokens or rows; a smaller one cannot unbalance it alone.
SPLIT = 16
DIMENSIONS = ("size", "tokens", "rows")


def pack(vectors: np.ndarray, groups: list[np.ndarray], shards: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The items placed, as rows of ``vectors`` (sizes, tokens, rows), and the shard of each: the one with the highest dot product of item and residual capacity; ties go to the lowest.

    ``groups`` are the rows of each group of cells. One is an item while it fits a shard, or would not unbalance it; else each of its rows is.
    """
    total = vectors.sum(axis=0).astype(float)
    loads = vectors / np.where(total > 0, total / shards, 1.0)
    residual = np.ones((shards, loads.shape[1]))
    heap = [(-float(loads[g].sum(axis=0).max()), i, g) for i, g in enumerate(groups)]
    heapq.heapify(heap)
    items, place, serial = [], [], len(groups)
    while heap:
        _, _, g = heapq.heappop(heap)
        load = loads[g].sum(axis=0)
        scores = residual @ load
        if len(g) > 1:
            fits = (residual >= load - 1e-9).all(axis=1)
            if fits.any():
                scores = np.where(fits, scores, -np.inf)
            elif load.max() * SPLIT > 1:
                for k in g.tolist():
                    heapq.heappush(heap, (-float(loads[k].max()), serial, np.array([k])))
                    serial += 1
                continue
        items.append(g)
        place.append(int(np.argmax(scores)))
        residual[place[-1]] -= load
    return items, np.array(place, dtype=np.int64)


def place_cells(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each cell (row of sizes, tokens, rows), each an item of its own."""
    items, place = pack(vectors, [np.array([i]) for i in range(len(vectors))], shards)
    out = np.zeros(len(vectors), dtype=np.int64)
    out[[int(g[0]) for g in items]] = place
    return out


def place_groups(cells: list[int], vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each cell, whose heavy groups stay whole where they fit."""
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(cells):
        groups.setdefault(c if c < CELLS else CELLS + (c - CELLS) // PARTS, []).append(i)
    items, place = pack(vectors, [np.array(g) for g in groups.values()], shards)
    place = _level(np.array([vectors[g].sum(axis=0) for g in items]), place, shards)
    out = np.zeros(len(cells), dtype=np.int64)
    for g, s in zip(items, place.tolist(), strict=True):
        out[g] = s
    return out


#: Tokens and rows may differ from the mean by this part before a move that levels bytes must spare them.
SLACK = 0.01


def _level(vectors: np.ndarray, place: np.ndarray, shards: int) -> np.ndarray:
    """Even out the bytes that packing has left uneven: move, or exchange, the items that fit the gap between the fullest and the emptiest shard best.

    Of the moves those count that leave tokens and rows of both shards within ``SLACK`` of the mean, or no further from it than they are; any other only while bytes differ by more than that.
    """
    loads = np.zeros((shards, vectors.shape[1]), dtype=np.int64)
    np.add.at(loads, place, vectors)
    mean, sizes = loads.mean(axis=0), vectors[:, 0]
    for _ in range(64 * shards):
        high, low = int(loads[:, 0].argmax()), int(loads[:, 0].argmin())
        gap = int(loads[high, 0] - loads[low, 0])
        mine, theirs = np.flatnonzero(place == high), np.flatnonzero(place == low)
        if gap < 2 or not len(mine):
            break
        # The best partners of each item are next to size - gap / 2 among the others, or none at all.
        order = theirs[np.argsort(sizes[theirs], kind="stable")]
        given = np.concatenate((np.zeros((1, vectors.shape[1]), np.int64), vectors[order]))
        at = np.searchsorted(given[:, 0], sizes[mine] - gap / 2)
        k = np.clip(at[:, None] + np.arange(-4, 4), 0, len(given) - 1)
        moved = vectors[mine][:, None, :] - given[k]
        short = np.abs(moved[..., 0] - gap / 2)
        after = np.maximum(np.abs(loads[high] - moved - mean), np.abs(loads[low] + moved - mean))[..., 1:]
        bound = np.maximum(SLACK * mean, np.maximum(np.abs(loads[high] - mean), np.abs(loads[low] - mean)))[1:]
        useful = (moved[..., 0] > 0) & (moved[..., 0] < gap)
        sparing = useful & (after <= bound).all(axis=-1)
        if not sparing.any() and gap <= SLACK * mean[0] or not useful.any():
            break
        i, j = np.unravel_index(np.argmin(np.where(sparing if sparing.any() else useful, short, np.inf)), short.shape)
        place[mine[i]] = low
        if k[i, j]:
            place[order[k[i, j] - 1]] = high
        loads[high] -= moved[i, j]
        loads[low] += moved[i, j]
    return place


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, under the law ``bytes``.

    size is the text's bytes in UTF-8 and 1 more (a null text counts as empty); tokens are white-space words. Repeated rows, and rows with a null doc_id, each get a slot of their own. An empty table gives no rows. Texts are measured where they lie, whatever their length, and not shuffled; other columns are not looked at.
    """
    spark, text = docs.sparkSession, text_of("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"), F.lit(1).cast("long").alias("rows")
    )
    rows = materialise(rows, "sizes")
    totals = rows.agg(*(F.sum(d).alias(d) for d in DIMENSIONS)).first()
    group = ["text_hash", "text_crc32", "size"]
    # At most shards * HEAVY groups can be this large in one dimension.
    large = functools.reduce(lambda a, b: a | b, (F.col(f"all_{d}") * (shards * HEAVY) > (totals[d] or 0) for d in DIMENSIONS))
    heavy = rows.groupBy(*group).agg(*(F.sum(d).alias(f"all_{d}") for d in DIMENSIONS)).filter(large).select(*group).collect()
    heavy_rows = spark.createDataFrame([(*h, i) for i, h in enumerate(sorted(heavy))], "text_hash long, text_crc32 long, size long, heavy long")
    marked = rows.join(F.broadcast(heavy_rows), group, "left")
    # Rows without a doc_id are dealt out by their places in the written table.
    own = F.coalesce(F.col("doc_id"), F.monotonically_increasing_id())
    cell = F.when(F.col("heavy").isNull(), F.pmod(F.xxhash64(*group), F.lit(CELLS))).otherwise(CELLS + F.col("heavy") * PARTS + F.pmod(F.xxhash64(own), F.lit(PARTS)))
    celled = materialise(marked.select("doc_id", "size", "text_crc32", "text_hash", "tokens", "rows", cell.alias("cell")), "cells")
    sums = sorted(tuple(r) for r in celled.groupBy("cell").agg(*(F.sum(d) for d in DIMENSIONS)).collect())  # CELLS + shards * HEAVY * PARTS rows at most
    vectors = np.array([s[1:] for s in sums], dtype=np.int64).reshape(-1, len(DIMENSIONS))
    placed = place_groups([s[0] for s in sums], vectors, shards) if len(sums) else []
    base, table = [0] * shards, []
    for (c, *v), s in zip(sums, placed, strict=True):
        table.append((c, int(s), base[s]))
        base[s] += v[2]
    cells = spark.createDataFrame(table, "cell long, shard int, base long")
    slot = F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "text_hash", "text_crc32"))
    return celled.join(F.broadcast(cells), "cell").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + slot - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, files_per_shard: int = 16) -> None:
    """Write ``docs``, whose doc_ids must be unique, as Parquet in folders shard=0, shard=1, ..., each file sorted by slot.

    The columns are called shard and slot, each with as many _ behind it as columns of ``docs`` make needful. Rows with a null doc_id are not written.
    """
    shard, slot = "shard", "slot"
    while shard in docs.columns:
        shard += "_"
    while slot in docs.columns:
        slot += "_"
    rows = docs.join(assigned.select("doc_id", F.col("shard").alias(shard), F.col("slot").alias(slot)), "doc_id")
    rows = rows.withColumn("__file", F.pmod(F.xxhash64("doc_id"), F.lit(files_per_shard)))
    rows.repartition(shard, "__file").sortWithinPartitions(shard, slot).drop("__file").write.partitionBy(shard).parquet(path)


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
