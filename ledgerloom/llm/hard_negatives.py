"""Hard negatives: rows of other labels that are nearly as close to an anchor as its positives.

A norm-bucketed search for the highest inner products within windows. Candidates
are dealt into chunks; a chunk's rows stand by norm, largest first, in buckets.
By Cauchy and Schwarz no row of a bucket scores above the product of the norms
of the anchor and of the bucket's first row; where that is below a window's
lower limit or its running kth score, the bucket and all behind it are left out
for this window. Before the shuffle, a candidate goes only to the blocks of
anchors of which some window can be reached with its norm.

Each block of anchors meets each chunk in one task, so that memory is bounded
by a block and a bucket, whatever the sizes of labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialise
from ledgerloom.llm.worker import tidy

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
#: Every how many ids is an anchor; ids whose label is shifted; size of a step of a component.
ANCHORS, SHIFTED, STEPS = 50, 7, 256
#: Anchors of a block, rows of a bucket, and rows of a chunk; a small table has more chunks, of fewer rows, so that all cores work.
BLOCK, BUCKET, CHUNK, LEAST_CHUNK = 4096, 1024, 1 << 18, 256
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

ROW = "vec_id long, label int, norm2 long, q array<long>"
WINDOWS = "array<struct<tag: long, positive: long, low: long, high: long>>"


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, norm2, q): the rows that take part, labels shifted, components in steps.

    Rows with a null label or vector, or a null or non-finite component, take no part, nor do rows without a vec_id. A vec_id counts once: of rows that repeat it the one with the least label, then vector, stands.
    """
    vec = F.col("embedding").cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(~F.coalesce(odd, F.lit(True)))
    q = F.transform(vec, lambda x: F.floor(x * STEPS).cast("long"))
    rows = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), q.alias("q"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")
    label = F.when(F.pmod("vec_id", F.lit(SHIFTED)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    norm2 = F.aggregate("q", F.lit(0).cast("long"), lambda acc, x: acc + x * x)
    return one.select("vec_id", label.cast("int").alias("label"), norm2.alias("norm2"), "q")


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of the array column; shorter ones are filled up with zeros."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max(initial=0))
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class _Search:
    """The best ``k`` candidates of each window of a block of anchors, as buckets of candidates come by."""

    def __init__(self, anchors: pa.RecordBatch, k: int, same: bool):
        self.same, self.k = same, k
        self.id, self.label, norm2 = (anchors.column(i).to_numpy() for i in range(3))
        self.norm, self.q = np.sqrt(norm2.astype(np.float64)), _vectors(anchors.column(3))
        windows = anchors.column(4)
        self.anchor = np.repeat(np.arange(len(anchors)), np.diff(windows.offsets.to_numpy()))
        flat = windows.flatten()
        self.tag, self.positive, self.low, self.high = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        n = len(self.anchor)
        self.score = np.full((n, k), _LEAST, dtype=np.int64)  # best first
        self.found = np.full((n, k), _MOST, dtype=np.int64)
        self.count = np.zeros(n, dtype=np.int64)
        self.live = np.arange(n)

    def bucket(self, vec_id: np.ndarray, label: np.ndarray, norm2: np.ndarray, q: np.ndarray) -> bool:
        """Look at a bucket, its largest norm first; False if no later bucket can matter."""
        norm = float(norm2[0]) ** 0.5
        # The bound is rounded up; a row at the kth score itself can still win by its vec_id.
        bound = self.norm[self.anchor[self.live]] * norm * (1 + 1e-12) + 1e-6
        need = np.maximum(self.low[self.live], np.where(self.count[self.live] >= self.k, self.score[self.live, -1], _LEAST))
        self.live = self.live[bound >= need]
        if not len(self.live):
            return False
        order = np.argsort(vec_id, kind="stable")  # so that the first of equal scores is the smallest vec_id
        vec_id, label, q = vec_id[order], label[order], q[order]
        rows, at = np.unique(self.anchor[self.live], return_inverse=True)
        width = min(q.shape[1], self.q.shape[1])
        most = float(self.norm[rows].max()) * norm
        # Partial sums stay below the product of the norms: this type holds them all exactly.
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        product = self.q[rows, :width].astype(kind) @ q[:, :width].astype(kind).T
        wanted = self.label[rows][:, None] == label[None, :] if self.same else self.label[rows][:, None] != label[None, :]
        wanted &= self.id[rows][:, None] != vec_id[None, :]
        floor = -np.inf if kind is not np.int64 else _LEAST
        product = np.where(wanted, product, kind(floor))
        for begin in range(0, len(self.live), BLOCK):
            self._merge(self.live[begin : begin + BLOCK], at[begin : begin + BLOCK], product, wanted, vec_id)
        return True

    def _merge(self, w: np.ndarray, at: np.ndarray, product: np.ndarray, wanted: np.ndarray, vec_id: np.ndarray) -> None:
        held = product[at]
        fits = wanted[at] & (held >= np.maximum(self.low[w], self.score[w, -1])[:, None]) & (held <= self.high[w][:, None])
        some = fits.any(axis=1)
        w, held, fits = w[some], held[some], fits[some]
        out = -np.inf if held.dtype.kind == "f" else _LEAST
        held = np.where(fits, held, out)
        for _ in range(self.k):
            if not len(w):
                return
            best = held.argmax(axis=1)
            every = np.arange(len(w))
            score, vec = held[every, best], vec_id[best]
            there = fits[every, best]
            score = np.where(there, score, 0).astype(np.int64)
            last, last_id = self.score[w, -1], self.found[w, -1]
            better = there & ((score > last) | (score == last) & (vec < last_id))
            w, held, fits, best, score, vec = w[better], held[better], fits[better], best[better], score[better], vec[better]
            every = np.arange(len(w))
            held[every, best], fits[every, best] = out, False
            # Into its place among the best so far.
            scores, ids = np.column_stack([self.score[w], score]), np.column_stack([self.found[w], vec])
            order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
            self.score[w], self.found[w] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
            self.count[w] = np.minimum(self.count[w] + 1, self.k)

    def results(self) -> pa.RecordBatch:
        window, place = np.nonzero(np.arange(self.k)[None, :] < self.count[:, None])
        columns = self.id[self.anchor[window]], self.tag[window], self.positive[window], self.found[window, place], self.score[window, place]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "tag", "positive", "found", "score"])


def _searched(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (cell, candidate, vec_id, label, norm2, q, windows), sorted by cell, then anchors first, then norm from the largest."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, search, more = None, [], None, False
        for batch in batches:
            cells, side = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(cells)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                if cells[i] != cell:
                    if search is not None:
                        yield search.results()
                    cell, anchors, search, more = cells[i], [], None, True
                rows = batch.slice(i, j - i).select(["vec_id", "label", "norm2", "q", "windows"])
                if not side[i]:
                    anchors.append(rows)
                    continue
                if search is None and anchors:
                    search = _Search(pa.Table.from_batches(anchors).combine_chunks().to_batches()[0], k, same)
                for begin in range(0, j - i, BUCKET):
                    if search is None or not more:
                        break
                    part = rows.slice(begin, BUCKET)
                    more = search.bucket(*(part.column(c).to_numpy() for c in range(3)), _vectors(part.column(3)))
        if search is not None:
            yield search.results()

    return searched


def search(anchors: DataFrame, candidates: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, tag, positive, found, score, rank): the best ``k`` candidates, of the anchor's label or of another, in each of its windows.

    ``anchors`` has the columns of ``quantised`` and windows (tag, positive, low, high; tags name them apart); both are written tables.
    """
    spark = anchors.sparkSession
    n_anchors, n = anchors.count(), candidates.count()
    blocks = max(1, -(-n_anchors // BLOCK))
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-n // CHUNK), min(-(-cores // blocks), n // LEAST_CHUNK))
    # The norm that a candidate needs: the least over an anchor's windows. Blocks hold anchors of like needs.
    need = F.array_min(F.transform("windows", lambda w: w["low"].cast("double"))) / F.sqrt(F.greatest(F.col("norm2"), F.lit(1)).cast("double"))
    needing = anchors.withColumn("need", need)
    share = [i / blocks for i in range(1, blocks)]
    bounds = sorted(set(needing.agg(F.percentile_approx("need", share, 50 * blocks)).first()[0] or [])) if blocks > 1 else []
    groups = len(bounds) + 1
    # Equal needs share a group; it is split by hash, so that a block is bounded.
    group = F.size(F.filter(F.lit(bounds), lambda b: F.col("need") >= b)) if bounds else F.lit(0)
    needing = materialise(needing.withColumn("grp", group), "needs")
    sizes = {r[0]: (r[1], r[2]) for r in needing.groupBy("grp").agg(F.count(F.lit(1)), F.min("need")).collect()}  # one row for each block, about
    starts, least = [0], []
    for g in range(groups):
        members, low = sizes.get(g, (0, float("inf")))
        parts = max(1, -(-members // BLOCK))
        starts.append(starts[-1] + parts)
        least += [low] * parts
    first, parts = F.lit(starts)[F.col("grp")], F.lit([b - a for a, b in zip(starts, starts[1:], strict=False)])[F.col("grp")]
    block = (first + F.pmod(F.xxhash64("vec_id"), parts)).cast("long")
    columns = ["cell", "candidate", *[c.split()[0] for c in ROW.split(", ")], "windows"]
    cell: Callable[[Column, Column], Column] = lambda b, c: (b * chunks + c).cast("int")
    placed = needing.withColumn("block", block).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    placed = placed.withColumn("cell", cell(F.col("block"), F.col("chunk"))).withColumn("candidate", F.lit(False)).select(columns)
    # A candidate goes to the blocks whose least need its norm can meet.
    reach = F.transform(F.lit(least), lambda low, b: F.struct(b.alias("b"), low.alias("low")))
    norm = F.sqrt(F.col("norm2").cast("double")) * (1 + 1e-9) + 1e-6
    sent = candidates.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), F.col("vec_id")), F.lit(chunks)))
    sent = sent.withColumn("to", F.explode(F.filter(reach, lambda r: r["low"] <= norm)))
    sent = sent.withColumn("cell", cell(F.col("to.b"), F.col("chunk"))).withColumn("candidate", F.lit(True)).withColumn("windows", F.lit(None).cast(WINDOWS)).select(columns)
    both = placed.unionByName(sent)
    n_cells = starts[-1] * chunks
    dealt = both.repartitionById(n_cells, "cell") if n_cells <= 4 * cores else both.repartition(4 * cores, "cell")
    dealt = dealt.sortWithinPartitions("cell", "candidate", F.col("norm2").desc(), "vec_id")
    found = dealt.mapInArrow(tidy(_searched(k, same)), "anchor_id long, tag long, positive long, found long, score long")
    # Of each window the best of all chunks, k of each at most.
    ranked = found.groupBy("anchor_id", "tag", "positive").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "found"))), 1, k).alias("best"))
    return ranked.select("anchor_id", "tag", "positive", F.posexplode("best").alias("at", "b")).select("anchor_id", "tag", "positive", F.col("b.found").alias("found"), (-F.col("b.minus")).alias("score"), (F.col("at") + 1).cast("int").alias("rank"))


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; anchors are the rows whose vec_id is divisible by ``ANCHORS``.

    Scores are exact integers; higher ones come first, ties by smaller vec_id. An anchor without positives, or a positive without rows in its window,
    gives no rows; a positive score below zero has an empty window. Rows that take no part, null and repeated vec_ids: see ``quantised``. Of vectors of
    different lengths the shorter is filled up with zeros; an empty one scores 0. A squared norm beyond 64 bits raises. An empty table gives no rows.
    Other columns than vec_id, embedding and label are not looked at.
    """
    rows = materialise(quantised(embeddings), "quantised")
    anchors = rows.filter(F.pmod("vec_id", F.lit(ANCHORS)) == 0)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("tag"), F.lit(0).cast("long").alias("positive"), F.lit(_LEAST + 1).alias("low"), F.lit(_MOST).alias("high")))
    positives = materialise(search(anchors.withColumn("windows", everything), rows, POSITIVES, True), "positives")
    p = F.col("score")
    low, high = F.expr(f"({LOW} * score + pmod(-{LOW} * score, 100)) div 100"), F.expr(f"({HIGH} * score - pmod({HIGH} * score, 100)) div 100")
    windows = positives.filter(p >= 0).groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("found").alias("tag"), p.alias("positive"), low.alias("low"), high.alias("high"))).alias("windows"))  # POSITIVES at most
    asking = materialise(anchors.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "windows")
    found = search(asking, rows, NEGATIVES, False)
    return found.select("anchor_id", F.col("tag").alias("positive_id"), "rank", F.col("found").alias("negative_id"), F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score FROM vecs a JOIN vecs c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 3
"""
