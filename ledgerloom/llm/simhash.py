"""Near-duplicate documents by SimHash, found through a Gray-order hierarchical index.

1. A document's fingerprint is the majority of its shingles' XXH64 bits.
   Documents of one fingerprint fold into it before anything is compared.
2. Fingerprints are dealt by Gray rank into ranges of equal size. A range's
   shared bits are its node at the top of the index: a fingerprint is sent to
   the ranges, from its own on, whose bits differ by no more than the radius.
3. Each range builds its index and searches it, block by block; what is found
   is united at once, and of it a forest goes on to the union-find.

At most 2,081 fingerprints lie within two bits of one, so that the work grows
with the number of fingerprints, not with the square of a group's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_one, materialise
from ledgerloom.llm.components import components
from ledgerloom.llm.gray_index import GrayIndex, gray_rank
from ledgerloom.llm.rolling import column_bytes
from ledgerloom.llm.words import NOT_SPACE, Piece, pieces
from ledgerloom.llm.worker import tidy

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of a range, and ranges at least: a function of the input alone, so that the plan is the same on every cluster.
RANGE, RANGES = 1 << 18, 64
#: Queries that are searched between two looks at what is united.
BLOCK = 1024
_SIGN = np.uint64(1 << 63)


def shingle_hashes(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(row, XXH64) of each shingle, repeats included, of the piece's texts."""
    row, length = piece.row, piece.end - piece.start
    # The words, each followed by one space.
    place = np.cumsum(length + 1) - (length + 1)
    source = np.repeat(piece.start - place, length + 1) + np.arange(int((length + 1).sum()))
    joined = piece.data[np.minimum(source, max(len(piece.data) - 1, 0))] if len(source) else np.zeros(0, np.uint8)
    joined[place + length] = 0x20
    at = np.flatnonzero(row[SHINGLE - 1 :] == row[: max(len(row) - SHINGLE + 1, 0)])
    begin, end, of = place[at], place[at + SHINGLE - 1] + length[at + SHINGLE - 1], row[at]
    if piece.whole:
        words = np.bincount(row, minlength=piece.n)
        short = np.flatnonzero((words > 0) & (words < SHINGLE))
        first = (np.cumsum(words) - words)[short]
        last = first + words[short] - 1
        begin, end, of = np.append(begin, place[first]), np.append(end, place[last] + length[last]), np.append(of, short)
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    return of, np.fromiter((digest(text[i:j], SEED) for i, j in zip(begin.tolist(), end.tolist(), strict=True)), dtype=np.uint64, count=len(begin))


def fingerprints_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, fingerprint) of each text in UTF-8; a text without words has zero of both."""
    n = len(offsets) - 1
    shingles, ones = np.zeros(n, dtype=np.int64), np.zeros((n, 64), dtype=np.int64)
    for piece in pieces(data, offsets, NOT_SPACE, SHINGLE - 1):
        row, h = shingle_hashes(piece)
        if not len(h):
            continue
        order = np.argsort(row, kind="stable")
        row, h = row[order] + piece.first, h[order]
        at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones[row[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.uint32)
        shingles[row[at]] += np.diff(np.append(at, len(row)))
    return shingles, np.packbits(2 * ones > shingles[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shingles, code = fingerprints_of(*column_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shingles), pa.array(code.view(np.int64)), pa.array((gray_rank(code) ^ _SIGN).view(np.int64))], names=["doc_id", "n_shingles", "code", "rank"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, code (the fingerprint's 64 bits) and rank (its Gray rank less 2^63) for every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_signed), "doc_id long, n_shingles long, code long, rank long")


def _range_of(bounds: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    limits = np.array(bounds, dtype=np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(limits, batch.column(1).to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at)], names=["code", "rank", "at"])

    return placed


def _routed(ids: list[int], patterns: list[int], masks: list[int], radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = np.array(ids, dtype=np.int32)
        top = GrayIndex(np.array(patterns, dtype=np.int64).view(np.uint64), np.array(masks, dtype=np.int64).view(np.uint64))
        for batch in batches:
            code, rank, at = (batch.column(k).to_numpy() for k in range(3))
            q, node = top.search(np.ascontiguousarray(code).view(np.uint64), radius)
            ahead = target[node] >= at[q]
            q, to = q[ahead], target[node[ahead]]
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(to != at[q]), pa.array(rank[q]), pa.array(code[q])], names=["target", "guest", "rank", "code"])

    return routed


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent``, in which every entry is a root, after the sets of a[i] and b[i] are joined under the smaller root."""
    while len(a):
        x, y = parent[a], parent[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := parent[parent], parent):
            parent = above
    return parent


def _searched(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (target, guest, rank, code), sorted so, to links that connect what is within the radius."""

    def rows(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    class Range:
        def __init__(self) -> None:
            self.parts: list[np.ndarray] = []
            self.index: GrayIndex | None = None

        def build(self) -> None:
            self.codes = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
            self.index = GrayIndex(self.codes)
            # Neighbours in the order are often near: what they connect needs no search.
            i = np.flatnonzero(np.bitwise_count(self.codes[1:] ^ self.codes[:-1]) <= radius)
            self.root = _unite(np.arange(len(self.codes)), i, i + 1)
            for k in range(0, len(self.codes), BLOCK):
                q, c = self.index.search(self.codes[k : k + BLOCK], radius, self.root, self.root[k : k + BLOCK])
                self.root = _unite(self.root, q + k, c)

        def guests(self, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(codes), BLOCK):
                q, c = self.index.search(codes[k : k + BLOCK], radius)
                if len(q):
                    order = np.argsort(q, kind="stable")
                    q, c = q[order], c[order]
                    head = np.append(True, q[1:] != q[:-1])
                    first = c[head]
                    self.root = _unite(self.root, first[np.cumsum(head) - 1], c)
                    yield rows(codes[k : k + BLOCK][q[head]], self.codes[first])

        def links(self) -> Iterator[pa.RecordBatch]:
            if self.index is None:
                self.build()
            member = np.flatnonzero(self.root != np.arange(len(self.codes)))
            if len(member):
                yield rows(self.codes[member], self.codes[self.root[member]])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, held = None, Range()
        for batch in batches:
            to, guest = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            code = np.ascontiguousarray(batch.column(3).to_numpy()).view(np.uint64)
            cuts = [0, *(np.flatnonzero((to[1:] != to[:-1]) | (guest[1:] != guest[:-1])) + 1).tolist(), len(to)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                if to[i] != target:
                    yield from held.links()
                    target, held = to[i], Range()
                if not guest[i]:
                    held.parts.append(code[i:j])
                    continue
                if held.index is None:
                    held.build()
                yield from held.guests(code[i:j])
        yield from held.links()

    return searched


def near_codes(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect all codes of ``codes`` (code, rank; distinct) that differ in at most ``radius`` bits, directly or by way of others."""
    n = codes.count()
    ranges = max(RANGES, -(-n // RANGE))
    share = [k / ranges for k in range(1, ranges)]
    bounds = codes.agg(F.percentile_approx("rank", share, 50 * ranges)).first()[0] or []
    placed = codes.select("code", "rank").mapInArrow(_range_of(sorted(set(bounds))), "code long, rank long, at int")
    tops = sorted(map(tuple, placed.groupBy("at").agg(F.bit_and("code"), F.bit_or("code")).collect()))  # one row for each range
    ids, patterns = [r[0] for r in tops], [r[1] for r in tops]
    masks = [~(r[1] ^ r[2]) for r in tops]
    routed = placed.mapInArrow(_routed(ids, patterns, masks, radius), "target int, guest boolean, rank long, code long")
    dealt = routed.repartitionById(ranges, "target").sortWithinPartitions("target", "guest", "rank")
    return dealt.mapInArrow(tidy(_searched(radius)), "u long, v long")


def similar_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), n_shingles, component_id for every row of ``docs``.

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach. Null and empty texts, and those of white space, have
    the fingerprint zero and are linked like any other. A row with a null doc_id links others but names no component: its component_id is null only
    where no row reachable has a doc_id. Rows that repeat a doc_id each have their own fingerprint, and so perhaps components of their own.
    Very long texts are hashed by segments. An empty table gives no rows. Other columns than doc_id and text are not looked at.
    """
    signed = materialise(fingerprints(docs), "fingerprints")
    codes = materialise(signed.groupBy("code", "rank").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("members")), "codes")
    grouped = components(materialise(near_codes(codes, radius), "links"))
    rooted = codes.join(grouped, codes.code == grouped.node, "left").select("code", "first_id", "members", F.coalesce("component", "code").alias("root"))
    rooted = materialise(rooted, "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_codes")), "roots")
    named = materialise(join_one(rooted, least, ["root"], "n_codes").select("code", "members", "component_id"), "named")
    return join_one(signed, named, ["code"], "members").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "n_shingles", "component_id")


def op12_simhash(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
