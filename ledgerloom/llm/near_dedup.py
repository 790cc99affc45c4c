"""Near-duplicate documents by SuperMinHash.

Signatures: every shingle deals its ranks over the signature's places by a
permutation of its own, so that the places of a set are correlated and vary
less than independent minima. The ranks are dealt level by level; a document
stops when no later level could lower a place.

1. Documents with equal shingle sets fold into their smallest doc_id.
2. Bands of the signature make buckets; each document is paired with the
   smallest of its bucket, and pairs are verified on the full sets.
3. Verified links are grouped by union-find. In buckets whose members are not
   in one group yet, members of different groups are compared too, in blocks,
   on the full sets; of the links found there a spanning forest goes on.

Joins with texts always shuffle, whatever the sizes: the plan is the same for
every input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_one, materialise
from ledgerloom.llm.components import components, union
from ledgerloom.llm.rolling import Hashes, column_bytes, mix, row_groups
from ledgerloom.llm.worker import tidy

SHINGLE = 5
#: A link has 100 * intersection >= PERCENT * union.
PERCENT = 75
#: At similarity 0.75, a pair shares none of 32 bands of 4 with a probability of 5e-6.
BANDS, ROWS = 32, 4
PLACES = BANDS * ROWS
#: Members of a bucket that are compared in one block, and shingles that are counted at once.
BLOCK, COLUMNS = 1024, 4096
#: Bytes of text whose signatures are made at once.
BATCH = 1 << 20
#: Bytes of a long text whose words are hashed at once, and elements of sets that are dealt at once.
SEGMENT, PIECE = 4 << 20, 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the words of the texts data[begins[i]:begins[i+1]], a segment at a time; only a word of over ``SEGMENT`` bytes, hashed by itself, is held whole."""
    rows, hashes, at, n = [], [], 0, len(data)
    while at < n:
        end = min(at + SEGMENT, n)
        if end < n:
            # The segment ends where no word goes on: behind white space or where a text begins.
            space = np.flatnonzero(_SPACE[data[at:end]])
            border = begins[np.searchsorted(begins, end, side="right") - 1]
            end = max(at + int(space[-1]) + 1 if len(space) else 0, int(border))
            if end <= at:
                end = at + SEGMENT
                while end < n and not _SPACE[data[end : end + SEGMENT]].any():
                    end += SEGMENT
                end = min(end + int(_SPACE[data[end : end + SEGMENT]].argmax()) if end < n else n, int(begins[np.searchsorted(begins, at, side="right")]))
        part = _LOWER[data[at:end]]
        inside = ~_SPACE[part]
        cut = np.zeros(len(part) + 1, dtype=bool)  # a text begins here
        cut[begins[(begins >= at) & (begins <= end)] - at] = True
        starts = np.flatnonzero(inside & (cut[:-1] | np.append(True, ~inside[:-1])))
        ends = np.flatnonzero(inside & (cut[1:] | np.append(~inside[1:], True))) + 1
        long = ends - starts > SEGMENT
        if long.any():
            word = np.array([int.from_bytes(hashlib.blake2b(part[i:j], digest_size=8).digest(), "little") for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], dtype=np.uint64)
        else:
            word = Hashes(part).of(starts, ends)
        rows.append(np.searchsorted(begins, starts + at, side="right") - 1)
        hashes.append(word)
        at = end
    return (np.concatenate(rows), np.concatenate(hashes)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash), sorted and distinct, of texts in UTF-8."""
    row, word = _word_hashes(data[int(offsets[0]) : int(offsets[-1])], offsets - int(offsets[0]))
    words = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(words) - words
    # Windows of SHINGLE words within a text; with fewer words, all of them as one.
    out_row, out_hash = [], []
    if len(word) >= SHINGLE:
        whole = np.flatnonzero(row[SHINGLE - 1 :] == row[: len(row) - SHINGLE + 1])
        h = np.zeros(len(whole), dtype=np.uint64)
        for i in range(SHINGLE):
            h = mix(h * np.uint64(3) + word[whole + i])
        out_row.append(row[whole])
        out_hash.append(h)
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    h = np.zeros(len(short), dtype=np.uint64)
    for i in range(SHINGLE - 1):
        live = words[short] > i
        h[live] = mix(h[live] * np.uint64(3) + word[first[short[live]] + i])
    out_row.append(short)
    out_hash.append(mix(h + np.uint64(1)))
    row, h = np.concatenate(out_row), np.concatenate(out_hash)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.append(np.ones(min(1, len(row)), dtype=bool), (row[1:] != row[:-1]) | (h[1:] != h[:-1]))
    return row[new], h[new]


def super_min_hash(row: np.ndarray, h: np.ndarray, n_rows: int, places: int = PLACES) -> np.ndarray:
    """Signatures of sets: ``row`` and ``h`` give the elements; a row without elements keeps the largest value.

    At level j an element's value is j plus a uniform rank, at the j-th place of its permutation (Fisher and Yates, dealt as far as needed).
    ``PIECE`` elements are dealt at once; minima of pieces are those of the whole, whatever the length of a text.
    """
    best = np.full(n_rows * places, np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(h), PIECE):
        _deal(best, row[begin : begin + PIECE], h[begin : begin + PIECE], n_rows, places)
    return best.reshape(n_rows, places)


def _deal(best: np.ndarray, row: np.ndarray, h: np.ndarray, n_rows: int, places: int) -> None:
    """Lower ``best``, in place, by the elements given."""
    order = np.tile(np.arange(places, dtype=np.uint8), (len(h), 1))
    for j in range(places):
        if not len(h):
            break
        random = mix(h + np.uint64((j + 1) * int(_GOLDEN) % (1 << 64)))
        k = j + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        every = np.arange(len(h))
        place = order[every, k]
        order[every, k] = order[:, j]
        np.minimum.at(best, row * places + place, np.uint64(j << 32) | random >> np.uint64(32))
        # Early stop: what follows is at least j + 1.
        done = best.reshape(n_rows, places).max(axis=1) < np.uint64((j + 1) << 32)
        live = ~done[row]
        if not live.all():
            row, h, order = row[live], h[live], order[live]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_shingles, set_1, set_2, bands)."""
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        for i, j in row_groups(offsets, BATCH):
            row, h = shingle_sets(data, offsets[i : j + 1])
            n = j - i
            best = super_min_hash(row, h, n)
            keys = np.zeros((n, BANDS), dtype=np.uint64)
            for r in range(ROWS):
                keys = mix(keys * np.uint64(5) + best[:, r::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
            sums = np.zeros((2, n), dtype=np.uint64)
            np.add.at(sums[0], row, mix(h ^ _GOLDEN))
            np.add.at(sums[1], row, mix(h + _GOLDEN))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, n),
                    pa.array(np.bincount(row, minlength=n)),
                    *(pa.array(s.view(np.int64)) for s in sums),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel().view(np.int64))),
                ],
                names=["doc_id", "n_shingles", "set_1", "set_2", "bands"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``. A null or empty text, or one of white space, has n_shingles 0."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_signed), "doc_id long, n_shingles long, set_1 long, set_2 long, bands array<long>")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text of a, text of b) to the pairs that are links; the set of a repeated b is kept."""
    last: tuple[int, np.ndarray] | None = None
    for batch in batches:
        keep = []
        a_data, a_offsets = column_bytes(batch.column(2))
        b_data, b_offsets = column_bytes(batch.column(3))
        for i, b in enumerate(batch.column(1).to_pylist()):
            if last is None or last[0] != b:
                last = b, shingle_sets(b_data, b_offsets[i : i + 2])[1]
            x, y = shingle_sets(a_data, a_offsets[i : i + 2])[1], last[1]
            common = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)) else 0
            keep.append(common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b), by the full sets of both texts."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text"))
    both = b.join(a.join(pairs.hint("shuffle_hash"), "a"), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(tidy(_verified), "a long, b long")


def _block_links(doc: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, texts: pa.Array) -> list[tuple[int, int]]:
    """A spanning forest of the links between members ``left`` and ``right`` (masks) of different components, on the full sets."""
    row, h = shingle_sets(*column_bytes(texts))
    n = np.bincount(row, minlength=len(doc))
    # Members of the largest component need no comparison among themselves.
    labels, sizes = np.unique(component, return_counts=True)
    few = np.flatnonzero(component != labels[sizes.argmax()])
    place, count = np.unique(h, return_inverse=True, return_counts=True)[1:]
    shared = count[place] > 1
    row, place = row[shared], np.unique(place[shared], return_inverse=True)[1] if shared.any() else place[shared]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    common = np.zeros((len(few), len(doc)), dtype=np.float32)
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        i, j = np.searchsorted(place, [begin, begin + COLUMNS])
        held = np.zeros((len(doc), COLUMNS), dtype=np.float32)
        held[row[i:j], place[i:j] - begin] = 1
        common += held[few] @ held.T
    linked = (100 * common >= PERCENT * (n[few][:, None] + n[None, :] - common)) & (common > 0) & (component[few][:, None] != component[None, :])
    linked &= left[few][:, None] & right[None, :] | right[few][:, None] & left[None, :]
    parent: dict[int, int] = {}
    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        if union(parent, int(component[few[i]]), int(component[j])):
            out.append((int(max(doc[few[i]], doc[j])), int(min(doc[few[i]], doc[j]))))
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, x, y, side, doc_id, component, text), sorted by (key, x, y), to links between different components."""
    held: list[pa.RecordBatch] = []

    def links(rows: pa.Table) -> pa.RecordBatch:
        x, y, side, doc, component = (rows.column(i).to_numpy() for i in range(1, 6))
        found = _block_links(doc, component, side == x, side == y, rows.column(6).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        marks = np.stack([batch.column(i).to_numpy() for i in range(3)])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and [c[0].as_py() for c in held[0].columns[:3]] != marks[:, i].tolist():
                yield links(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield links(pa.Table.from_batches(held))


def _across(buckets: DataFrame, grouped: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of documents that share a bucket and are in different components so far: enough of them to connect what is linked.

    Buckets are compared in blocks: each pair of blocks of a bucket is a task's work, and no member is left out. Of buckets with the same members one is enough.
    """
    labelled = buckets.join(grouped, buckets.doc_id == grouped.node, "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("who")).filter("low < high")
    mixed = mixed.groupBy("size", "who").agg(F.min("key").alias("key"))
    members = labelled.join(mixed.select("key", F.ceil(F.col("size") / BLOCK).alias("blocks")), "key").withColumn("side", F.pmod(F.xxhash64("doc_id"), "blocks"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("key", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "doc_id", "component")
    rows = texts.join(members.hint("shuffle_hash"), "doc_id").select("key", "x", "y", "side", "doc_id", "component", "text")
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(tidy(_compared), "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    component_id is the smallest doc_id that links reach; kept marks the row whose doc_id it is. A row without words is linked with nothing.
    A null doc_id has the component null and is kept. Rows that repeat a doc_id are one document: they share its component. An empty table gives no rows.
    Very long texts are hashed and dealt in pieces. Exact copies are told by two 64-bit sums over their sets and the sets' sizes; all other links are confirmed on the full sets.
    Other columns than doc_id and text are not looked at.
    """
    signed = materialise(signatures(docs), "signatures")
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    key = ["set_1", "set_2", "n_shingles"]
    sets = materialise(filled.groupBy(*key).agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("members")), "sets")
    several = sets.filter("members > 1")
    copies = join_one(filled.select("doc_id", *key), several, key, "members").filter("doc_id != first_id").select(F.col("doc_id").alias("a"), F.col("first_id").alias("b"))
    copies = materialise(copies, "copies")
    firsts = filled.join(sets.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "set_1", "set_2"])
    buckets = firsts.select("doc_id", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("doc_id").alias("center"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = materialise(buckets.join(shared, "key").select("key", "doc_id", "center"), "buckets")
    pairs = materialise(buckets.filter("doc_id > center").select(F.col("doc_id").alias("a"), F.col("center").alias("b")).distinct(), "pairs")
    # Texts of the documents that share a bucket with another; all others are linked with nothing.
    wanted = buckets.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    texts = materialise(texts, "texts_of_buckets")
    links = materialise(_verify(pairs, texts), "links")
    grouped = components(copies.unionByName(links))
    more = materialise(_across(buckets.select("key", "doc_id"), grouped, texts), "more_links")
    if more.take(1):
        grouped = components(copies.unionByName(links).unionByName(more))
    return signed.select("doc_id", "n_shingles").join(grouped, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group; of rows that repeat a doc_id, one. A null doc_id stays."""
    dropped = near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").take(1)
    if repeated:
        left = left.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.filter("doc_id is null"))
    return left


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Copies are folded first, so that shingles are joined between different sets only.
ORACLE_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), classes AS (
  SELECT min(doc_id) AS id, md5(array_to_string(s, chr(10))) AS k, len(s) AS n, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY 2, 3
), shingles AS (
  SELECT id, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT id, id AS r FROM classes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r
), roots AS (
  SELECT id, min(r) AS root FROM reach GROUP BY id
), found AS (
  SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(r.root, s.doc_id) AS component_id FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND c.n = len(s.s) AND c.k = md5(array_to_string(s.s, chr(10))) LEFT JOIN roots r ON r.id = c.id
)
SELECT *, component_id = doc_id AS kept FROM found
"""
