"""Suffix-array dedup: bytes covered by a string that an earlier document also holds.

Every window of ``WINDOW`` bytes has an anchor: of the ``GRAM``-byte strings in
it, the leftmost with the least hash. Equal windows have equal anchors at equal
places, so windows are compared only with windows of the same anchor.
Consecutive windows with one anchor form a run, shipped as one string.

1. ``_find``: each task marks runs that a smaller document of its batch also
   has, and ships the anchors of the others (hash, document, place), packed.
   Anchors that several documents share are asked for. Of an anchor that is
   frequent in a batch only two entries are shipped, so that no task gets all
   entries of a very common passage; its runs are asked for at once.
2. ``_send``: the asked-for runs are shipped as strings, to the task of their
   anchor. Anchors with very many different runs are dealt out window by
   window, by the hash of the window.
3. ``_compare``: the suffixes at which runs begin are sorted by deep-shallow
   sorting, within their anchors, and groups of equal runs settled by their
   smallest document. Of different runs that share an anchor, the suffixes at
   all windows are sorted, and groups of equal windows settled likewise.
4. Marked spans are joined to the texts, which lie bucketed by document.

Hashes only choose what is compared; every removal rests on equal bytes.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh_path, materialise, partitions_for
from ledgerloom.llm.deep_shallow import sort_suffixes
from ledgerloom.llm.rolling import BYTE_VALUES, Hashes, column_bytes, mix, row_groups
from ledgerloom.llm.worker import tidy

WINDOW, GRAM = 50, 18
SPAN = WINDOW - GRAM + 1
#: The longest run has SPAN windows.
WIDTH = WINDOW + SPAN - 1
#: Bytes that are hashed at once, and the bits that hold a place among them.
CHUNK, PLACE_BITS = 1 << 20, 20
#: Bytes of text whose runs are compared within a map task.
BATCH = 8 << 20
#: Entries of one anchor in one task above which its windows are dealt out.
HOT_ANCHOR = 20_000
#: Entries of one anchor in one batch, of several documents, above which only two are shipped.
HOT_IN_BATCH = 256
#: The place of an entry that stands for those of a hot anchor.
HOT_ENTRY = (1 << 32) - 1
#: Strings whose windows are sorted at once.
SORTED_TOGETHER = 10_000
#: Kinds of messages to documents; ``WIDE`` is added where a place needs more than 32 bits.
#: Bytes of text whose anchors are packed together, parts of the anchors at most, and bytes of an Arrow array at most.
FLUSH, MOST_PARTS, LARGEST_ARRAY = 24 << 20, 100_000, 1 << 30
ASK, MARK, WIDE = 0, 1, 2
_PACKED = "part int, kind int, data binary"
_PACKED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
_ROWS = "doc_id long, tkey long, kind int, data binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])


def runs_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, length, anchor hash, content hash) of the runs of the texts data[offsets[i]:offsets[i+1]]; starts count from the text's first byte."""
    # Long texts are cut into segments that share WINDOW - 1 bytes; short ones lie together.
    first, last, row = [], [], []
    for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while e - s > CHUNK:
            first.append(s), last.append(s + CHUNK), row.append(i)
            s += CHUNK - WINDOW + 1
        if e - s >= WINDOW:
            first.append(s), last.append(e), row.append(i)
    i = 0
    while i < len(first):
        j, size = i, 0
        while j < len(first) and size + last[j] - first[j] <= CHUNK:
            size += last[j] - first[j]
            j += 1
        segments = np.array(first[i:j]), np.array(last[i:j])
        chunk = np.concatenate([data[s:e] for s, e in zip(*segments, strict=True)])
        begins = np.concatenate(([0], np.cumsum(segments[1] - segments[0])))
        starts, lengths, anchors, contents = _chunk_runs(chunk, begins)
        k = np.searchsorted(begins, starts, side="right") - 1
        rows = np.array(row[i:j])[k]
        yield rows, starts - begins[k] + segments[0][k] - offsets[rows], lengths, anchors, contents
        i = j


def _chunk_runs(chunk: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    hashes = Hashes(chunk)
    grams = hashes.grams(GRAM)
    places = np.uint64((1 << PLACE_BITS) - 1)
    least = grams & ~places
    least |= np.arange(len(least), dtype=np.uint64)
    step = 1
    while step * 2 <= SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if SPAN > step:
        least = np.minimum(least[: step - SPAN], least[SPAN - step :])
    inside = np.ones(len(chunk), dtype=bool)
    for end in begins[1:].tolist():
        inside[max(0, end - WINDOW + 1) : end] = False
    windows = np.flatnonzero(inside[: len(least)])
    anchor = (least[windows] & places).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (np.diff(windows) != 1) | (np.diff(anchor) != 0)))) if len(windows) else windows
    starts = windows[new]
    lengths = np.diff(np.append(new, len(windows))) + WINDOW - 1
    return starts, lengths, grams[anchor[new]] >> np.uint64(PLACE_BITS), hashes.of(starts, starts + lengths) + lengths.astype(np.uint64)


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The strings as rows of WIDTH bytes, filled up with zeros."""
    padded = np.concatenate((data, np.zeros(WIDTH, np.uint8)))
    rows = np.lib.stride_tricks.as_strided(padded, shape=(len(data) + 1, WIDTH), strides=(1, 1))[starts]
    return rows * (np.arange(WIDTH) < lengths[:, None]).astype(np.uint8)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes, a column at a time to spare memory."""
    h = np.zeros(len(rows), dtype=np.uint64)
    for column in rows.T:
        h = h * np.uint64(0x100000001B3) + BYTE_VALUES[column]
    return mix(h)


def _settle(key: np.ndarray, doc: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(kept, later): rows with the bytes, checked by ``same``, of a row of the same key and a smaller document are later; all others are kept."""
    order = np.lexsort((doc, key))
    new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, bool)
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    copy, original = order[~new], head[~new]
    later = same(copy, original) & (doc[copy] > doc[original])
    return np.concatenate((order[new], copy[~later])), copy[later]


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight together: they compress well."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()


def _unplanes(raw: memoryview, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _packed(columns: list[np.ndarray], extra: bytes = b"") -> bytes:
    body = b"".join(map(_planes, columns)) + extra
    return struct.pack("<I", len(columns[0])) + zstandard.ZstdCompressor(level=3).compress(body)


def _unpacked(raw: bytes, kinds: list[type]) -> tuple[list[np.ndarray], memoryview]:
    n = struct.unpack_from("<I", raw)[0]
    body, at, out = memoryview(zstandard.ZstdDecompressor().decompress(raw[4:])), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize * n
        out.append(_unplanes(body[at : at + size], n, kind))
        at += size
    return out, body[at:]


def _by_document(kind: int, doc: np.ndarray, tkey: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each document with its ``values`` (rows of integers)."""
    order, wide = np.lexsort((tkey, doc)), bool(values.max() >> 32)
    doc, tkey, values = doc[order], tkey[order], np.ascontiguousarray(values[order], dtype="<i8" if wide else "<u4")
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tkey[1:] != tkey[:-1]))))
    size = values.itemsize * values.shape[1]
    bounds = np.append(new, len(doc))
    # Offsets of an array have 32 bits: what is larger goes in several.
    i = 0
    while i < len(new):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + LARGEST_ARRAY // size, side="right")) - 1)
        own = values[bounds[i] : bounds[j]]
        data = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(((bounds[i : j + 1] - bounds[i]) * size).astype(np.int32)), pa.py_buffer(own.tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(doc[new[i:j]]), pa.array(tkey[new[i:j]]), pa.array(np.full(j - i, kind + WIDE * wide, np.int32)), data], schema=_ARROW)
        i = j


def _by_part(part: np.ndarray, n_parts: int, pack: Callable[[np.ndarray], bytes], kind: int = -1) -> Iterator[pa.RecordBatch]:
    order = np.argsort(part, kind="stable")
    own, ends = np.unique(part[order], return_index=True)
    rows = [(p, pack(order[i:j])) for p, i, j in zip(own.tolist(), ends.tolist(), [*ends[1:].tolist(), len(order)], strict=True)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array(np.full(len(rows), kind, np.int32)), pa.array([x for _, x in rows], pa.binary())], schema=_PACKED_ARROW)


def _to_documents(kind: int, n_parts: int, doc: np.ndarray, tkey: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Values (rows of integers) packed for the part that gathers their documents."""
    if not len(doc):
        return
    values = values.reshape(len(doc), -1)
    columns = [doc.astype(np.int64), tkey.astype(np.int64), *(values[:, i].astype("<i8") for i in range(values.shape[1]))]
    part = (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(n_parts)).astype(np.int64)
    yield from _by_part(part, n_parts, lambda rows: _packed([c[rows] for c in columns]), kind)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What was packed for a part's documents, a row for each document and kind."""
    for kind, width in ((ASK, 1), (MARK, 2)):
        if kind == ASK:
            held = [(k, raw) for batch in batches for k, raw in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        rows = [_unpacked(raw, [np.int64, np.int64, *[np.int64] * width])[0] for k, raw in held if k == kind]
        if rows:
            doc, tkey, *values = (np.concatenate(x) for x in zip(*rows, strict=True))
            yield from _by_document(kind, doc, tkey, np.stack(values, axis=1))


def packed_anchors(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], n_parts: int) -> Iterator[pa.RecordBatch]:
    """(anchors, doc_ids, starts, bytes of text) packed for the parts; each part gets the ids of its own rows and no others."""
    if not held:
        return
    anchor, doc, start = (np.concatenate(x) for x in list(zip(*held, strict=True))[:3])
    order = np.argsort(anchor, kind="stable")
    anchor, doc, start = anchor[order], doc[order], start[order]

    def pack(rows: np.ndarray) -> bytes:
        ids, own = np.unique(doc[rows], return_inverse=True)
        return _packed([np.diff(anchor[rows], prepend=np.uint64(0)), own.astype("<u4"), start[rows]], _planes(np.diff(ids, prepend=np.int64(0))))

    yield from _by_part((anchor % np.uint64(n_parts)).astype(np.int64), n_parts, pack)


def _find(n_parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, tkey, text) to marks and packed anchors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
        for batch in batches:
            doc_ids, tkeys = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), dtype=np.int64) for i in (0, 1))
            data, offsets = column_bytes(batch.column(2))
            for i, j in row_groups(offsets, BATCH):
                yield from found(data, offsets[i : j + 1], doc_ids[i:j], tkeys[i:j], held)
                if sum(h[3] for h in held) >= FLUSH:
                    yield from packed_anchors(held, n_parts)
                    held.clear()
        yield from packed_anchors(held, n_parts)

    def found(data: np.ndarray, offsets: np.ndarray, doc_ids: np.ndarray, tkeys: np.ndarray, held: list) -> Iterator[pa.RecordBatch]:
        some = list(runs_of(data, offsets))
        if not some:
            return
        row, start, length, anchor, key = map(np.concatenate, zip(*some, strict=True))
        at = offsets[row] + start
        data = data[: offsets[-1]]
        same = lambda a, b: (length[a] == length[b]) & (_matrix(data, at[a], length[a]) == _matrix(data, at[b], length[b])).all(axis=1)
        kept, later = _settle(key, doc_ids[row], same)
        yield from _to_documents(MARK, n_parts, doc_ids[row[later]], tkeys[row[later]], np.stack((start[later], start[later] + length[later]), axis=1))
        kept = kept[np.argsort(anchor[kept], kind="stable")]
        heads = np.flatnonzero(np.append(True, anchor[kept][1:] != anchor[kept][:-1]))
        sizes = np.diff(np.append(heads, len(kept)))
        own = doc_ids[row[kept]]
        low, high = np.minimum.reduceat(own, heads), np.maximum.reduceat(own, heads)
        hot = (sizes > HOT_IN_BATCH) & (low < high)
        if hot.any():
            many = np.repeat(hot, sizes)
            asked = kept[many]
            yield from _to_documents(ASK, n_parts, doc_ids[row[asked]], np.zeros(len(asked), np.int64), start[asked] * 2 + 1)
            # The first entries of the least and of the greatest document stand for all.
            stand = np.zeros(len(kept), dtype=bool)
            for end in (low, high):
                place = np.flatnonzero(many & (own == np.repeat(end, sizes)))
                stand[place[np.unique(np.searchsorted(heads, place, side="right"), return_index=True)[1]]] = True
            start[kept[stand]] = HOT_ENTRY
            kept = kept[~many | stand]
        held.append((anchor[kept], doc_ids[row[kept]], start[kept].astype("<u4"), int(offsets[-1] - offsets[0])))

    return find


def _ask(n_parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All packed anchors of a part to what is asked of each document: starts of runs, doubled, odd where the anchor is hot. Marks pass."""
    most = HOT_ANCHOR
    return lambda batches: _asked(batches, n_parts, most)


def _asked(batches: Iterator[pa.RecordBatch], n_parts: int, most: int) -> Iterator[pa.RecordBatch]:
    all_rows: list[list[np.ndarray]] = []
    for batch in batches:
        kinds = batch.column(1).to_numpy()
        if (kinds >= 0).any():
            yield batch.filter(pa.array(kinds >= 0))
        for raw in batch.column(2).filter(pa.array(kinds < 0)).to_pylist():
            (gaps, row, start), documents = _unpacked(raw, [np.uint64, np.uint32, np.uint32])
            ids = np.cumsum(_unplanes(documents, len(documents) // 8, np.int64))
            all_rows.append([np.cumsum(gaps, dtype=np.uint64), ids[row], start])
    if not all_rows:
        return
    anchor, doc, start = (np.concatenate(x) for x in zip(*all_rows, strict=True))
    all_rows.clear()
    order = np.argsort(anchor, kind="stable")
    anchor, doc, start = anchor[order], doc[order], start[order]
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    sizes = np.diff(np.append(first, len(anchor)))
    shared = np.repeat(np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first), sizes)
    hot = np.repeat((sizes > most) | np.maximum.reduceat(start == HOT_ENTRY, first), sizes)
    asked = shared & (start != HOT_ENTRY)
    yield from _to_documents(ASK, n_parts, doc[asked], np.zeros(int(asked.sum()), np.int64), start[asked].astype(np.int64) * 2 + hot[asked])


def _numbers(blobs: list[dict] | None, tkey: int, kind: int) -> np.ndarray:
    # What is asked of a doc_id is asked of all rows that have it; marks are of one text.
    parts = [np.frombuffer(x["data"], dtype="<i8" if x["kind"] >= WIDE else "<u4").astype(np.int64) for x in blobs or [] if x["kind"] % WIDE == kind and (kind == ASK or x["tkey"] == tkey)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _send(n_parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, tkey, text, said) to packed strings of the runs that were asked for."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, tkeys = (batch.column(i).to_numpy() for i in (0, 1))
            data, offsets = column_bytes(batch.column(2))
            for i, j in row_groups(offsets, BATCH):
                said = batch.column(3).slice(i, j - i).to_pylist()
                asked = [_numbers(x, k, ASK) for x, k in zip(said, tkeys[i:j].tolist(), strict=True)]
                yield from sent(data[: offsets[j]], offsets[i : j + 1], doc_ids[i:j], tkeys[i:j], asked)

    def sent(data: np.ndarray, offsets: np.ndarray, doc_ids: np.ndarray, tkeys: np.ndarray, asked: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        some = list(runs_of(data, offsets))
        if not some:
            return
        row, start, length, anchor, _ = map(np.concatenate, zip(*some, strict=True))
        place = row.astype(np.int64) << 32 | start
        wanted = np.concatenate([x + (i << 33) for i, x in enumerate(asked)])
        cold, hot = (np.isin(place, wanted[wanted & 1 == odd] >> 1) for odd in (0, 1))
        row_c, start_c, length_c, key_c = row[cold], start[cold], length[cold], anchor[cold]
        # A hot anchor's windows go by their own hashes.
        many = length[hot] - WINDOW + 1
        row_h = np.repeat(row[hot], many)
        start_h = np.repeat(start[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = offsets[row_h] + start_h
        text = _matrix(data, at, np.full(len(at), WINDOW))
        key_h = _row_hashes(text)
        kept, later = _settle(key_h, doc_ids[row_h], lambda a, b: (text[a] == text[b]).all(axis=1))
        yield from _to_documents(MARK, n_parts, doc_ids[row_h[later]], tkeys[row_h[later]], np.stack((start_h[later], start_h[later] + WINDOW), axis=1))
        row_h, start_h, key_h = row_h[kept], start_h[kept], key_h[kept]
        row, start, key = np.concatenate((row_c, row_h)), np.concatenate((start_c, start_h)), np.concatenate((key_c, key_h))
        length = np.concatenate((length_c, np.full(len(row_h), WINDOW)))
        strings = _matrix(data, offsets[row] + start, length)

        def pack(rows: np.ndarray) -> bytes:
            return _packed([key[rows], doc_ids[row[rows]], tkeys[row[rows]], start[rows].astype("<u4"), length[rows].astype(np.uint8)], strings[rows].tobytes())

        yield from _by_part((key % np.uint64(n_parts)).astype(np.int64), n_parts, pack)

    return send


def _compare(n_parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All strings of a part to marks."""
    together = SORTED_TOGETHER
    return lambda batches: _marked(batches, n_parts, together)


def _marked(batches: Iterator[pa.RecordBatch], n_parts: int, together: int) -> Iterator[pa.RecordBatch]:
    rows: list[list[np.ndarray]] = []
    for batch in batches:
        kinds = batch.column(1).to_numpy()
        if (kinds >= 0).any():
            yield batch.filter(pa.array(kinds >= 0))
        for raw in batch.column(2).filter(pa.array(kinds < 0)).to_pylist():
            columns, strings = _unpacked(raw, [np.uint64, np.int64, np.int64, np.uint32, np.uint8])
            rows.append([*columns, np.frombuffer(strings, np.uint8).reshape(-1, WIDTH)])
    if not rows:
        return
    key, doc, tkey, start, length, strings = (np.concatenate(x) for x in zip(*rows, strict=True))
    rows.clear()
    start, length = start.astype(np.int64), length.astype(np.int64)
    flat = strings.ravel()
    # Runs of an anchor, sorted as suffixes of all strings. Shorter ones end in zeros; the length tells them from strings with zeros of their own.
    order, group = sort_suffixes(flat, np.arange(len(key)) * WIDTH, WIDTH, key)
    content = np.empty(len(key), dtype=np.int64)
    content[order] = group * (WIDTH + 1) + length[order]
    kept, later = _settle(content, doc, lambda a, b: np.ones(len(a), dtype=bool))
    yield from _to_documents(MARK, n_parts, doc[later], tkey[later], np.stack((start[later], start[later] + length[later]), axis=1))
    # Different strings with one anchor: all their windows are sorted.
    kept = kept[np.argsort(key[kept], kind="stable")]
    again = key[kept][1:] == key[kept][:-1]
    kept = kept[np.append(False, again) | np.append(again, False)] if len(kept) > 1 else kept[:0]
    heads = np.flatnonzero(np.append(True, key[kept][1:] != key[kept][:-1])) if len(kept) else kept
    cuts = np.append(np.unique(heads[np.minimum(np.searchsorted(heads, np.arange(0, len(kept), together)), len(heads) - 1)]), len(kept)) if len(kept) else kept
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        some = kept[i:j]
        many = length[some] - WINDOW + 1
        owner = np.repeat(some, many)
        shift = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        order, group = sort_suffixes(flat, owner * WIDTH + shift, WINDOW, key[owner])
        owner, shift = owner[order], shift[order]
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.repeat(np.minimum.reduceat(doc[owner], heads), np.diff(np.append(heads, len(group))))
        later = doc[owner] > least
        owner, begins = owner[later], start[owner[later]] + shift[later]
        yield from _to_documents(MARK, n_parts, doc[owner], tkey[owner], np.stack((begins, begins + WINDOW), axis=1))


def _spans(pairs: np.ndarray, n: int) -> np.ndarray:
    """Mask of the bytes that the spans (first, past the last, ...) cover."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, pairs[0::2], 1)
    np.add.at(edges, pairs[1::2], -1)
    return np.cumsum(edges[:-1]) > 0


def marked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``__repeat_text_key`` and ``__repeat_marks`` (marks, or null).

    The texts are written once, bucketed by doc_id, and read in place three times. A null doc_id is compared with nothing.
    Rows that share a doc_id are told apart by their texts; none of them is earlier than another. An empty table gives no rows.
    There are at most ``MOST_PARTS`` parts and spark.sql.sources.bucketing.maxBuckets buckets; beyond 1.2 and 2.4 TB of text these grow instead, and executors need memory in proportion.
    Texts of up to 2 GB, the most that a row can hold, are cut into segments and hashed one by one.
    """
    spark = docs.sparkSession
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = min(partitions_for(spark, size, 24 << 20), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    n_parts = min(partitions_for(spark, size, 12 << 20), MOST_PARTS)
    name = f"ledgerloom_texts_{uuid.uuid4().hex}"
    keyed = docs.withColumn("__repeat_text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    keyed.repartition(n_buckets, "doc_id").write.format("parquet").option("path", fresh_path(spark, "texts")).bucketBy(n_buckets, "doc_id").saveAsTable(name)
    texts = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # from the catalog only: the files are read by their path
    known = texts.filter(F.col("doc_id").isNotNull()).select("doc_id", "__repeat_text_key", "text")
    found = known.mapInArrow(tidy(_find(n_parts)), _PACKED)
    said = materialise(found.repartition(n_parts, "part").mapInArrow(tidy(_ask(n_parts)), _PACKED), "asked")

    def gathered(packed: DataFrame) -> DataFrame:
        # A document has a row for each kind; rows that repeat its id with other texts add theirs.
        rows = packed.repartition(n_parts, "part").mapInArrow(tidy(_gather), _ROWS)
        return rows.groupBy(F.col("doc_id").alias("__repeat_doc")).agg(F.collect_list(F.struct("tkey", "kind", "data")).alias("__repeat_marks"))

    asked = known.join(gathered(said.filter(F.col("kind") == ASK)).hint("shuffle_hash"), F.col("doc_id") == F.col("__repeat_doc")).select("doc_id", "__repeat_text_key", "text", "__repeat_marks")
    compared = materialise(asked.mapInArrow(tidy(_send(n_parts)), _PACKED).repartition(n_parts, "part").mapInArrow(tidy(_compare(n_parts)), _PACKED), "compared")
    marks = gathered(said.filter(F.col("kind") == MARK).unionByName(compared))
    return texts.join(marks.hint("shuffle_hash"), F.col("doc_id") == F.col("__repeat_doc"), "left").drop("__repeat_doc")


def _cut(rows: Iterator[pa.RecordBatch], digest: bool) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch (doc_id, tkey, said, text, ...) with (n_bytes, n_removed, n_spans, remaining bytes or their SHA-256)."""
    for batch in rows:
        data, offsets = column_bytes(batch.column(3))
        out = []
        for i, (tkey, said) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            text = data[offsets[i] : offsets[i + 1]]
            pairs = _numbers(said, tkey, MARK)
            removed = spans = 0
            if len(pairs):
                mask = _spans(pairs, len(text))
                removed, spans = int(mask.sum()), int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                text, length = text[~mask], len(text)
            else:
                length = len(text)
            raw = text.tobytes()
            out.append((length, removed, spans, hashlib.sha256(raw).hexdigest() if digest else raw))
        yield batch, out


def removal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, out in _cut(batches, digest=True):
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kind) for x, kind in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return marked_documents(narrow).select("doc_id", "__repeat_text_key", "__repeat_marks", "text").mapInArrow(tidy(report), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with what remains of each text; a character of which a byte was removed goes whole. Null texts stay null, and no row is dropped."""
    schema, names = docs.schema, docs.columns
    others = [c for c in names if c not in ("doc_id", "text")]

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, out in _cut(batches, digest=False):
            texts = [None if null else x[3].decode("utf-8", "ignore") for x, null in zip(out, batch.column(3).is_null().to_pylist(), strict=True)]
            by_name = {"doc_id": batch.column(0), "text": pa.array(texts, pa.string())} | {c: batch.column(4 + k) for k, c in enumerate(others)}
            yield pa.RecordBatch.from_arrays([by_name[c] for c in names], names=names)

    return marked_documents(docs).select("doc_id", "__repeat_text_key", "__repeat_marks", "text", *others).mapInArrow(tidy(rewritten), schema)


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removal_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every byte is a row and every 50-byte window a string, built from shorter ones; for tables of some megabytes.
ORACLE_SQL = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), bytes AS (
  SELECT r, doc_id, unnest(range(1, len(h) // 2 + 1)) AS p, unnest(regexp_extract_all(h, '..')) AS b FROM texts
), w2 AS (SELECT *, b || lead(b) OVER o AS s2 FROM bytes WINDOW o AS (PARTITION BY r ORDER BY p)
), w4 AS (SELECT *, s2 || lead(s2, 2) OVER o AS s4 FROM w2 WINDOW o AS (PARTITION BY r ORDER BY p)
), w8 AS (SELECT * EXCLUDE (s4), s4 || lead(s4, 4) OVER o AS s8 FROM w4 WINDOW o AS (PARTITION BY r ORDER BY p)
), w16 AS (SELECT * EXCLUDE (s8), s8 || lead(s8, 8) OVER o AS s16 FROM w8 WINDOW o AS (PARTITION BY r ORDER BY p)
), w50 AS (
  SELECT r, doc_id, p, b, s16 || lead(s16, 16) OVER o || lead(s16, 32) OVER o || lead(s2, 48) OVER o AS s50 FROM w16 WINDOW o AS (PARTITION BY r ORDER BY p)
), firsts AS (
  SELECT s50, min(doc_id) AS first_id FROM w50 WHERE s50 IS NOT NULL AND doc_id IS NOT NULL GROUP BY s50 HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT r, p, b, coalesce(bool_or(coalesce(first_id < doc_id, false)) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM w50 LEFT JOIN firsts USING (s50)
), runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS begins FROM covered
), cut AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, coalesce(string_agg(b, '' ORDER BY p) FILTER (NOT gone), '') AS kept FROM runs GROUP BY r
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN cut USING (r)
"""
