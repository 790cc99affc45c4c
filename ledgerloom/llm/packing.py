"""Packing: shortest-pack-first over the length histogram.

Documents are tokenised and cut into pieces of at most ``max_tokens``; the
counts of piece lengths (a histogram of ``max_tokens`` entries at most) are all
that the driver sees. Lengths are placed longest first, each into the shortest
open pack that has room, and whole counts move at once: the packing is a short
list of patterns with counts. Each piece gets its rank among pieces of its
length, and a join on (length, rank interval) gives it its place.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.chunk_coder import json_coder
from ledgerloom.llm.common import materialise

#: Pieces of one length that are ranked together in a task.
RANKED_TOGETHER = 50_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, and with ``with_ids`` its ids.

    A null or empty text is the end id alone. Repeated rows give repeated pieces; a null doc_id is kept. Other columns are ignored.
    """
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = json_coder(tokenizer_path)
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), []
            for i, ids in coder.encode_in_steps(batch.column(1).to_pylist()):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, max_tokens):
                    part = ids[4 * start : 4 * (start + max_tokens)]
                    rows.append((doc_ids[i], start, len(part) // 4, zlib.crc32(part), n, part)[: 5 + with_ids])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.binary() if k == 5 else pa.int64()) for k, x in enumerate(zip(*rows, strict=True))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES + ", ids binary" * with_ids)


def shortest_pack_first(histogram: dict[int, int], max_tokens: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in their order in the pack) with their counts."""
    rooms: list[tuple[int, int]] = []  # heap of (-room, pattern's number)
    patterns: list[list] = []  # [lengths, count]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= max_tokens:
            raise ValueError(f"a piece of {length} tokens")
        while left:
            if not rooms or -rooms[0][0] < length:
                patterns.append([(length,), left])
                heapq.heappush(rooms, (length - max_tokens, len(patterns) - 1))
                break
            room, k = heapq.heappop(rooms)
            lengths, count = patterns[k]
            taken = min(left, count)
            if taken < count:
                patterns[k][1] -= taken
                heapq.heappush(rooms, (room, k))
                patterns.append([(*lengths, length), taken])
                k = len(patterns) - 1
            else:
                patterns[k][0] = (*lengths, length)
            heapq.heappush(rooms, (room + length, k))
            left -= taken
    return [(lengths, count) for lengths, count in patterns]


def pattern_slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank past the last, first sequence, offset) for each place of each pattern.

    There is a row for each place of a pattern: their number depends on the histogram's width, not on the documents.
    """
    taken: dict[int, int] = {}
    slots, sequence = [], 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            slots.append((length, first, first + count, sequence, offset))
            taken[length] = first + count
            offset += length
        sequence += count
    return slots


def pack(pieces: DataFrame, max_tokens: int = 1024) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, start, length, ids_crc32 and others), which is read three times and so should be materialised.

    Ranks are dealt in groups of about ``RANKED_TOGETHER`` pieces of a length, then offset by the sizes of the groups before.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # max_tokens rows at most
    slots = spark.createDataFrame(pattern_slots(shortest_pack_first(histogram, max_tokens)), "p_length long, first_rank long, past_rank long, first_sequence long, offset long")
    groups = spark.createDataFrame([(n, -(-c // RANKED_TOGETHER)) for n, c in histogram.items()], "g_length long, groups long")
    mark = F.xxhash64("doc_id", "start", "ids_crc32")
    dealt = pieces.join(F.broadcast(groups), F.col("length") == F.col("g_length")).withColumn("group", F.pmod(mark, "groups")).drop("g_length", "groups")
    # A row for each length and group: at most max_tokens + pieces / RANKED_TOGETHER.
    sizes = dealt.groupBy(F.col("length").alias("s_length"), F.col("group").alias("s_group")).agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("s_length").orderBy("s_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("s_length", "s_group", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "group").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1)
    ranked = ranked.join(F.broadcast(sizes), (F.col("length") == F.col("s_length")) & (F.col("group") == F.col("s_group"))).withColumn("rank", F.col("rank") + F.col("base"))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("past_rank")))
    return placed.select(*pieces.columns, (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: a row for each piece.

    An empty table gives no rows. A null or empty text is the closing id alone. Rows that repeat a doc_id, or have none, are documents of their own, of which the
    pieces cannot be told apart. Texts are tokenised whole, whatever their length; other columns than doc_id and text are not looked at.
    """
    return pack(materialise(tokenised_pieces(docs, tokenizer_path, max_tokens, with_ids=with_ids), "pieces"), max_tokens)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
