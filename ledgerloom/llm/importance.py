"""Resampling documents towards a target distribution of hashed n-grams.

A feature's bucket is the CRC-32 of its words joined by spaces; a word's CRC is
computed once, and those of longer features are composed of their words' by
the algebra of CRCs, so that no n-gram is ever put together as a string. Texts are
read twice: for the counts of all buckets, and for the weights that these give.
The draw adds a Gumbel variable to each weight; one range sort ranks the scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialise
from ledgerloom.llm.crc_algebra import crcs, joined
from ledgerloom.llm.rolling import column_bytes
from ledgerloom.llm.words import ALPHANUMERIC, Piece, pieces
from ledgerloom.llm.worker import tidy
from ledgerloom.operators.ordering import with_ordinal

BUCKETS, LONGEST = 10_000, 2
#: Documents with fewer words are not drawn; of the others, this percentage is.
LEAST_WORDS, PERCENT, DRAW = 20, 25, 7
_SPACE = np.uint32(zlib.crc32(b" "))


def features(piece: Piece, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(row, CRC-32) of all runs of 1 to ``longest`` words that end in a word the segment before did not have."""
    size = piece.end - piece.start
    word = crcs(piece.data, piece.start, piece.end)
    spaced = joined(np.full(len(word), _SPACE), word, size)  # a space before the word
    rows, values, run = [piece.row[piece.carried :]], [word[piece.carried :]], word
    for n in range(2, longest + 1):
        # run[i] is the CRC of n - 1 words from i; add the word behind them.
        run = joined(run[: max(len(word) - n + 1, 0)], spaced[n - 1 :], size[n - 1 :] + 1)
        within = piece.row[n - 1 :] == piece.row[: max(len(word) - n + 1, 0)]
        within[: max(piece.carried - n + 1, 0)] = False
        rows.append(piece.row[n - 1 :][within])
        values.append(run[within])
    return np.concatenate(rows), np.concatenate(values)


def _counted(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for piece in pieces(*column_bytes(batch.column(0)), ALPHANUMERIC, LONGEST - 1):
                total += np.bincount(features(piece)[1] % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return counted


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all ``text`` of the table by bucket. Buckets without any are missing."""
    return texts.select("text").mapInArrow(tidy(_counted(buckets)), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Each bucket's gain: the logarithm, in thousandths, of how much likelier its features are in the target. One number for each bucket."""
    spark = corpus.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left").join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0)
    counts = materialise(counts, "bucket_counts")
    all_s, all_t = counts.agg(F.sum("s").cast("double"), F.sum("t").cast("double")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.log((t + 1) * (F.lit(all_s) + buckets) / ((s + 1) * (F.lit(all_t) + buckets))))
    return [r[0] for r in counts.orderBy("bucket").select(gain).collect()]


def _weighed(gain: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    table = np.array(gain, dtype=np.float64)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, words, total = (np.zeros(len(batch), dtype=np.int64) for _ in range(3))
            for piece in pieces(*column_bytes(batch.column(1)), ALPHANUMERIC, LONGEST - 1):
                at = slice(piece.first, piece.first + piece.n)
                row, value = features(piece)
                n[at] += np.bincount(row, minlength=piece.n)
                words[at] += np.bincount(piece.row[piece.carried :], minlength=piece.n)
                # Sums of whole numbers in doubles are exact below 2^53.
                total[at] += np.bincount(row, table[value % np.uint32(len(table))], piece.n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n, words, total))], names=["doc_id", "n_features", "n_words", "total"])

    return weighed


def weights(docs: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_features, n_words and weight, the floored mean of gains over a document's features (none: 0), for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_weighed(gain)), "doc_id long, n_features long, n_words long, total long")
    return rows.select("doc_id", "n_features", "n_words", F.when(F.col("n_features") == 0, F.lit(0).cast("long")).otherwise(F.expr("(total - pmod(total, n_features)) div n_features")).alias("weight"))


def gumbel(doc_id: Column) -> Column:
    """A Gumbel variable in thousandths, the same for a doc_id on every run; null for null."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{DRAW}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, n_words, weight, score and rank for every row of ``docs``; rank is null for what is not drawn.

    Of the N rows with a doc_id and at least ``least_words`` words, floor(percent * N / 100) of the highest scores are drawn, ties to the smaller
    doc_id. Null and empty texts have no features and the weight 0. A null doc_id has no score and is not drawn, but its text counts in the corpus.
    Rows that repeat a doc_id share its variable and are drawn one by one; those of one score and doc_id in any order. Very long texts are read
    by segments. Empty tables (of either kind) give weights of their own counts alone; no documents, no rows. Other columns are not looked at.
    """
    # Written before the sort, which looks at its input twice.
    scored = weights(docs, gains(bucket_counts(docs), bucket_counts(target))).withColumn("score", F.col("weight") + gumbel(F.col("doc_id")))
    scored = materialise(scored, "scores")
    enough = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    # Rows that cannot be drawn are ranked behind the others, and spread by their texts' counts.
    out = F.when(enough, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("doc_id", "n_features", "weight"), F.lit(1 << 20)))
    ranked = with_ordinal(scored.withColumn("__out", out), [F.col("__out"), F.col("score").desc(), F.col("doc_id")], "rank")
    n = ranked.filter("__out = 0").count()
    drawn = (F.col("__out") == 0) & (F.col("rank") <= percent * n // 100)
    return ranked.select("doc_id", "n_features", "n_words", "weight", "score", F.when(drawn, F.col("rank")).alias("rank"))


def op13_importance(spark, sf_dir: str) -> DataFrame:
    read = lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet").select
    return resampled(read("documents")("doc_id", "text"), read("benchmark")("text"))


#: CRCs here are taken of whole features, byte by byte.
ORACLE_SQL = """
WITH bits AS (
  SELECT i, list_reduce(range(0, 8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, i::BIGINT) AS r FROM range(0, 256) t(i)
), tbl AS (
  SELECT list(r ORDER BY i) AS b FROM bits
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
), words AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), runs AS (
  SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS x FROM words
), counted AS (
  SELECT side, id, x, count(*) AS n FROM runs GROUP BY ALL
), hexed AS (
  SELECT x, lower(hex(encode(x))) AS h FROM (SELECT DISTINCT x FROM counted)
), hashed AS (
  SELECT x, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda r, v: xor(r >> 8, b[(xor(r, v) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM hexed, tbl
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM counted JOIN hashed USING (x) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain FROM sums
), totals AS (
  SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM counted JOIN hashed USING (x) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT w.id AS doc_id, coalesce(n_features, 0) AS n_features, len(w)::BIGINT AS n_words, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words w LEFT JOIN totals ON totals.id = w.id WHERE side = 'd'
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT s.*, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored s LEFT JOIN ranked USING (doc_id)
"""
