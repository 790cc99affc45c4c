"""Token counts: the exact histogram of encoded lengths and its suffix sums.

From the histogram alone follow, for every context limit: how many documents
are as long or longer, the tokens they hold, the tokens left after truncation
at the limit, and the quantile at which the limit stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.chunk_coder import rank_coder
from ledgerloom.llm.common import materialise

#: Lengths that are summed in one task.
BLOCK = 1024


def length_histogram(docs: DataFrame, ranks_path: str) -> DataFrame:
    """n_tokens, n_docs. A null or empty text has 0 tokens; every row counts, repeated or not. An empty table gives no rows.

    Texts are encoded whole, in steps of about a million characters, a longer text in a step of its own. Other columns than text are not looked at.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rank_coder(ranks_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(ids) // 4 for _, ids in coder.encode_in_steps(batch.column(0).to_pylist())], pa.int64())], names=["n_tokens"])

    return docs.select("text").mapInArrow(lengths, "n_tokens long").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length of ``histogram``, which is read twice, as a context limit: docs_from and tokens_from (documents at least as long, and their tokens), docs_below, tokens_below, truncated_tokens (sum of min(length, limit)), total_docs, total_tokens, quantile (share of documents no longer).

    Sums run within blocks of ``BLOCK`` lengths and over the blocks' totals, of which there is one for each ``BLOCK`` tokens of the longest document. An empty table gives no rows.
    """
    by_block = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_docs") * F.col("n_tokens"))
    blocks = by_block.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    earlier, all_rows = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    blocks = blocks.select("block", zero("b_docs", earlier).alias("docs_0"), zero("b_tokens", earlier).alias("tokens_0"), F.sum("b_docs").over(all_rows).alias("total_docs"), F.sum("b_tokens").over(all_rows).alias("total_tokens"))
    below = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = by_block.join(blocks, "block")
    rows = rows.withColumn("docs_below", F.col("docs_0") + zero("n_docs", below)).withColumn("tokens_below", F.col("tokens_0") + zero("tokens", below))
    rows = rows.withColumn("docs_from", F.col("total_docs") - F.col("docs_below")).withColumn("tokens_from", F.col("total_tokens") - F.col("tokens_below"))
    return rows.select(
        "n_tokens", "n_docs", "docs_below", "tokens_below", "docs_from", "tokens_from", (F.col("tokens_below") + F.col("docs_from") * F.col("n_tokens")).alias("truncated_tokens"), "total_docs", "total_tokens", ((F.col("docs_below") + F.col("n_docs")) / F.col("total_docs")).alias("quantile")
    )


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``; any limit, whether or not a document has that length."""
    row = sums.filter(F.col("n_tokens") <= limit).orderBy(F.desc("n_tokens")).first()
    if row is None:
        first = sums.orderBy("n_tokens").first()
        return limit * first.total_docs if first else 0
    return row.tokens_below + row.n_docs * row.n_tokens + (row.docs_from - row.n_docs) * limit


def length_quantile(sums: DataFrame, q: float) -> int | None:
    """The least length that at least a share ``q`` of the documents do not exceed."""
    row = sums.filter(F.col("quantile") >= q).orderBy("n_tokens").first()
    return row.n_tokens if row else None


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    histogram = length_histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return suffix_sums(materialise(histogram, "lengths"))  # read twice, encoded once
