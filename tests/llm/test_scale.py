"""What must hold at sizes that no test can run at."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id, sharding, suffix_dedup


def test_anchors_that_are_shipped_grow_with_the_text_alone():
    table = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"]).slice(0, 6000)
    n = len(table)
    batch = pa.RecordBatch.from_arrays([table.column("doc_id").combine_chunks(), pa.array(np.arange(n)), table.column("text").combine_chunks()], names=["doc_id", "tkey", "text"])

    def shipped(parts):
        rows = [(k, len(x)) for b in suffix_dedup._find(parts)(iter([batch])) for k, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        return sum(size + 40 for kind, size in rows if kind < 0)

    few = shipped(43)
    assert shipped(2_500) < 1.3 * few and shipped(25_000) < 2 * few


def test_parts_of_anchors_come_back():
    rng = np.random.default_rng(3)
    n = 5000
    anchor, doc, start = rng.integers(0, 1 << 46, n).astype(np.uint64), rng.integers(-50, 50, n), rng.integers(0, 1 << 31, n).astype("<u4")
    out = []
    for b in suffix_dedup.packed_anchors([(anchor, doc, start, n)], 300):
        for part, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            (gaps, own, begin), ids = suffix_dedup._unpacked(raw, [np.uint64, np.uint32, np.uint32])
            ids = np.cumsum(suffix_dedup._unplanes(ids, len(ids) // 8, np.int64))
            got = np.cumsum(gaps, dtype=np.uint64)
            assert (got % np.uint64(300) == part).all()
            out += zip(got.tolist(), ids[own].tolist(), begin.tolist(), strict=True)
    assert sorted(out) == sorted(zip(anchor.tolist(), doc.tolist(), start.tolist(), strict=True))


def test_fewer_buckets_and_parts_than_wanted(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    wanted = sorted(map(tuple, suffix_dedup.removal_report(docs).collect()))
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    monkeypatch.setattr(suffix_dedup, "MOST_PARTS", 2)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        assert sorted(map(tuple, suffix_dedup.removal_report(docs).collect())) == wanted
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)


def test_large_arrays_go_in_several(monkeypatch):
    doc, values = np.repeat(np.arange(40), 5), np.arange(400).reshape(200, 2)
    whole = next(suffix_dedup._by_document(0, doc, doc, values))
    monkeypatch.setattr(suffix_dedup, "LARGEST_ARRAY", 100)
    parts = list(suffix_dedup._by_document(0, doc, doc, values))
    assert len(parts) == 20 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()


@pytest.mark.parametrize("n", [1, 480, 481, 10**6, 3 * 10**8, 10**9, 10**11, 10**15])
def test_samples_of_large_languages(n):
    bound = language_id.sample_bound(n, 400)
    expected = n * (bound + (1 << 63) + 1) / 2**64
    assert expected == pytest.approx(min(n, 480), rel=1e-3) and -(1 << 63) <= bound < 1 << 63


def test_a_language_without_a_sample_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "sample_bound", lambda n, per: -(1 << 63))
    docs = spark.createDataFrame([(i, "ein text", "de") for i in range(8)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="no sample"):
        language_id.train(docs)


def test_groups_heavy_in_rows_are_split(spark):
    """Half of the texts are empty: they are next to no bytes, but half of the rows."""
    rng = random.Random(5)
    rows = [(i, "" if i % 2 else "word " * rng.randrange(1, 40) + str(i)) for i in range(20_000)]
    rows += [(None, "")] * 2_000
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.count_distinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    assert len(got) == 8 and all(r.n == r.slots == r["last"] + 1 for r in got)
    n, size = [r.n for r in got], [r["size"] for r in got]
    assert max(n) - min(n) <= 0.01 * sum(n) and max(size) - min(size) <= 0.01 * sum(size) / 8
