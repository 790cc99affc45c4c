import tiktoken
import public_tokenizers

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import byte_bpe, language_id, packing, quality_rules
from ledgerloom.llm.common import materialise
from tests.llm.test_dedup import brute_components, brute_removals
from tests.llm.test_tokens import check_packing


def brute_texts(rows):
    """What remains of each text, by single windows."""
    first = {}
    for d, t in rows:
        raw = t.encode()
        for i in range(len(raw) - 49):
            first[raw[i : i + 50]] = min(first.get(raw[i : i + 50], d), d)
    out = []
    for d, t in rows:
        raw = t.encode()
        mask = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < d:
                mask[i : i + 50] = b"\1" * 50
        out.append((d, bytes(c for c, m in zip(raw, mask, strict=True) if not m).decode("utf-8", "ignore")))
    return out


def test_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows, schema = {r.doc_id: r.text for r in docs.collect()}, docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        if name == "language_id":
            model = language_id.train(docs)
            want = {d: t for d, t in rows.items() if (p := model.predict(t))[0] != "und" and p[1] >= language_id.LEAST_SCORE}
        elif name == "quality_rules":
            want = {d: t for d, t in rows.items() if (m := quality_rules.measure_text(t))[0] >= 10 and 100 * m[4] <= 20 * m[0]}
        elif name == "near_dedup":
            want = {d: rows[d] for d, _, _, kept in brute_components(list(rows.items())) if kept}
        elif name == "suffix_dedup":
            want = dict(brute_texts(list(rows.items())))
            assert {r[0]: r[2] for r in brute_removals(list(rows.items()))} and len(want) == len(rows)
        docs = materialise(stage(spark, docs, small), name)
        if name == "packing":
            exact = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}).encode_ordinary
            assert check_packing(list(rows.items()), docs.collect(), exact) > 0.9
        else:
            assert docs.columns == schema and {r.doc_id: r.text for r in docs.collect()} == want
            assert all(r.n_chars == len(r.text) for r in docs.collect())
            rows = want


def test_run_gives_the_stages_rows(spark, small):
    once = sorted(tuple(r) for r in corpus_pipeline.run(spark, small).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    assert once and once == sorted(set(once))
    assert packing.PIECES.startswith("doc_id")


def test_registered_queries():
    """Each operator's query is its function, and SQL stands beside queries only."""
    from ledgerloom.llm import registry

    assert [k.split("_")[0] for k in registry.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert all(callable(q) and q.__name__ == k for k, q in registry.QUERIES.items())
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES) and all(isinstance(s, str) for s in registry.ORACLE_SQL.values())


def test_odd_rows_and_an_empty_table(spark, small, tmp_path):
    """Rows without a doc_id stay, of repeated ones one does, null and empty texts go; nothing comes of nothing."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, small).select("doc_id").distinct().collect()}
    some = sorted(kept)[:2]
    again = docs.filter(F.col("doc_id").isin(some))
    odd = again.withColumn("doc_id", F.lit(None).cast("long")).unionByName(again.limit(1)).unionByName(docs.limit(2).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("text", F.lit(None).cast("string")))
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces if r.doc_id is not None} == kept and sum(r.doc_id is None and r.start == 0 for r in pieces) == 2
    assert len({(r.doc_id, r.start) for r in pieces if r.doc_id is not None}) == sum(r.doc_id is not None for r in pieces)
    (tmp_path / "none").mkdir()
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
