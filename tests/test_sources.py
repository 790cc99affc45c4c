import json
import random

import pyarrow as pa
import pytest

from ledgerloom.sources import jsonl


def test_repairing_reader(spark, tmp_path):
    p = tmp_path / "index.jsonl"
    p.write_bytes('\ufefforphan\n{"relative_path":"a","t":"x\u2028y"}\r\n{"relative_path":"b","t":"one\ntwo\tx\\""}\n{"relative_path":"c",\n{"relative_path":"d"}\n'.encode())
    rows = sorted(jsonl.read_repairing(spark, str(p)).collect())
    assert [(r.start_line, r.end_line, r.repaired, r.error is None) for r in rows] == [(1, 1, False, False), (2, 2, False, True), (3, 4, True, True), (5, 5, False, False), (6, 6, False, True)]
    assert "\u2028" in rows[1].json and "one\\ntwo\\tx" in rows[2].json and "before the first" in rows[0].error


def test_repairing_reader_over_splits(spark, tmp_path):
    """Lines are numbered through a file of many splits, and anew in the next file."""
    rng, want = random.Random(2), []
    for name in ("a", "b"):
        at, text = 1, ""
        for i in range(120):
            broken = rng.choice(["", "", "\n", "\n\n\t"]) + "x" * rng.choice([1, 30, 400])
            text += f'{{"relative_path":"{name}{i}","t":"{broken}"}}\n'
            want.append((f"{name}{i}", at, at + broken.count("\n"), broken[0] == "\n"))
            at += broken.count("\n") + 1
        (tmp_path / f"{name}.jsonl").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = jsonl.read_repairing(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((json.loads(r.json)["relative_path"], r.start_line, r.end_line, r.repaired) for r in rows) == sorted(want)


def test_tolerant_and_strict(spark, tmp_path):
    p = tmp_path / "log.jsonl"
    p.write_text('{"id":1}\n\n{"id":')
    assert [r.id for r in jsonl.read_tolerant(spark, str(p), "id int").collect()] == [1]
    assert jsonl.read_tolerant(spark, str(tmp_path / "none"), "id int").count() == 0
    p.write_text('{"id":\n{"id":2}\n')
    with pytest.raises(ValueError):
        jsonl.read_tolerant(spark, str(p), "id int")
    with pytest.raises(Exception):
        jsonl.read_strict(spark, str(p), "id int").collect()
    p.write_text('{"id":1}\n{"id":2}\n')
    assert jsonl.read_strict(spark, str(p), "id int").count() == 2


def test_checkpoint_policy_and_paths(spark, tmp_path):
    rows = spark.createDataFrame([("h", "a", "m", "p", 1), ("h", "b", "m", "p", 2), ("h", "c", "other", "p", 3)], "card_sha256 string, decision string, model_version string, prompt_version string, ordinal long")
    assert [r.decision for r in jsonl.read_checkpoint(rows, "m", "p").collect()] == ["b"]
    policy = "# 标题\n- no\n## 第一优先级\n- 同人\n- 同人\n1. 规则模拟\n## 其他\n- no\n##第二优先级\n* 直播\n"
    assert jsonl.allowed_categories(policy) == ["同人", "规则模拟", "直播"]
    with pytest.raises(ValueError):
        jsonl.allowed_categories("# x")
    for name, file in (("2", "a.json"), ("1", "a.json"), ("3", "b.json")):
        (tmp_path / name).mkdir()
        (tmp_path / name / file).write_text("{}")
    assert jsonl.latest_artifact(spark, str(tmp_path), "a.json").endswith("/2/a.json")
    assert jsonl.latest_artifact(spark, str(tmp_path), "a.json", lambda b: not b.endswith("2")).endswith("/1/a.json")
    assert jsonl.remap_prefix("/Old/x/y.png", {"/old": "/new"}) == "/new/x/y.png"
    assert jsonl.remap_prefix("/older/y", {"/old": "/new"}) == "/older/y"


def test_batches_are_parsed_in_slices():
    """No row is lost or changes its place; a piece is over the size only where it is one row."""
    texts = ["x" * (i * 37 % 101) for i in range(500)] + [None, "", "é" * 300, "y"]
    batch = pa.RecordBatch.from_pydict({"value": pa.array(texts, pa.string()), "n": list(range(len(texts)))})
    pieces = list(jsonl.slices(batch, batch.column(0), 200))
    assert [(r["value"], r["n"]) for p in pieces for r in p.to_pylist()] == list(zip(texts, range(len(texts)), strict=True))
    assert len(pieces) > 50 and all(p.num_rows == 1 or sum(len((v or "").encode()) for v in p.column(0).to_pylist()) <= 200 for p in pieces)
    assert not list(jsonl.slices(batch.slice(0, 0), batch.slice(0, 0).column(0)))
