"""Logs that are torn, gone on with, sealed and compacted."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from ledgerloom.plans import stages
from ledgerloom.plans.log import CheckpointLog
from ledgerloom.sources.jsonl import read_tolerant

SCHEMA = "k string, v long, ordinal long"


def rows(spark, log):
    return sorted((r.ordinal, r.k, r.v) for r in log.read(spark, SCHEMA).collect())


@pytest.mark.parametrize("tail, kept", [(b'{"k": "torn', 2), (b'{"k": "torn\n', 2), (b'{"k": "c", "v": 3, "ordinal": 3}', 3), (b'{"k": "c", "v": 3, "ordinal": 3}\n\n \r\n', 3), (b"\xe4\xb8", 2), (b"", 2), (b'{"k": "' + b"x" * 3_000_000, 2)])
def test_torn_lines_are_cut_off_before_anything_is_appended(spark, tmp_path, tail, kept):
    path = tmp_path / "log.jsonl"
    whole = b'{"k": "a", "v": 1, "ordinal": 1}\n{"k": "b", "v": 2, "ordinal": 2}\n'
    path.write_bytes(whole + tail)
    log = CheckpointLog(tmp_path, "log")
    assert len(list(log.records())) == kept
    log.append([{"k": "d", "v": 4}])
    log.close()
    lines = [json.loads(x) for x in path.read_bytes().splitlines() if x.strip()]
    assert [x["k"] for x in lines] == ["a", "b", "c"][:kept] + ["d"] and lines[-1]["ordinal"] == kept + 1
    assert len(rows(spark, log)) == kept + 1
    assert [p.name for p in tmp_path.iterdir()] == ["log.jsonl"]


def test_only_the_last_line_may_be_torn(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"k": "a"}\n{"k": \n{"k": "b"}\n')
    with pytest.raises(ValueError, match="before the last"):
        CheckpointLog(tmp_path, "log").read(spark, SCHEMA)
    with pytest.raises(ValueError):
        list(CheckpointLog(tmp_path, "log").records())


def test_a_log_that_is_only_torn_or_empty(spark, tmp_path):
    assert CheckpointLog(tmp_path / "none", "log").read(spark, SCHEMA).count() == 0
    (tmp_path / "log.jsonl").write_text('{"k"')
    log = CheckpointLog(tmp_path, "log")
    log.append([{"k": "a", "v": 1}])
    assert rows(spark, log) == [(1, "a", 1)]


def test_segments_compaction_and_ordinals(spark, tmp_path):
    log = CheckpointLog(tmp_path, "log", segment=200)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: log.append([{"k": f"k{i % 7}", "v": i}]), range(60)))
    log.close()
    before = rows(spark, log)
    assert [r[0] for r in before] == list(range(1, 61)) and len(log.sealed()) > 5
    log.compact(spark, SCHEMA, ["k"])
    assert log.sealed() == [] and len(list(tmp_path.glob("log-0*.jsonl"))) == 0
    last = {k: (o, k, v) for o, k, v in before}
    assert {k: (o, k, v) for o, k, v in rows(spark, log)} == last
    again = CheckpointLog(tmp_path, "log", segment=200)  # another writer goes on
    again.append([{"k": "k1", "v": 100 + i} for i in range(20)])
    again.close()
    again.compact(spark, SCHEMA, ["k"])
    now = {k: (o, v) for o, k, v in rows(spark, again)}
    assert now["k1"] == (80, 119) and len(list(tmp_path.glob("log-base-*"))) == 1
    assert max(o for o, _, _ in rows(spark, again)) == 80
    again.append([{"k": "k2", "v": 0}])
    assert max(rows(spark, again))[0] == 81


def test_a_torn_checkpoint_is_resumed(spark, tmp_path):
    """A request is answered behind a torn line; the batch can be read and finished."""
    folder = tmp_path / "batch"
    folder.mkdir()
    versions = ("m", "p")

    class Model:
        def ask(self, system, payload):
            return {"results": [{"id": c["id"], "decision": "exclude"} for c in payload["cards"]]}

    ask = lambda ids: stages._ask_decisions(folder, spark.createDataFrame([(i,) for i in ids], "id string"), Model(), "", versions, None, [], 2, 1)
    assert ask(["a", "b"]) == 0
    with open(folder / "checkpoint.jsonl", "ab") as f:
        f.write(b'{"card_sha256": "c", "deci')
    assert read_tolerant(spark, str(folder / "checkpoint.jsonl"), stages.CHECKPOINT).count() == 2
    assert ask(["c"]) == 0
    got = stages._decisions(spark, folder, versions, None)
    assert sorted(r.card_sha256 for r in got.collect()) == ["a", "b", "c"]
