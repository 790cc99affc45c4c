import http.server
import json
import subprocess
import sys
import threading
from pathlib import Path

import pytest

from ledgerloom.plans import effects, files, model, parts, plan


def test_batches_are_unique(tmp_path):
    assert len({plan.new_batch(tmp_path) for _ in range(20)}) == 20


def test_csv():
    assert plan.csv_line(['a"b', None, ["x", "y"], 1]) == '"a""b","","x | y","1"\n'


@pytest.fixture
def planned(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    rows = []
    for i in range(3):
        (source / f"{i}.json").write_text(str(i))
        rows.append((i, "copy", str(source / f"{i}.json"), str(target / f"d/{i}.json"), plan.file_hash(source / f"{i}.json"), "planned"))
    df = spark.createDataFrame(rows, "ordinal long, operation string, source_path string, destination_path string, sha256 string, status string")
    folder = plan.new_batch(tmp_path / "plans")
    digest, n = parts.write_parts(df.repartition(3), folder)
    assert n == 3 and digest == parts.root_as_found(spark, folder)
    assert [r.source_path for r in parts.read_parts(spark, folder, "source_path string").collect()] == [r[2] for r in rows]
    plan.write_approval(folder, plan_sha256=digest, operation="copy", destination_root=str(target))
    return folder, source, target


def test_approval_and_copy(spark, planned):
    folder, source, target = planned
    approval = effects.approval_of(folder)
    with pytest.raises(plan.NotApproved):
        effects.execute(spark, folder, approval)
    approval["approved"] = True
    for wrong in ({"plan_sha256": "0"}, {"operation": "delete"}):
        with pytest.raises(plan.NotApproved):
            effects.execute(spark, folder, approval | wrong)
    with pytest.raises(plan.NotApproved, match="scope"):
        effects.execute(spark, folder, approval, scope="other")
    part = next((folder / "plan").glob("*.jsonl"))
    whole = part.read_bytes()
    part.write_bytes(whole.replace(b"d/1", b"d/7"))
    with pytest.raises(plan.NotApproved, match="not the one"):
        effects.execute(spark, folder, approval)
    part.write_bytes(whole)
    (source / "1.json").write_text("changed")
    assert effects.execute(spark, folder, approval) == {"copied": 2, "failed": 1}
    assert sorted(p.name for p in (target / "d").iterdir()) == ["0.json", "2.json"] and (source / "0.json").exists()
    assert [p.name for p in target.iterdir()] == ["d"]  # no staging is left
    with pytest.raises(FileNotFoundError):
        plan.execution_evidence(folder, approval["plan_sha256"], 3, "copied")
    with pytest.raises(FileExistsError):
        effects.execute(spark, folder, approval)


def test_move_and_evidence(spark, planned):
    folder, source, target = planned
    approval = effects.approval_of(folder) | {"approved": True, "operation": "move"}
    (target / "d").mkdir(parents=True)
    (target / "d" / "2.json").write_text("2")  # equal, but not ours
    assert effects.execute(spark, folder, approval) == {"moved": 2, "failed": 1}
    assert [p.name for p in source.iterdir()] == ["2.json"]
    log = {r.source_path[-6:]: (r.result, r.detail) for r in effects.log_of(spark, folder).collect()}
    assert log == {"0.json": ("moved", ""), "1.json": ("moved", ""), "2.json": ("failed", "the destination existed")}
    with pytest.raises(FileNotFoundError):
        plan.execution_evidence(folder, approval["plan_sha256"], 3)


def test_an_interrupted_execution_goes_on(spark, planned):
    """Files that an attempt made, and a source that it moved, count as done; the log has each row once."""
    folder, source, target = planned
    approval = effects.approval_of(folder) | {"approved": True, "operation": "move"}
    rows = parts.read_parts(spark, folder, effects.COPY).drop("status")
    effects.looked_up(rows).write.parquet(str(folder / "before-execution"))
    row = {"source_path": str(source / "0.json"), "destination_path": str(target / "d/0.json"), "sha256": plan.file_hash(source / "0.json")}
    assert effects.copy(row, approval, str(target / f".{folder.name}")) == "moved"  # moved, and then the task was lost
    assert effects.copy(row, approval, str(target / f".{folder.name}")) == "moved"  # run again
    files.make(str(target / "d/1.json"), str(target / f".{folder.name}"), plan.file_hash(source / "1.json"), lambda out: out.write(b"1"))
    assert effects.execute(spark, folder, approval) == {"moved": 3}
    assert not any(source.iterdir()) and sorted(p.name for p in target.rglob("*")) == ["0.json", "1.json", "2.json", "d"]
    assert plan.execution_evidence(folder, approval["plan_sha256"], 3, "moved")


KILLED = """
import os, sys
from pathlib import Path
from pyspark.sql import SparkSession
from ledgerloom.plans import effects

root = Path(sys.argv[1])
spark = SparkSession.builder.master("local[2, 4]").config("spark.sql.shuffle.partitions", "3").config("spark.ui.enabled", "false").getOrCreate()

def dying(row, approval, staging):
    result = effects.copy(row, approval, staging)
    try:
        os.close(os.open(root / ("died-" + row["sha256"][:4]), os.O_CREAT | os.O_EXCL))
    except FileExistsError:
        return result
    if row["sha256"][0] in "0123456789":
        os._exit(9)  # the file is made, the worker dies
    return result

folder = next((root / "plans").iterdir())
print(effects.execute(spark, folder, effects.approval_of(folder) | {"approved": True, "operation": sys.argv[2]}, act=dying))
"""


@pytest.mark.parametrize("operation, result", [("move", "moved")])
def test_killed_tasks_are_repeated(spark, planned, tmp_path, operation, result):
    """Workers die after they have made a file; the tasks run again and the log is whole."""
    folder, source, target = planned
    run = subprocess.run([sys.executable, "-c", KILLED, str(tmp_path), operation], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parent.parent)
    assert str({result: 3}) in run.stdout, run.stderr[-2000:]
    assert len(list(tmp_path.glob("died-*"))) == 3 and sorted(p.read_text() for p in (target / "d").iterdir()) == ["0", "1", "2"]
    assert effects.log_of(spark, folder).count() == 3


def test_parts_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "ROWS", 100)
    rows = spark.range(950).selectExpr("-id AS ordinal", "id", "array('a', cast(id AS string)) AS list", "CAST(NULL AS string) AS nothing").repartition(6)
    root, n = parts.write_parts(rows, tmp_path)
    said = parts.manifest(tmp_path)
    assert n == 950 and len(said["parts"]) > 5 and sum(p["rows"] for p in said["parts"]) == 950 and said["root"] == root
    lines = [json.loads(x) for p in said["parts"] for x in (tmp_path / "plan" / p["name"]).read_text().splitlines()]
    assert [x["id"] for x in lines] == list(range(949, -1, -1)) and lines[0] == {"id": 949, "list": ["a", "949"], "nothing": None}
    again = tmp_path / "again"
    again.mkdir()
    assert parts.write_parts(rows.repartition(2), again)[1] == 950
    assert parts.changed_parts(spark, tmp_path) == []
    last = tmp_path / "plan" / said["parts"][-1]["name"]
    last.write_bytes(last.read_bytes()[:-2] + b"]\n")
    (tmp_path / "plan" / said["parts"][0]["name"]).unlink()
    assert parts.changed_parts(spark, tmp_path) == [said["parts"][0]["name"], said["parts"][-1]["name"]] and parts.root_as_found(spark, tmp_path) is None
    assert (tmp_path / "plan-table").is_dir() and parts.write_parts(rows.limit(0), tmp_path / "again", name="none")[1] == 0


def test_paths(tmp_path):
    assert plan.is_inside("/A/b", "/a") and not plan.is_inside("/ab", "/a") and plan.is_inside("/a", "/A") and not plan.is_inside("/a", "/a", strictly=True)
    assert not plan.is_inside("/a/../b", "/a")
    plan.require_empty(tmp_path / "none")
    (tmp_path / "x").write_text("")
    with pytest.raises(ValueError):
        plan.require_empty(tmp_path)


class Server:
    """Answers in turn with (status, headers, body)."""

    def __init__(self, *answers):
        outer = self
        self.answers, self.requests = list(answers), []

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                outer.requests.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
                status, headers, body = outer.answers.pop(0)
                self.send_response(status)
                for k, v in headers.items():
                    self.send_header(k, v)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/v1"


def completion(text, **usage):
    return 200, {}, json.dumps({"choices": [{"message": {"content": text}}], "usage": usage}).encode()


def client(server, log=None, budget=None, **settings):
    waits = []
    s = model.Settings(model.check_endpoint(server.url, False), "m", **settings)
    c = model.HttpClient(s, budget or model.Budget(), (log if log is not None else []).append, model.Slots(0, sleep=waits.append))
    return c, waits


def test_client_retries_and_logs():
    log = []
    c, _ = client(s := Server(completion("no json"), completion('```json\n{"a":1}\n```')), log, max_tokens=77)
    assert c.ask("sys", {"x": 1}) == {"a": 1} and len(s.requests) == 2 and s.requests[0]["max_tokens"] == 77
    assert [e["event"] for e in log] == ["request_reserved", "request_completed"] * 2 and log[1]["outcome"] == "error"


def test_client_stops_on_fatal_filter_and_budget():
    c, _ = client(s := Server((403, {}, b"")))
    with pytest.raises(model.ModelError) as e:
        c.ask("", {})
    assert e.value.fatal and len(s.requests) == 1
    c, _ = client(s := Server(completion("content filter triggered", completion_tokens=0)))
    with pytest.raises(model.Filtered):
        c.ask("", {})
    c, _ = client(s := Server((503, {}, b"")), budget=model.Budget(max_requests=1))
    with pytest.raises(model.OverBudget):
        c.ask("", {})
    assert len(s.requests) == 1
    c, _ = client(s := Server(), budget=model.Budget(max_bytes=1))
    with pytest.raises(model.OverBudget):
        c.ask("", {})
    assert not s.requests


def test_client_waits_after_429_and_stops_when_the_log_fails():
    c, waits = client(Server((429, {"Retry-After": "3"}, b""), completion('{"ok":1}')))
    assert c.ask("", {}) == {"ok": 1} and waits and 2.5 < waits[0] <= 3

    def broken(event):
        raise OSError("disk")

    s = Server()
    c = model.HttpClient(model.Settings(model.check_endpoint(s.url, False), "m"), model.Budget(), broken)
    with pytest.raises(OSError):
        c.ask("", {})
    assert not s.requests


def test_endpoints_and_settings():
    for host in ("localhost", "127.8.0.1", "[::1]", "[::ffff:127.0.0.1]"):
        assert model.check_endpoint(f"http://{host}:1/v1", False).endswith("/v1/chat/completions")
    for url in ("http://192.0.2.1/v1", "https://remote.example/v1", "ftp://localhost"):
        with pytest.raises(ValueError):
            model.check_endpoint(url, False)
    assert model.check_endpoint("https://remote.example/v1/chat/completions", True) == "https://remote.example/v1/chat/completions"
    s = model.settings_from({"MODEL_API_URL": "http://localhost/v1", "MODEL_NAME": "m", "MODEL_BATCH_SIZE": "3"}, concurrency=5)
    assert (s.batch_size, s.concurrency, s.attempts, s.max_tokens, s.confidence) == (3, 5, 2, 2048, 0.8)
    for bad in ({"MODEL_CONCURRENCY": "11"}, {"MODEL_MAX_ATTEMPTS": "x"}, {"MODEL_CONFIDENCE_THRESHOLD": "2"}):
        with pytest.raises(ValueError):
            model.settings_from({"MODEL_API_URL": "http://localhost/v1", "MODEL_NAME": "m"} | bad)


def test_answers():
    assert model.parse_answer('so: {"a":1} end') == model.parse_answer('```\n{"a":1}```') == {"a": 1}
    with pytest.raises(model.ModelError):
        model.parse_answer("none")


def test_split_and_resume():
    calls = []

    def request(items):
        calls.append(items)
        if len(items) > 1:
            raise model.ModelError("large", 413, splittable=True)
        return {str(items[0]): "ok"}

    assert model.resolve_batch([1, 2], request, str) == ({"1": "ok", "2": "ok"}, []) and calls == [[1, 2], [1], [2]]
    answers, left = model.resolve_batch([1, 2], lambda items: {"1": "ok"}, str)
    assert answers == {"1": "ok"} and [x for x, _ in left] == [2]
    b = model.Budget.resumed([{"event": "request_reserved", "request_bytes": 5}, {"outcome": "error", "request_bytes": -1}, {"event": "request_completed", "outcome": "success", "request_bytes": 9}], max_requests=2)
    assert (b.requests, b.bytes) == (2, 5)


def test_workers_stop_after_an_error():
    done = []

    def work(i):
        if i == 2:
            raise RuntimeError("x")
        done.append(i)

    with pytest.raises(RuntimeError):
        model.run_workers(list(range(100)), work, 1)
    assert done == [0, 1]
