"""Queries over whole tables: against DuckDB on the given tables and on fixtures, and against plain Python."""

from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerloom import whole_queries
from ledgerloom.functions import canonical_json as cj
from ledgerloom.operators import audit
from ledgerloom.plans import files
from tests.test_queries import TABLES, plain

#: Queries that find nothing on the given tables.
EMPTY: set[str] = set()


def rows(relation, columns):
    at = [relation.columns.index(c) for c in columns]
    return sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)


def both(spark, folder, name, tables):
    """The query's rows, which must be those of its SQL; columns in the order of their names."""
    df, con = entry.queries()[name](spark, str(folder)), duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet{'/*.parquet' if str(folder) != '/root/testdata/sf0.001' else ''}'")
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns and got == rows(want, columns)
    return got


@pytest.fixture
def fixture(spark, tmp_path):
    def write(**tables):
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
        return tmp_path

    return write


@pytest.mark.parametrize("name", whole_queries.QUERIES)
def test_given_tables(spark, small, name):
    assert both(spark, small, name, TABLES) or name in EMPTY


def test_lorebook_of_any_length(spark, fixture):
    turns = defaultdict(list)
    turns[1] = ["x" * 61]
    turns[2] = ["first  part " * 40, "　second\n" * 40, "third"]
    turns[3] = ["a"] * 500
    turns[4] = [" ", " \n", None]
    turns[5] = ["y" * 350, "z" * 349, "cut"]
    turns[6] = ["y" * 350, "z" * 348, "cut"]
    turns[7] = ["y" * 350, "z" * 350]
    turns[8] = [" "] * 400 + ["behind blank turns"]
    turns[9] = [f"turn {i}" for i in range(45)]
    data = [(k, i, "user", t) for k, v in turns.items() for i, t in enumerate(v)]
    got = dict((conv, book) for book, conv in both(spark, fixture(conversations=(data, "conv_id long, turn long, role string, text string")), "lorebook_flatten", ["conversations"]))
    # Lists of thirty, so that flatten() sees each turn.
    blocks = lambda v: [v[i : i + 30] for i in range(0, len(v), 30)]
    assert got == {k: cj.flatten(blocks(v), 700) for k, v in turns.items()}
    assert got[1] == "x" * 61 and got[4] == "" and got[3] == " ".join("a" * 350) and got[9].endswith("turn 44") and got[8] == "behind blank turns" and got[2].endswith("…")


def test_budget_of_all_purchases(spark, fixture):
    data = [(i * 700, 1000 + i, "purchase" if i % 3 else "error", [20.0, 60.5, None, -30.0][i % 4]) for i in range(200)]
    got = both(spark, fixture(events=(data, "event_id long, user_id long, event_type string, value double")), "budget_running", ["events"])
    bought = [(i, v) for i, _, kind, v in data if kind == "purchase"]
    running = [sum(v or 0 for _, v in bought[: k + 1]) for k in range(len(bought))]
    assert got == sorted(((i, k < 50 and running[k] <= 1000) for k, (i, _) in enumerate(bought)), key=repr)
    assert 0 < sum(fits for _, fits in got) < len(got)


def test_budget_over_ranges(spark):
    data = [(i, None if i < -2_480 or i % 5 == 0 else (i * 37 % 101 - 40) / 4) for i in range(-2_500, 2_500, 7)]
    df = spark.createDataFrame(data, "n long, size double").repartition(5)
    out = audit.within_budget(df, "n", "size", 600, 90.0)
    want, known, total = {}, False, 0.0
    for k, (i, v) in enumerate(data):
        known, total = known or v is not None, total + (v or 0.0)
        want[i] = None if not known and k < 600 else k < 600 and total <= 90.0
    assert {r.n: r.fits for r in out.collect()} == want and set(want.values()) == {None, True, False}
    # No window runs over all events: each is within a partition of the range sort.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("windowspecdefinition(__part") == plan.count("windowspecdefinition(") > 0


def test_reconciliation_of_all_orders(spark, fixture):
    """Of the keys that end in 3: 3 is sound, 13 differs, 23 has no lines; 33 has no order."""
    orders = [(1, "F"), (2, "P"), (3, "O"), (13, "F"), (14, "O"), (23, "O"), (25, None), (26, None)]
    lines = [(1, "F"), (1, "F"), (2, "F"), (2, "O"), (3, "O"), (13, "O"), (14, "O"), (14, "F"), (33, "F"), (34, "O"), (25, "O")]
    folder = fixture(orders=(orders, "o_orderkey long, o_orderstatus string"), lineitem=(lines, "l_orderkey long, l_linestatus string"))
    got = both(spark, folder, "reconcile_full_outer", ["orders", "lineitem"])
    assert dict(got) == {13: "different", 14: "different", 23: "missing_right", 25: "different", 26: "missing_right", 33: "missing_left", 34: "missing_left"}


def test_same_card_by_whole_texts(spark, fixture):
    """Texts that agree in their first 200 characters only are not one card."""
    start = "the same start " * 20
    texts = ["A  card\nin two files", "a card in TWO files ", "a card in two files", start + "ends here", start + "ends there", "copy", "copy", start + "ENDS  here", "", " "]
    data = [(i, t, "en", "src1") for i, t in enumerate(texts)]
    got = both(spark, fixture(documents=(data, "doc_id long, text string, lang string, source string")), "same_card_different_file", ["documents"])
    assert sorted(files for files, *_ in got) == ["src1/en/0.json | src1/en/1.json | src1/en/2.json", "src1/en/3.json | src1/en/7.json", "src1/en/8.json | src1/en/9.json"]


def test_scan_of_documents_and_pages(spark, fixture):
    """Positives of each label in both tables, and what is allowed beside them."""
    texts = ["see https://api.service.com/v1/x", "http://example.com/v1 becomes another", "https://localhost:80/v1 http://127.0.0.1/v2/", "https://EXAMPLE.com/v1/ https://a.EXAMPLE.org:8/v2", "set OPENAPI_TOKEN now", "MODEL_API_KEY API_TOKEN MY_MODEL_SECRET", "MODEL_SECRET and X_PASSWORD", "a Jailbreak", "无限制模式", "C:\\Users\\me\\x", "D:\\a b\\c", "E:\\plain\\c", "me@mail.org", "me@EXAMPLE.com", "me@EXAMPLE.com, you@mail.org SOME_SECRET jailbreak", "me@org\0.org a@b.cc", "a@b.cc \ufffd", None, ""]
    labels = {0: "E", 1: "E", 4: "C", 6: "C", 7: "U", 8: "U", 9: "P", 10: "P", 12: "M", 14: "MCU"}
    names = {"E": "external API endpoint", "C": "credential variable", "U": "unsafe prompt marker", "P": "private-looking Windows path", "M": "email address"}
    rows = list(enumerate(texts))
    folder = fixture(documents=(rows, "doc_id long, text string"), pages=(rows, "page_id long, html string"))
    got = both(spark, folder, "content_scan", ["documents", "pages"])
    assert sorted(got) == sorted((names[x], f"{t}/{i}") for t in ("documents", "pages") for i, v in labels.items() for x in v)


def test_records_with_controls(spark, fixture):
    texts = [None, "", "one\ntwo\r\nthree\r", '"q" \\ \\n \t\x01\x1f\x0c\b', "\n\n", "x\u2028y\u0085z\x7f", 'a\n{"relative_path" :', "é" * 3000 + "\n"]
    folder = fixture(documents=([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = both(spark, folder, "jsonl_records", ["documents"])
    assert len(got) == len(texts) and {lines for _, lines, _ in got} == {1, 2, 3} and sum(r for _, _, r in got) == 5


def test_checkpoint_and_log(spark, fixture):
    events = [(1, 5, "purchase", 2.5), (2, 5, "view", 9.0), (3, 5, "purchase", None), (4, None, "purchase", 1.0), (5, 6, "purchase", 0.1), (6, 6, None, 3.0)]
    folder = fixture(events=(events, "event_id long, user_id long, event_type string, value double"), orders=([(1, None, "a\nb", 0.1), (None, "O", "", None)], "o_orderkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"))
    assert both(spark, folder, "checkpoint_log", ["events"]) == [("5", None, 3), ("6", 0.1, 5)]
    assert len(both(spark, folder, "strict_log", ["orders"])) == 2


def test_supplier_files_are_made_by_many_tasks(spark, small):
    """The table is one partition; its files, one for each supplier, are not made by one task."""
    sc = spark.sparkContext
    sc.setJobGroup("suppliers", "files of suppliers")
    try:
        path, listed = whole_queries._supplier_files(spark, small)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("suppliers") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    rows, suppliers = listed.collect(), spark.read.parquet(f"{small}/supplier.parquet").collect()
    assert len(rows) == len({r.relative_path for r in rows}) == len(suppliers)
    want = {b'{"spec":"chara_card_v2","data":{"name":"%d","tags":["old","n%d"]}}\n' % (r.s_suppkey, r.s_nationkey) for r in suppliers}
    assert {bytes(r.content) for r in rows} == want


def test_supplier_files_need_no_commit_by_the_driver(spark, small):
    """The files that a plan moves stand in many folders, put in place by tasks; no committer moved them one by one."""
    path, listed = whole_queries._supplier_files(spark, small)
    fs, base = files.opened(path)
    names = {x.base_name for x in fs.get_file_info(files.listing(base))}
    assert "_SUCCESS" not in names and names >= {f"d{i}" for i in range(listed.count())}
    assert not fs.get_file_info(files.listing(f"{base}/.staging"))


SUPPLIER = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"


@pytest.mark.parametrize("keys", [[], [7, 11, 14, 22]])
def test_plans_of_which_nothing_arrives(spark, fixture, keys):
    """No suppliers at all, and only such whose files stay where they are."""
    folder = fixture(supplier=([(k, "s", k % 5, 1.0) for k in keys], SUPPLIER))
    assert len(both(spark, folder, "executed_plan", ["supplier"])) == len(keys)
    assert len(both(spark, folder, "executed_tags", ["supplier"])) == len(keys)


def test_moved_files_stand_in_many_folders(spark, fixture, monkeypatch):
    """The folders that a plan moves files into are as many as those they come from, and more for more files."""
    folder = fixture(supplier=([(k, "s", 1, 1.0) for k in range(1, 7)], SUPPLIER))
    paths, fresh_path = {}, whole_queries.fresh_path
    monkeypatch.setattr(whole_queries, "fresh_path", lambda spark, name: paths.setdefault(name, fresh_path(spark, name)))
    assert len(both(spark, folder, "executed_plan", ["supplier"])) == 6
    fs, base = files.opened(paths["moved"])
    assert sum(x.base_name.startswith("d") for x in fs.get_file_info(files.listing(base))) > 1
    assert whole_queries._folders(1_000) == 100 and whole_queries._folders(360_000) == 180
