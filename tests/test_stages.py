"""The stages end to end, on nine card files and a stub for the model."""

import json
from collections import Counter
from pathlib import Path

import pytest

from ledgerloom.__main__ import parser
from ledgerloom.plans import chain, parts, plan, stages
from ledgerloom.plans.model import Filtered, ModelError
from ledgerloom.sources import cards
from tests.test_cards import png, v2


class Stub:
    """Decides by the card's name; forgets one card on its first round of questions."""

    def __init__(self, decisions, forgets=()):
        self.decisions, self.forgets, self.asked = decisions, set(forgets), []

    def ask(self, system, payload):
        out = []
        for c in payload["cards"]:
            self.asked.append(c["name"])
            if c["name"] not in self.forgets:
                decision, category = self.decisions[c["name"]]
                out.append({"id": c["id"], "decision": decision, "category": category, "reason": "角色16岁"})
        return {"results": out}


def plan_lines(folder):
    return [json.loads(x) for p in parts.manifest(folder)["parts"] for x in (folder / "plan" / p["name"]).read_text().splitlines()]


def blank():
    return {"spec": "chara_card_v2", "data": {}}


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("cards")
    files = {"a/n.png": png(("chara", v2(name="甲"))), "b/n.png": png(("chara", v2(name="甲"))), "c/other.png": png(("chara", v2(name="甲")), tail=b"cover"), "d/n.json": v2(name="甲", character_version="2"), "e/x.json": v2(name="乙"), "f/y.json": v2(name="丙"), "g/z.json": v2(name="丁"), "h/blank.json": blank(), "i/w.json": v2(name="戊")}
    for path, data in files.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(data if isinstance(data, bytes) else json.dumps(data).encode())
    return root


def approve(folder, **more):
    path = folder / "approval.json"
    path.write_text(json.dumps(json.loads(path.read_text()) | {"approved": True} | more, ensure_ascii=False))


def test_from_scan_to_tags(spark, source, tmp_path):
    reports = lambda n: str(tmp_path / "reports" / n)
    scanned = stages.scan(spark, str(source), reports("020"))
    assert stages._summary(scanned)["statuses"] == {"valid": 9}
    found = stages.find_duplicates(spark, scanned, reports("030"))
    assert set(stages._summary(found)["groups"]) == {"exact_file_duplicate", "same_card_different_file", "same_filename_different_content", "suspected_version"} - ({"same_filename_different_content"} if "same_filename_different_content" not in stages._summary(found)["groups"] else set())

    stub = Stub({"甲": ("classify", "同人"), "乙": ("exclude", None), "丙": ("review", None), "丁": ("classify", "a/b"), "戊": ("classify", "科幻")}, forgets=["戊"])
    dry = stages.classify(spark, scanned, reports("050d"), stub, "", ("m", "p"), batch_size=2, dry_run=True)
    assert {"status": "prepared", "unique_pending": 6, "batches": 3}.items() <= stages._summary(dry).items() and not stub.asked
    first = stages.classify(spark, scanned, reports("050"), stub, "", ("m", "p"), batch_size=2)
    assert stages._summary(first)["status"] == "incomplete" and stages._summary(first)["unanswered"] == 1
    asked, stub.forgets = len(stub.asked), set()
    first = stages.classify(spark, scanned, reports("050"), stub, "", ("m", "p"), batch_size=2, resume=first)
    assert sorted(set(stub.asked[asked:])) == ["丁", "戊"]
    s = stages._summary(first)
    assert (s["status"], s["files"], s["classify"], s["exclude"], s["manual"]) == ("complete", 9, 5, 1, 2)
    with pytest.raises(ValueError, match="other inputs"):
        stages.classify(spark, scanned, reports("050"), stub, "", ("m2", "p"), batch_size=2, resume=first)

    again = Stub({"乙": ("classify", "同人"), "丙": ("review", None), "丁": ("exclude", None)})
    second = stages.review(spark, first, scanned, reports("051"), again, "", ("m", "p"), ["同人", "规则模拟"])
    assert stages._summary(second)["transitions"] == {"exclude->classify": 1, "review->review": 1, "review->exclude": 1}
    third = stages.review(spark, second, scanned, reports("052"), Stub({"丙": ("exclude", None)}), "", ("m", "p"), ["同人"], second=True)
    assert stages._summary(third)["transitions"] == {"review->exclude": 1}

    organised = stages.organise(spark, third, str(source), str(tmp_path / "out1"), reports("060"), ["同人"])
    lines = plan_lines(organised)
    assert Counter(x["category"] for x in lines) == {"同人": 5, "标准外": 1, "排除": 2, "未分类": 1} and len({x["destination_path"].lower() for x in lines}) == 9
    with pytest.raises(plan.NotApproved):
        stages.execute(spark, organised)
    approve(organised)
    assert stages.execute(spark, organised) == {"copied": 9}

    groups = spark.createDataFrame([(r.g, "原神 同人") for r in spark.read.parquet(str(third / "classifications")).selectExpr("sha2(concat('同人', chr(0), card_sha256), 256) g").distinct().collect()], "group_id string, subcategory string")
    media = spark.createDataFrame([("原神", "游戏")], "subcategory string, medium string")
    refined = stages.refine(spark, third, reports("070"), ["同人"], groups, media, threshold=1)
    assert json.loads((refined / "taxonomy.json").read_text()) == {"同人": {"原神": 5}, "排除": {"未成年或幼态内容": 2}}
    placed = stages.organise_refined(spark, refined, str(source), str(tmp_path / "out2"), reports("080"))
    approve(placed)
    assert stages.execute(spark, placed) == {"copied": 9}

    proposed = stages.propose_merges(spark, refined, placed, reports("090"))
    assert stages._summary(proposed)["candidates"] == 1
    policy = {"recommendation": "门槛待审核", "approved_target": "待确认原作", "canonical_group_count": 0, "current_directory_count": 0, "file_count": 0}
    with pytest.raises(plan.NotApproved):
        stages.organise_merged(spark, proposed, refined, str(source), str(tmp_path / "out3"), reports("100"))
    approve(proposed, below_minimum_policy=policy, expected_waiting_bucket_file_count=1)
    index = next((proposed / "fanwork-index").glob("*.jsonl"))
    index.write_bytes(index.read_bytes().replace(b"n.png", b"m.png", 1))
    with pytest.raises(plan.NotApproved, match="fanwork-index"):
        stages.organise_merged(spark, proposed, refined, str(source), str(tmp_path / "out3"), reports("100"))
    index.write_bytes(index.read_bytes().replace(b"m.png", b"n.png", 1))
    with pytest.raises(plan.NotApproved, match="wait"):
        stages.organise_merged(spark, proposed, refined, str(source), str(tmp_path / "out3"), reports("100"))
    approve(proposed, below_minimum_policy=policy, expected_waiting_bucket_file_count=0)
    merged = stages.organise_merged(spark, proposed, refined, str(source), str(tmp_path / "out3"), reports("100"))
    approve(merged)
    assert stages.execute(spark, merged) == {"copied": 9} and (tmp_path / "out3" / "同人" / "其他游戏同人").is_dir()

    with pytest.raises(ValueError, match="approved targets"):  # another stage's plan
        stages.plan_tags(spark, placed, str(tmp_path / "out2"), str(tmp_path / "out4"), reports("110"))
    approve(merged, scope="all")
    with pytest.raises(plan.NotApproved, match="scope"):
        stages.plan_tags(spark, merged, str(tmp_path / "out3"), str(tmp_path / "out4"), reports("110"))
    approve(merged, scope=stages.MERGED)
    tagged = stages.plan_tags(spark, merged, str(tmp_path / "out3"), str(tmp_path / "out4"), reports("110"))
    rows = plan_lines(tagged)
    assert {tuple(r["tags_actually_added"]) for r in rows if r["parent_category"] == "同人"} == {("其他游戏同人",)}
    assert stages._summary(tagged)["totals"] == {"added": 5 + 4, "already_tagged": 0, "unchanged": 0, "invalid": 0}
    approve(tagged)
    assert stages.execute_tags(spark, tagged) == {"tagged_copy_written": 9}
    some = next(p for p in (tmp_path / "out4").rglob("*.png"))
    assert cards.decode("p", some.read_bytes(), ".png")["card"]["tags"] == ["已有标签", "同人", "其他游戏同人"]
    other = stages.plan_tags(spark, merged, str(tmp_path / "out3"), str(tmp_path / "out5"), reports("111"), replace=True)
    approve(other)
    assert stages.execute_tags(spark, other) == {"tagged_copy_written": 9}
    # The chain goes back to the scan, and refuses whatever is not what it was, wherever it stands.
    batches = chain.verify(spark, tagged, deep=True)
    assert {b.parent.name for b in batches} == {"110", "100", "090", "080", "070", "052", "051", "050", "020"}
    swapped = next((third / "classifications").glob("part-*.parquet"))
    whole = swapped.read_bytes()
    swapped.write_bytes(whole[:-9] + b"x" + whole[-8:])
    chain.verify(spark, tagged)
    with pytest.raises(chain.Broken, match="bytes"):
        chain.verify(spark, tagged, deep=True)
    swapped.write_bytes(whole)
    index = scanned / "summary.json"
    said = index.read_text()
    index.write_text(said + " ")
    with pytest.raises(chain.Broken, match="scanned"):
        stages.execute_tags(spark, other)
    index.write_text(said)
    with pytest.raises(ValueError, match="names no file"):
        stages.plan_tags(spark, merged, str(tmp_path / "out3"), str(tmp_path / "out6"), reports("110"), unchanged=("no.png",))


class Works:
    """Names works and media; refuses full cards of one name, and forgets a medium at first."""

    def __init__(self):
        self.asked, self.forget = [], True

    def ask(self, system, payload):
        self.asked.append(payload)
        if "works" in payload:
            forgotten, self.forget = self.forget, False
            return {"results": [] if forgotten else [{"id": w["id"], "fanwork_source_category": "游戏"} for w in payload["works"]]}
        if any(c["name"] == "refused" and "description" in c for c in payload["cards"]):
            raise Filtered("no")
        return {"results": [{"id": c["id"], "subcategory": "Genshin Impact" if c["name"] != "odd" else "Own World"} for c in payload["cards"]]}


@pytest.fixture
def fanworks(spark, tmp_path):
    """A scan and its complete classification: fanworks, and excluded cards with reasons of several stages."""
    names = ["one", "refused", "odd", "x", "y", "z"]
    root = tmp_path / "cards"
    root.mkdir()
    for n in names:
        (root / f"{n}.json").write_text(json.dumps(v2(name=n, description=f"about {n}")))
    scanned = stages.scan(spark, str(root), str(tmp_path / "r020"))
    decided = Stub({n: ("classify", "同人") for n in names[:3]} | {n: ("exclude", None) for n in names[3:]})
    classified = stages.classify(spark, scanned, str(tmp_path / "r050"), decided, "", ("m", "p"))
    return scanned, classified, root


def test_refinement_asks_the_model(spark, fanworks, tmp_path):
    scanned, classified, root = fanworks
    client = Works()
    out = stages.refine(spark, classified, str(tmp_path / "r070"), ["同人"], threshold=1, scanned=scanned, client=client, batch_size=1)
    rows = {r.relative_path: r for r in spark.read.parquet(str(out / "refinements")).collect()}
    assert {p: (r.subcategory, r.fanwork_source_category, r.used_fallback) for p, r in rows.items() if r.parent_category == "同人"} == {"one.json": ("原神", "游戏", False), "refused.json": ("原神", "游戏", False), "odd.json": ("Own World", "游戏", False)}
    assert {r.subcategory for r in rows.values() if r.parent_category == "排除"} == {"未成年或幼态内容"}
    assert stages._summary(out)["selected"] == ["同人", "排除"]
    cards_asked = [p["cards"][0] for p in client.asked if "cards" in p]
    assert [set(c) == {"id", "name", "creator", "tags"} for c in cards_asked if c["name"] == "refused"] == [False, True]
    assert "Genshin Impact" in client.asked[-4 if "works" in client.asked[-1] else -1].get("labels", ["Genshin Impact"])
    # Complete: nothing is asked again.
    n = len(client.asked)
    again = stages.refine(spark, classified, str(tmp_path / "r070"), ["同人"], threshold=1, scanned=scanned, client=client, batch_size=1, resume=out)
    assert len(client.asked) == n and stages._summary(again)["status"] == "complete"
    with pytest.raises(ValueError, match="other inputs"):
        stages.refine(spark, classified, str(tmp_path / "r070"), ["同人"], threshold=2, scanned=scanned, client=client, batch_size=1, resume=out)
    richer = stages.enrich(spark, out, str(tmp_path / "r071"), client)
    assert {p["works"][0]["name"] for p in client.asked[n:]} == {"Own World"} | {"原神"} or len(client.asked) == n + 1
    assert spark.read.parquet(str(richer / "refinements")).filter("fanwork_source_category = '游戏'").count() == 3
    people = spark.read.option("header", True).option("escape", '"').csv(str(out / "review"))
    assert tuple(people.columns) == stages.REFINED_TABLE and people.count() == 6


def test_reasons_of_the_reviews_count_first(spark, fanworks, tmp_path):
    scanned, classified, _ = fanworks

    class Reviewer(Stub):
        def ask(self, system, payload):
            return {"results": [{"id": c["id"], "decision": "exclude", "reason": {"x": "英文内容", "y": "", "z": "含血腥描写"}[c["name"]]} for c in payload["cards"]]}

    reviewed = stages.review(spark, classified, scanned, str(tmp_path / "r051"), Reviewer({}), "", ("m", "p"), ["同人"])
    out = stages.refine(spark, reviewed, str(tmp_path / "r070"), ["同人"], threshold=1)
    assert {r.relative_path: r.subcategory for r in spark.read.parquet(str(out / "refinements")).filter("parent_category = '排除'").collect()} == {"x.json": "外文内容", "y.json": "未成年或幼态内容", "z.json": "R18G与血腥猎奇"}
    again = stages.review(spark, classified, scanned, str(tmp_path / "r051"), Stub({}), "", ("m", "p"), ["同人"], resume=reviewed)
    assert stages._summary(again)["transitions"] == {"exclude->exclude": 3}
    people = spark.read.option("header", True).csv(str(reviewed / "review"))
    assert tuple(people.columns) == stages.REVIEW_TABLE and people.count() == 3


def test_fatal_errors_leave_answers_and_the_way_on(spark, fanworks, tmp_path):
    scanned, _, _ = fanworks

    class Failing:
        def __init__(self):
            self.calls = 0

        def ask(self, system, payload):
            self.calls += 1
            if self.calls == 2:
                raise ModelError("no more", 401, fatal=True)
            return {"results": [{"id": payload["cards"][0]["id"], "decision": "classify", "category": "一"}]}

    with pytest.raises(ModelError):
        stages.classify(spark, scanned, str(tmp_path / "r050f"), Failing(), "", ("m", "p"), batch_size=3)
    folder = next((tmp_path / "r050f").iterdir())
    assert stages._summary(folder)["status"] == "interrupted" and str(folder) in stages._summary(folder)["resume"]
    assert len((folder / "checkpoint.jsonl").read_text().splitlines()) == 1


def test_overrides_are_refused(spark):
    found = spark.createDataFrame([("a",), ("b",)], "current_directory string")
    good = {"current_directory": "a", "approved_target": "t", "reason": "r"}
    assert stages._overrides(spark, [good], found).count() == 1
    for bad in ([good, good], [good | {"reason": " "}], [good | {"current_directory": "c"}], [good | {"approved_target": "x:y"}], [{"current_directory": "a", "approved_target": "t"}]):
        with pytest.raises(plan.NotApproved):
            stages._overrides(spark, bad, found)


def test_fanwork_index_holds_the_files_of_all_directories(spark):
    """Over a million directories, and one of several files."""
    n = 1_000_050
    found = spark.range(n).selectExpr("concat('d', id) current_directory", "concat('d', id) canonical_name", "concat('t', id) suggested_target")
    fanwork = spark.range(n + 5).selectExpr("concat(id, '.json') relative_path", "'h' sha256", "'c' card_sha256", "concat('d', id % 1000050) subcategory", "'游戏' fanwork_source_category")
    index = stages._fanwork_index(fanwork, found)
    assert index.filter("suggested_target = replace(current_directory, 'd', 't')").count() == n + 5
    assert index.columns == ["current_directory", "relative_path", "sha256", "card_sha256", "fanwork_source_category", "canonical_name", "suggested_target"]


def test_collect(spark, tmp_path):
    for d, text in (("one", "1"), ("two", "2"), ("three", "1")):
        (tmp_path / d).mkdir()
        (tmp_path / d / "same.json").write_text(text)
        (tmp_path / d / "x.txt").write_text("no")
    sources = [str(tmp_path / d) for d in ("one", "two", "three", "none")]
    dry = stages.collect(spark, sources, str(tmp_path / "all"), str(tmp_path / "r"), dry_run=True)
    assert stages._summary(dry)["counts"] == {"source_missing": 1, "would_copy": 1, "would_copy_version": 1, "skipped_identical": 1}
    done = stages.collect(spark, sources, str(tmp_path / "all"), str(tmp_path / "r"))
    assert stages._summary(done)["counts"] == {"source_missing": 1, "copied": 1, "copied_version": 1, "skipped_identical": 1}
    names = sorted(p.name for p in (tmp_path / "all").iterdir())
    assert len(names) == 2 and "same.json" in names and any(n.startswith("same__") for n in names)
    assert stages._summary(stages.collect(spark, sources[:1], str(tmp_path / "all"), str(tmp_path / "r")))["counts"] == {"skipped_identical": 1}


def test_collect_settles_contested_names(spark, tmp_path):
    """A natural name equals the version of another file; one name is taken by a file that lies in the folder."""
    import hashlib

    mark = lambda text: hashlib.sha256(text.encode()).hexdigest()[:12]
    (tmp_path / "all").mkdir()
    (tmp_path / "all" / "Y.json").write_text("there")
    given = {"a/x.json": "1", "b/x.json": "2", f"b/x__{mark('2')}.json": "3", f"c/x__{mark('2')}.json": "2", "c/y.json": "there", "c/z/y.json": "other"}
    for path, text in given.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)
    (tmp_path / "a" / "link.json").symlink_to(tmp_path / "a" / "x.json")
    done = stages.collect(spark, [str(tmp_path / d) for d in "abc"], str(tmp_path / "all"), str(tmp_path / "r"))
    assert stages._summary(done)["counts"] == {"copied": 1, "copied_version": 3, "skipped_identical": 2}
    got = {p.name: p.read_text() for p in (tmp_path / "all").iterdir()}
    assert got == {"Y.json": "there", "x.json": "1", f"x__{mark('2')}.json": "2", f"x__{mark('2')}__{mark('3')}.json": "3", f"y__{mark('other')}.json": "other"}


def test_latest_and_command_line(tmp_path):
    folder = plan.new_batch(tmp_path / "a")
    stages._done(folder)
    stages._done(plan.new_batch(tmp_path / "b"), "incomplete")
    assert stages.latest_of(str(tmp_path / "none"), str(tmp_path / "b"), str(tmp_path / "a")) == folder
    with pytest.raises(FileNotFoundError):
        stages.latest(str(tmp_path / "b"))
    a = parser().parse_args(["append-tags", "p", "s", "d", "--copy-unchanged", "x", "--copy-unchanged", "y"])
    assert a.copy_unchanged == ["x", "y"] and a.reports == "reports/append-tags"
    with pytest.raises(SystemExit):
        parser().parse_args(["collect", "d"])
    assert Path(a.source).name == "s"
