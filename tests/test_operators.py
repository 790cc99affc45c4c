import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit, decisions, destinations, duplicates, grouping, merging, naming, ordering


def test_duplicates(spark):
    rows = [("a", "n.png", "1", "c1", "甲", "x"), ("b", "N.png", "1", "c1", "甲", "x"), ("c", "o.png", "2", "c1", "甲", "x"), ("d", "n.png", "3", "c2", "甲", "X"), ("e", "", "4", None, "", "")]
    df = spark.createDataFrame(rows, "relative_path string, file_name string, sha256 string, card_sha256 string, name string, creator string")
    members = duplicates.duplicate_members(df)
    got = {r.type: (r.group_size, r.files) for r in duplicates.pages(members).collect()}
    assert got == {duplicates.EXACT: (2, ["a", "b"]), duplicates.SAME_CARD: (3, ["a", "b", "c"]), duplicates.SAME_NAME: (3, ["a", "b", "d"]), duplicates.VERSION: (4, ["a", "b", "c", "d"])}
    assert {r.type: (r.groups, r.files) for r in duplicates.type_counts(duplicates.group_sizes(df)).collect()}[duplicates.VERSION] == (1, 4)
    assert duplicates.duplicate_members(df.limit(0)).count() == 0 and duplicates.pages(members.limit(0)).count() == 0
    few = sorted((r.page, r.files) for r in duplicates.pages(members, 3).filter(F.col("type") == duplicates.VERSION).collect())
    assert few == [(0, ["a", "b", "c"]), (1, ["d"])]


def test_decisions_round_trip(spark):
    records = spark.createDataFrame([("a", "h1", True), ("b", "h1", True), ("c", "h2", True), ("d", "h3", True), ("e", "h4", False), ("f", "h5", True)], "relative_path string, card_sha256 string, has_content boolean")
    raw = spark.createDataFrame([("h1", "classify", "同人", ""), ("h2", "exclude", None, ""), ("h3", "review", None, ""), ("h4", "classify", "x", ""), ("", "review", None, ""), ("h5", "classify", "a/b", "")], "card_sha256 string, decision string, category string, reason string")
    good = decisions.normalise_decision(raw)
    assert {r.card_sha256: r.category for r in good.collect()} == {"h1": "同人", "h2": decisions.EXCLUDED_INSIDE, "h3": None, "h4": "x"}
    mapped = decisions.map_back(records, good)
    got = {r.relative_path: (r.category, r.classification_source, r.model_decision, r.needs_review) for r in mapped.collect()}
    assert got["a"] == got["b"] == ("同人", "model", "classify", False)
    assert got["c"] == (None, "model", "exclude", True) and got["e"] == got["f"] == (None, "manual_review", "review", True)
    assert {r.card_sha256 for r in decisions.pending(records, good, F.col("has_content")).collect()} == {"h5"}
    answers = spark.createDataFrame([("h2", "classify", "同人"), ("h3", "review", None)], "card_sha256 string, decision string, category string")
    merged = decisions.merge_review(mapped, decisions.first_review_targets(mapped), answers)
    got = {r.relative_path: (r.model_decision, r.recheck_status, r.merged) for r in merged.collect()}
    assert got == {"a": ("classify", None, False), "b": ("classify", None, False), "c": ("classify", "complete", True), "d": ("review", "complete", True), "e": ("review", "no_semantic_content", False), "f": ("review", "incomplete", False)}
    assert {(r.previous_decision, r.model_decision, r.files) for r in decisions.transitions(merged).collect()} == {("exclude", "classify", 1), ("review", "review", 1)}
    assert [r.relative_path for r in decisions.second_review_targets(merged).collect()] == ["d"]


def test_conflict_and_batches(spark):
    rows = spark.createDataFrame([("h", "review", None), ("h", "exclude", None), ("g", "review", None)], "card_sha256 string, model_decision string, category string")
    assert [r.card_sha256 for r in decisions.conflicting(rows).collect()] == ["h"]
    b = decisions.batches(spark.createDataFrame([(i * 5000,) for i in range(10)], "ordinal long"), 4)
    assert [r.batch for r in b.orderBy("ordinal").collect()] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_transition_identities(spark):
    rng = random.Random(4)
    rows = [(str(i), f"h{i % 90}", True) for i in range(300)]
    pick = lambda: rng.choice(decisions.DECISIONS)
    records = spark.createDataFrame(rows, "relative_path string, card_sha256 string, has_content boolean")
    first = spark.createDataFrame([(f"h{i}", d := pick(), "c" if d == "classify" else None) for i in range(80)], "card_sha256 string, decision string, category string")
    mapped = decisions.map_back(records, first).cache()
    second = spark.createDataFrame([(f"h{i}", d := pick(), "c" if d == "classify" else None) for i in range(90)], "card_sha256 string, decision string, category string")
    targets = decisions.first_review_targets(mapped)
    merged = decisions.merge_review(mapped, targets, second)
    assert sum(r.files for r in decisions.transitions(merged).collect()) == targets.count() and merged.count() == 300
    before, after = ({r.model_decision: r["count"] for r in d.groupBy("model_decision").count().collect()} for d in (mapped, merged))
    moved = {(r.previous_decision, r.model_decision): r.files for r in decisions.transitions(merged).collect()}
    for d in decisions.DECISIONS:
        assert after.get(d, 0) == before.get(d, 0) + sum(n for (a, b), n in moved.items() if b == d) - sum(n for (a, b), n in moved.items() if a == d)


def test_grouping(spark):
    rows = [(p,) for p, n in (("同人", 101), ("现代都市", 500), ("排除", 101), ("未分类", 101), ("标准外", 101), ("直播", 100)) for _ in range(n)]
    df = spark.createDataFrame(rows, "parent_category string")
    assert {r.parent_category for r in grouping.selected_parents(df).collect()} == {"同人", "排除", "未分类", "标准外"}
    cases = [("排除", None, "角色16岁", "未成年或幼态内容"), ("排除", None, "116岁", "其他排除原因"), ("排除", None, "英文的血腥", "外文内容"), ("未分类", None, "伪娘且加密", "核心性别属性"), ("未分类", None, "语言", "中外文边界"), ("标准外", "科幻", "", "科幻"), ("标准外", "con", "", "其他"), ("同人", None, "", None)]
    got = spark.createDataFrame(cases, "p string, c string, r string, want string").withColumn("got", grouping.special_subcategory(F.col("p"), F.col("c"), F.col("r")))
    assert all(r.got == r.want for r in got.collect())
    names = [("Genshin Impact 同人", "原神"), ("FGO", "FGO"), ("fate", "Fate系列"), ("其他作品", "其他"), ("某某作品同人", "某某"), ("同人", "其他"), ("a/b", None)]
    got = spark.createDataFrame(names, "v string, want string").withColumn("got", grouping.normal_subcategory(F.lit("同人"), F.col("v")))
    assert [(r.v, r.got) for r in got.collect()] == names
    with pytest.raises(Exception, match="invalid classification state"):
        spark.range(1).select(grouping.parent_category(F.lit("classify"), F.lit(None).cast("string"), None)).collect()


def test_group_resolution(spark):
    rows = spark.createDataFrame([("g1", "排除", "a"), ("g1", "排除", "b"), ("g2", "标准外", "其他"), ("g3", "排除", "a")], "group_id string, parent_category string, subcategory string")
    got = {r.group_id: (r.subcategory, r.used_fallback) for r in grouping.resolve_groups(rows).collect()}
    assert got == {"g1": ("其他排除原因", True), "g2": ("其他", True), "g3": ("a", False)}


def test_merging(spark):
    rows = [("原神", 4, ["游戏"]), ("原神系列", 7, []), ("Fate系列", 49, []), ("FGO", 2, []), ("月姬", 1, []), ("小众游戏", 5, ["游戏"]), ("六张作品", 6, []), ("其他", 357, []), ("无", 2, []), ("双", 2, ["游戏", "小说"]), ("独立", 10, ["小说"])]
    got = {r.current_directory: r for r in merging.candidates(spark.createDataFrame(rows, "current_directory string, file_count long, source_categories array<string>")).collect()}
    assert (got["原神系列"].canonical_name, got["原神"].canonical_group_file_count, got["原神"].suggested_target) == ("原神", 11, "原神")
    assert {got[k].suggested_target for k in ("Fate系列", "FGO", "月姬")} == {"型月世界"} and got["FGO"].suggested_target_file_count == 52
    assert got["小众游戏"].suggested_target == "其他游戏同人" and got["六张作品"].recommendation == "门槛待审核"
    assert {got[k].suggested_target for k in ("其他", "无", "双")} == {"待确认原作"} and got["独立"].recommendation == "保留独立目录"
    c = merging.candidates(spark.createDataFrame(rows, "current_directory string, file_count long, source_categories array<string>"))
    merging.check_candidates(c)
    totals = merging.policy_totals(c, merging.BELOW).first()
    assert tuple(totals) == (1, 1, 6)
    approved = merging.approved_targets(c, spark.createDataFrame([("独立", "新")], "current_directory string, approved_target string"), merging.BELOW, "待确认原作")
    got = {r.current_directory: (r.approved_target, r.approval_source) for r in approved.collect()}
    assert got["独立"] == ("新", "manual_override") and got["六张作品"] == ("待确认原作", "minimum_policy") and got["原神"] == ("原神", "candidate")


def test_reconcile(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, c string")
    b = spark.createDataFrame([(1, None), (2, "z"), (4, "y")], "k int, c string")
    assert {(r.k, r.problem) for r in merging.reconcile(a, b, "k", ["c"]).collect()} == {(2, "different"), (3, "missing_right"), (4, "missing_left")}


def brute_destinations(rows, taken=()):
    used, out = {t.lower() for t in taken}, {}
    for i, path, sha in rows:
        head, _, name = path.rpartition("/")
        stem, dot, ext = name.rpartition(".") if "." in name[1:] else (name, "", "")
        candidate, n = path, 1
        while candidate.lower() in used:
            candidate = f"{head}/{stem}__{sha[:12]}{f'-{n}' * (n > 1)}{dot}{ext}"
            n += 1
        used.add(candidate.lower())
        out[i] = candidate
    return out


def test_destinations_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        sha = rng.choice("abc") * 64
        name = rng.choice(["a.png", "A.png", "b.json", ".hid", "c", f"a__{sha[:12]}.png", f"b__{sha[:12]}-2.json"])
        rows.append((i, f"{rng.choice(['x', 'Y', 'z'])}/{name}", sha))
    df = spark.createDataFrame(rows, "ordinal long, wanted_path string, sha256 string")
    got = {r.ordinal: r.destination_path for r in naming.assign_destinations(df).collect()}
    assert got == brute_destinations(rows) and len({x.lower() for x in got.values()}) == 300
    plain = [r for r in rows if "__" not in r[1]]
    df = spark.createDataFrame(plain, "ordinal long, wanted_path string, sha256 string")
    taken = ["x/a.png", "z/c"]
    got = {r.ordinal: r.destination_path for r in naming.assign_destinations(df, taken=spark.createDataFrame([(t,) for t in taken], "path string")).collect()}
    assert got == brute_destinations(plain, taken)


def brute_versions(rows):
    """(status, target) by ordinal: the rule, file by file."""
    used, out = {}, {}
    for i, name, sha in sorted(rows):
        stem, dot, ext = name.rpartition(".") if "." in name[1:] else (name, "", "")
        target, n = name, 0
        while target.lower() in used and used[target.lower()] != sha:
            n += 1
            target = f"{stem}__{sha[:12]}{f'-{n}' * (n > 1)}{dot}{ext}"
        status = "skipped_identical" if target.lower() in used else "copied_version" if n else "copied"
        used[target.lower()] = sha
        out[i] = (status, target)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_versions_against_brute_force(spark, seed):
    """Natural names equal generated ones, of versions and of versions of versions; hashes that differ behind the part in names."""
    rng = random.Random(seed)
    shas = [c * 64 for c in "abc"] + ["a" * 40 + "d" * 24]
    deep = [f"n__{s[:12]}{x}" for s in shas for x in ("", "-2")]
    names = ["n.png", "N.PNG", "m", ".hid", *(f"{x}.png" for x in deep), *(f"{x}__{s[:12]}.png" for x in deep for s in shas[:3])]
    rows = [(i, rng.choice(names[: rng.choice([4, 8, len(names)])]), rng.choice(shas)) for i in range(200)]
    df = spark.createDataFrame(rows, "ordinal long, file_name string, sha256 string").repartition(3)
    got = {r.ordinal: (r.status, r.target_name) for r in naming.collect_versions(df).collect()}
    assert got == brute_versions(rows)


def test_two_files_never_get_one_name(spark):
    taken = f"x__{'b' * 12}.png"
    rows = [(1, "x.png", "a" * 64), (2, "x.png", "b" * 64), (3, taken, "c" * 64), (4, taken, "b" * 64)]
    got = {r.ordinal: (r.status, r.target_name) for r in naming.collect_versions(spark.createDataFrame(rows, "ordinal long, file_name string, sha256 string")).collect()}
    assert got == {1: ("copied", "x.png"), 2: ("copied_version", taken), 3: ("copied_version", f"x__{'b' * 12}__{'c' * 12}.png"), 4: ("skipped_identical", taken)}


def test_running_values_over_borders(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 5 + [None, "a", "b"]), i, rng.randrange(-5, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(4)
    sums, most, rank = {}, {}, {}
    want = {}
    for k, i, v in rows:
        sums[k], most[k], rank[k] = sums.get(k, 0) + v, max(most.get(k, v), v), rank.get(k, 0) + 1
        want[i] = sums[k], most[k], rank[k]
    got = [{r.i: r.x for r in f(df, ["k"], [F.col("i")], partitions=7).collect()} for f in (lambda *a, **b: ordering.running(*a, F.col("v"), "x", **b), lambda *a, **b: ordering.running(*a, F.col("v"), "x", how="max", **b), lambda *a, **b: ordering.rank_within(*a, "x", **b))]
    assert {i: tuple(g[i] for g in got) for i in want} == want
    total = ordering.running(df, [], [F.col("i")], F.col("v"), "x", partitions=5).orderBy("i").collect()
    assert total[-1].x == sum(v for _, _, v in rows)


def test_collect_versions_and_guards(spark):
    df = spark.createDataFrame([(1, "s.json", "a" * 64), (2, "S.json", "b" * 64), (3, "s.json", "a" * 64), (4, "t.json", "a" * 64)], "ordinal long, file_name string, sha256 string")
    got = {r.ordinal: (r.status, r.target_name) for r in naming.collect_versions(df).collect()}
    assert got == {1: ("copied", "s.json"), 2: ("copied_version", f"S__{'b' * 12}.json"), 3: ("skipped_identical", "s.json"), 4: ("copied", "t.json")}
    names = spark.createDataFrame([("a:",), ("A?",), ("b",)], "category string")
    assert [tuple(r) for r in destinations.colliding_categories(names).collect()] == [("a_", 2)]
    with pytest.raises(ValueError, match="twice"):
        destinations.must_be_empty(destinations.repeated_paths(spark.createDataFrame([("p",), ("p",)], "relative_path string")), "twice")


def test_audit(spark):
    texts = ["see https://api.service.com/v1/x", "https://api.example.com/v1", "set OPENAPI_TOKEN now", "MODEL_API_KEY", "a jailbreak", "C:\\Users\\me\\x", "me@mail.org", "me@example.com", "me@org\0.org"]
    df = spark.createDataFrame(list(enumerate(texts)), "name int, text string")
    got = {(r.name, r.label) for r in audit.content_failures(df, "name", "text").collect()}
    assert got == {(0, "external API endpoint"), (2, "credential variable"), (4, "unsafe prompt marker"), (5, "private-looking Windows path"), (6, "email address")}
    links = audit.markdown_links(spark.createDataFrame([("d", "[a](b.md#x) [c](https://x) [d](#y) [e](f.md)")], "name string, text string"), "name", "text")
    assert {r.link for r in links.collect()} == {"b.md", "f.md"}
    broken = audit.broken_links(links.withColumn("resolved", F.col("link")), spark.createDataFrame([("b.md",)], "path string"))
    assert [r.link for r in broken.collect()] == ["f.md"]
    log = spark.createDataFrame([("request_reserved", None, 10.0), (None, "success", 5.0), ("request_completed", "success", 10.0), ("request_reserved", None, float("nan"))], "event string, outcome string, request_bytes double")
    assert tuple(audit.usage_summary(log).first()) == (3, 15.0)


def test_organised_sources(spark):
    h = {c: c * 64 for c in "abcd"}
    rows = spark.createDataFrame([("p", "n.json", h["a"]), ("p", "m.json", h["b"]), ("p", "M2.json", h["c"]), ("q", "n.json", h["a"]), ("p", "gone.json", h["d"])], "parent_category string, file_name string, sha256 string")
    files = spark.createDataFrame([("p/n.json", h["a"]), ("p/n__" + "a" * 12 + ".json", h["a"]), ("p/m__" + "b" * 12 + "-2.json", h["b"]), ("p/m2__" + "C" * 12 + ".json", h["c"]), ("q/other.json", h["a"]), ("p/gone.json", h["a"])], "relative_path string, sha256 string")
    got = {(r.parent_category, r.file_name): r.source_relative for r in destinations.organised_sources(rows, files).collect()}
    assert got == {("p", "n.json"): "p/n.json", ("p", "m.json"): f"p/m__{'b' * 12}-2.json", ("p", "M2.json"): f"p/m2__{'C' * 12}.json", ("q", "n.json"): None, ("p", "gone.json"): None}
