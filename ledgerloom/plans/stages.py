"""The stages: each reads a batch of the one before, writes a batch of its own, and says what it did.

Relations are written by Spark as JSON lines or Parquet; plans, approvals and
summaries, which a person reads and signs, by the driver.
"""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import decisions, destinations, duplicates, grouping, merging, naming, ordering
from ledgerloom.operators.model_input import has_semantic_content, model_inputs
from ledgerloom.plans import effects, files, parts
from ledgerloom.plans import plan as P
from ledgerloom.plans.chain import chained, verify
from ledgerloom.plans.log import CheckpointLog
from ledgerloom.plans.model import Client, Filtered, ModelError, resolve_batch, run_workers
from ledgerloom.plans.scratch import written
from ledgerloom.sources import card_source, cards

CHECKPOINT = "card_sha256 string, decision string, category string, reason string, model_version string, prompt_version string, ordinal long"
VALID = "card is not null and status in ('valid', 'valid_with_warnings')"


def _done(folder: Path, status: str = "complete", **summary: object) -> Path:
    P.write_json(folder / "summary.json", {"status": status} | summary)
    return folder


def _relation(spark: SparkSession, folder: Path, name: str) -> DataFrame:
    return spark.read.parquet(str(folder / name))


def _summary(folder: Path) -> dict:
    return json.loads((folder / "summary.json").read_text(encoding="utf-8"))


def _complete(folder: Path) -> dict:
    summary = _summary(folder)
    if summary["status"] != "complete":
        raise ValueError(f"{folder} is not complete")
    return summary


def _table(rows: DataFrame, folder: Path, name: str) -> None:
    """A table for people: CSV with every field quoted."""
    rows.write.mode("overwrite").option("quoteAll", True).option("escape", '"').option("header", True).csv(str(folder / name))


def _index_errors(spark: SparkSession, scanned: Path, folder: Path) -> None:
    """The files of the scan that hold no card, with what is wrong with them."""
    _relation(spark, scanned, "index").filter(f"not coalesce({VALID}, false)").select("relative_path", "status", "detail").write.mode("overwrite").json(str(folder / "index-errors"))


def _begin(reports: str, resume: Path | None, bound: dict, budget: dict | None = None) -> Path:
    """A new batch that notes what it is bound to, or the one to resume, which must be bound to the same; its budget may be raised but not lowered."""
    if resume is None:
        folder = P.new_batch(reports)
    else:
        folder, run = resume, json.loads((resume / "run.json").read_text(encoding="utf-8"))
        if {k: run.get(k) for k in bound} != bound:
            raise ValueError("the batch was begun with other inputs or settings")
        for k, v in (run.get("budget") or {}).items():
            if v is None and (budget or {}).get(k) is not None or v is not None and (budget or {}).get(k) is not None and budget[k] < v:
                raise ValueError(f"{k} is lower than when the batch was begun")
    P.write_json(folder / "run.json", bound | {"budget": budget or {}})
    return folder


# --- Collect, scan, duplicates.


FOUND = "source string, file_name string, sha256 string"
COLLECTED = "ordinal long, source string, target string, status string"


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Paths to (source, file_name, sha256); links are left out."""
    for batch in batches:
        kept = [p for p in batch["path"] if not os.path.islink(p)]
        yield pd.DataFrame({"source": kept, "file_name": [p.rpartition("/")[2] for p in kept], "sha256": [files.hash_of(p) for p in kept]}, columns=["source", "file_name", "sha256"], dtype=object)


def _collected(destination: str, staging: str, dry_run: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def one(r: dict) -> str:
        if r["status"] == "skipped_identical":
            return r["status"]
        if dry_run:
            return f"would_{r['status'].replace('copied', 'copy')}"
        try:
            files.make(files.join(destination, r["target_name"]), staging, r["sha256"], lambda out: files.copied_to(r["source"], out))
            return r["status"]
        except (OSError, ValueError) as e:
            return f"failed: {e}"

    def collected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.to_dict("records")
            yield pd.DataFrame([(r["ordinal"], r["source"], r["target_name"], one(r)) for r in rows], columns=[c.split()[0] for c in COLLECTED.split(", ")])

    return collected


def collect(spark: SparkSession, sources: list[str], destination: str, reports: str, dry_run: bool = False) -> Path:
    """Copy all card files of the sources, in their order, into one folder; sources stay as they are.

    Files are listed by Spark, hashed and copied in tasks; names settle by claims (operators/naming.py), those in the folder first. A task that is run again finds its files made.
    """
    folder, target = P.new_batch(reports), Path(destination).resolve()
    hashed = lambda place, at: cards.list_paths(spark, f"file://{Path(place).resolve()}").mapInPandas(_hashed, FOUND).withColumn("at", F.lit(at))
    there = [(i, s) for i, s in enumerate(sources, 1) if Path(s).is_dir()]
    found = spark.createDataFrame([], FOUND + ", at int")
    if target.is_dir():
        found = hashed(target, 0).filter(F.col("source") == F.concat(F.lit(f"{target}/"), "file_name"))
    for i, s in there:
        found = found.unionByName(hashed(s, i))
    found = ordering.with_ordinal(written(found, "found"), [F.col("at"), F.col("source")])
    named = written(naming.collect_versions(found).filter("at > 0"), "named")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-named.count() // effects.FILES))
    staging = files.join(str(target), f".{folder.name}")
    try:
        named.select("ordinal", "source", "sha256", "target_name", "status").repartition(tasks, "source").mapInPandas(_collected(str(target), staging, dry_run), COLLECTED).write.parquet(str(folder / "collected"))
    finally:
        files.remove_folder(staging)
    missing = spark.createDataFrame([(0, s, None, "source_missing") for i, s in enumerate(sources, 1) if (i, s) not in there], COLLECTED)
    log = _relation(spark, folder, "collected").unionByName(missing)
    _table(log.orderBy("ordinal", "source").select("source", "target", "status"), folder, "collect")
    return _done(folder, counts={r.status: r.files for r in log.groupBy(F.split_part("status", F.lit(":"), F.lit(1)).alias("status")).agg(F.count(F.lit(1)).alias("files")).collect()})


@chained()
def scan(spark: SparkSession, source: str, reports: str) -> Path:
    """The index of all card files below ``source``, an audit table, and counts by status and version."""
    folder = P.new_batch(reports)
    card_source.register(spark)
    spark.read.format("card_files").load(str(Path(source).resolve())).drop("bytes_read").write.parquet(str(folder / "index"))
    index = _relation(spark, folder, "index")
    _table(index.select("relative_path", "status", "detail", "metadata_chunk", F.array_join("warnings", " | ").alias("warnings"), "sha256"), folder, "audit")
    counted = lambda c: {str(r.label): r["count"] for r in cards.counted(index, c).collect()}
    return _done(folder, files=index.count(), statuses=counted("status"), versions=counted("version"))


@chained("scanned")
def find_duplicates(spark: SparkSession, scanned: Path, reports: str) -> Path:
    folder = P.new_batch(reports)
    index = _relation(spark, scanned, "index").select("relative_path", "file_name", "sha256", "card_sha256", F.col("card.name").alias("name"), F.col("card.creator").alias("creator"))
    duplicates.duplicate_members(index).write.parquet(str(folder / "members"))
    members = _relation(spark, folder, "members")
    duplicates.ordered(duplicates.pages(members)).write.json(str(folder / "groups"))
    _table(duplicates.review_table(index, members), folder, "review")
    _index_errors(spark, scanned, folder)
    return _done(folder, groups={r.type: r.groups for r in duplicates.type_counts(duplicates.group_sizes(index)).collect()})


# --- Classification and reviews.


def _answer_rows(answer: object, accept: Callable[[dict], bool]) -> dict[str, dict] | None:
    """The answer's results that hold, by id; None if it has no list of results."""
    rows = answer.get("results", answer) if isinstance(answer, dict) else answer
    return {str(r.get("id")): r for r in rows if isinstance(r, dict) and accept(r)} if isinstance(rows, list) else None


def _ask(folder: Path, name: str, pending: DataFrame, client: Client, system: str, payload: Callable[[list[dict]], dict], accept: Callable[[dict], bool], record: Callable[[str, dict], dict], batch_size: int, workers: int, on_filter: Callable[[dict], dict] | None = None) -> int:
    """Ask about ``pending`` inputs, few enough for the driver to hold one partition of. The number without an answer, which stand in ``name``-errors.jsonl.

    The answers of each round are in the log ``name`` before the next is asked for; a log whose writer was stopped within a line is mended first. Where content is refused, ``on_filter`` reduces the items for one more request. After a fatal error the summary says so, and how to go on.
    """
    log, lock, failed = CheckpointLog(folder, name), threading.Lock(), 0

    def save(answers: dict[str, dict]) -> None:
        with lock:
            log.append(record(k, r) for k, r in answers.items())

    def request(items: list[dict]) -> dict[str, dict] | None:
        try:
            return _answer_rows(client.ask(system, payload(items)), accept)
        except Filtered:
            if on_filter is None:
                raise
            return _answer_rows(client.ask(system, payload(list(map(on_filter, items)))), accept)

    def work(batch: list[dict]) -> None:
        nonlocal failed
        _, left = resolve_batch(batch, request, lambda x: x["id"], save)
        with lock, open(folder / f"{name}-errors.jsonl", "a", encoding="utf-8") as out:
            failed += len(left)
            for x, e in left:
                out.write(json.dumps({"id": x["id"], "error": e.record() if isinstance(e, ModelError) else {"message": str(e)}}, ensure_ascii=False) + "\n")

    batch: list[dict] = []
    jobs: list[list[dict]] = []
    (folder / f"{name}-errors.jsonl").write_text("", encoding="utf-8")
    try:
        for row in pending.toLocalIterator():
            batch.append(row.asDict(recursive=True))
            if len(batch) == batch_size:
                jobs.append(batch)
                batch = []
            if len(jobs) == 10 * workers:
                run_workers(jobs, work, workers)
                jobs = []
        run_workers(jobs + [batch] * bool(batch), work, workers)
    except ModelError as e:
        _done(folder, "interrupted", fatal_error=e.record(), resume=f"--resume {folder}")
        raise
    finally:
        log.close()
    return failed


def _ask_decisions(folder: Path, pending: DataFrame, client: Client, system: str, versions: tuple[str, str], allowed: list[str] | None, known: list[str], batch_size: int, workers: int) -> int:
    """Decisions on cards. Without a closed list, each request names the categories accepted so far, so that answers depend on the order of requests."""
    categories = dict.fromkeys(known)

    def accept(r: dict) -> bool:
        named = bool(str(r.get("category") or "").strip()) and (allowed is None or r["category"] in allowed)
        return r.get("decision") in decisions.DECISIONS and (r["decision"] != decisions.CLASSIFY or named)

    def record(k: str, r: dict) -> dict:
        if allowed is None and r["decision"] == decisions.CLASSIFY:
            categories.setdefault(r["category"])
        return {"card_sha256": k, "decision": str(r["decision"]), "category": r.get("category"), "reason": str(r.get("reason") or ""), "model_version": versions[0], "prompt_version": versions[1]}

    named = lambda: {"categories": allowed} if allowed is not None else {"existing_categories": list(categories)}
    return _ask(folder, "checkpoint", pending, client, system, lambda items: named() | {"cards": items}, accept, record, batch_size, workers)


def _decisions(spark: SparkSession, folder: Path, versions: tuple[str, str], allowed: list[str] | None) -> DataFrame:
    from ledgerloom.sources.jsonl import read_checkpoint

    rows = CheckpointLog(folder, "checkpoint").read(spark, CHECKPOINT)
    return read_checkpoint(decisions.normalise_decision(rows, allowed), *versions)


#: The columns of the table that a person reads after the first pass, and after the reviews.
FIRST_TABLE = ("relative_path", "name", "suggested_category", "decision", "needs_review", "human_category", "review_notes")
REVIEW_TABLE = ("relative_path", "name", "first_decision", "first_category", "recheck_decision", "recheck_category", "recheck_reason", "needs_review", "human_category", "review_notes")
SECOND_TABLE = ("relative_path", "name", "original_first_decision", "previous_decision", "previous_category", "previous_reason", "third_decision", "third_category", "third_reason", "needs_review", "human_category", "review_notes")


def _for_people(rows: DataFrame, columns: tuple[str, ...], **of: str) -> DataFrame:
    """``rows`` as a table: each column is that of its name, or of the name given, or empty for a person to fill."""
    return rows.select(*(F.col(of.get(c, c)).alias(c) if of.get(c, c) in rows.columns else F.lit("").alias(c) for c in columns))


@chained("scanned")
def classify(spark: SparkSession, scanned: Path, reports: str, client: Client | None, system: str, versions: tuple[str, str], batch_size: int = 30, workers: int = 1, resume: Path | None = None, dry_run: bool = False, settings: dict | None = None, budget: dict | None = None) -> Path:
    """First pass: one question for each content, answers back to every file. ``resume`` continues a batch of the same inputs, versions and ``settings`` (endpoint, attempts, tokens); ``dry_run`` only counts."""
    bound = {"scan": str(scanned), "model_version": versions[0], "prompt_version": versions[1], "batch_size": batch_size} | (settings or {})
    folder = _begin(reports, resume, bound, budget)
    index = _relation(spark, scanned, "index").filter(VALID).withColumn("ordinal", F.col("relative_path"))
    # The first file of each content supplies the question.
    unique = decisions.first_wins(index.select("card_sha256", "card", "ordinal"), ["card_sha256"])
    inputs = model_inputs(unique).withColumn("has_content", has_semantic_content())
    known = _decisions(spark, folder, versions, None)
    pending = decisions.pending(inputs.withColumnRenamed("id", "card_sha256"), known, F.col("has_content")).withColumnRenamed("card_sha256", "id").drop("has_content")
    if dry_run or client is None:
        n = pending.count()
        return _done(folder, "prepared", unique_pending=n, batches=-(-n // batch_size))
    categories = [r.category for r in decisions.categories(known.filter(F.col("decision") == decisions.CLASSIFY)).collect()]  # directories of one level
    left = _ask_decisions(folder, pending, client, system, versions, None, categories, batch_size, workers)
    content = inputs.select(F.col("id").alias("card_sha256"), "has_content")
    records = index.join(content, "card_sha256").select("relative_path", "file_name", "sha256", "card_sha256", F.col("card.name").alias("name"), F.col("card.creator").alias("creator"), "has_content")
    out = decisions.map_back(records, _decisions(spark, folder, versions, None)).withColumn("recheck_status", F.lit(None).cast("string"))
    done = _write_classification(spark, folder, out, left)
    _table(_for_people(_relation(spark, folder, "classifications"), FIRST_TABLE, suggested_category="category", decision="model_decision"), folder, "review")
    _index_errors(spark, scanned, folder)
    return done


def _write_classification(spark: SparkSession, folder: Path, rows: DataFrame, left: int) -> Path:
    rows.write.mode("overwrite").parquet(str(folder / "classifications"))
    written = _relation(spark, folder, "classifications")
    destinations.must_be_empty(destinations.repeated_paths(written), "paths are empty or repeated")
    totals = decisions.counts(written).first().asDict()
    return _done(folder, "incomplete" if left else "complete", unanswered=left, **totals)


@chained("previous", "scanned")
def review(spark: SparkSession, previous: Path, scanned: Path, reports: str, client: Client, system: str, versions: tuple[str, str], allowed: list[str], second: bool = False, batch_size: int = 10, workers: int = 5, resume: Path | None = None, settings: dict | None = None, budget: dict | None = None) -> Path:
    """Ask again about what waits for a person, with a closed list of categories, and merge the answers. The second review goes by content. ``resume`` as in classify()."""
    said_before = _complete(previous)
    bound = {"previous": str(previous), "scan": str(scanned), "second": second, "model_version": versions[0], "prompt_version": versions[1], "batch_size": batch_size, "allowed": allowed} | (settings or {})
    folder = _begin(reports, resume, bound, budget)
    before = _relation(spark, previous, "classifications")
    destinations.must_count(before, said_before.get("files"), "the classification")
    targets = decisions.second_review_targets(before) if second else decisions.first_review_targets(before)
    destinations.must_be_empty(decisions.conflicting(targets), "files of one content had different decisions")
    index = _relation(spark, scanned, "index").filter(VALID).withColumn("ordinal", F.col("relative_path"))
    unique = decisions.first_wins(index.join(targets.select("card_sha256").distinct(), "card_sha256", "left_semi").select("card_sha256", "card", "ordinal"), ["card_sha256"])
    destinations.must_be_empty(targets.select("card_sha256").join(unique, "card_sha256", "left_anti"), "content is missing from the index")
    said = targets.groupBy(F.col("card_sha256").alias("id")).agg(F.first("model_decision").alias("previous_decision"), F.first("category").alias("previous_category"))
    inputs = model_inputs(unique).filter(has_semantic_content()).join(said, "id")
    pending = inputs.join(_decisions(spark, folder, versions, allowed).select(F.col("card_sha256").alias("id")), "id", "left_anti")
    left = _ask_decisions(folder, pending, client, system, versions, allowed, [], batch_size, workers)
    merged = decisions.merge_review(before, targets, _decisions(spark, folder, versions, allowed), "model_recheck_2" if second else "model_recheck", by_hash=second)
    if not second:
        merged = merged.withColumn("first_pass_decision", F.col("previous_decision"))
    done = _write_classification(spark, folder, merged, left)
    written = _relation(spark, folder, "classifications")
    rechecked = written.filter("merged")
    rechecked.write.mode("overwrite").parquet(str(folder / "rechecked"))
    if second:
        people = _for_people(rechecked, SECOND_TABLE, original_first_decision="first_pass_decision", previous_reason="recheck_reason", third_decision="model_decision", third_category="category", third_reason="recheck_2_reason")
    else:
        people = _for_people(rechecked, REVIEW_TABLE, first_decision="previous_decision", first_category="previous_category", recheck_decision="model_decision", recheck_category="category")
    _table(people, folder, "review")
    _index_errors(spark, scanned, folder)
    moved = {f"{r.previous_decision}->{r.model_decision}": r.files for r in decisions.transitions(written).collect()}
    return _done(done, _summary(done)["status"], transitions=moved, **{k: v for k, v in _summary(done).items() if k != "status"})


# --- Plans.


def _plan(rows: DataFrame, folder: Path, operation: str, root: str, more: dict) -> Path:
    digest, n = parts.write_parts(rows, folder)
    bound = {"plan_sha256": digest, "operation": operation, "destination_root": root, "rows": n, "batch": folder.name} | {k: more[k] for k in ("scope", "source_root") if k in more}
    P.write_approval(folder, **bound)
    return _done(folder, **(more | bound))


def _present(spark: SparkSession, rows: DataFrame, root: str) -> DataFrame:
    """``rows`` with status and detail: whether each source is there and has its hash. Files are hashed on the executors."""
    files = cards.list_files(spark, f"file://{Path(root).resolve()}").select(F.col("relative_path").alias("__path"), F.sha2("content", 256).alias("__actual"))
    joined = rows.join(files, F.col("source_relative") == F.col("__path"), "left")
    ok = F.col("__actual") == F.col("sha256")
    return joined.withColumns({"status": F.when(F.coalesce(ok, F.lit(False)), "planned").otherwise("source_missing_or_changed"), "detail": F.when(F.col("__actual").isNull(), "the source is missing").when(~ok, "the source's SHA-256 has changed").otherwise("")}).drop("__path", "__actual")


@chained("classified")
def organise(spark: SparkSession, classified: Path, source: str, destination: str, reports: str, allowed: list[str] | None, operation: str = "copy") -> Path:
    """A plan that gives every file a place below its level-1 parent; nothing is done before it is approved."""
    summary = _complete(classified)
    P.require_empty(destination)
    rows = _relation(spark, classified, "classifications")
    destinations.must_count(rows, summary.get("files"), "the classification")
    for problems, message in ((destinations.repeated_paths(rows), "paths"), (destinations.bad_hashes(rows), "hashes"), (destinations.inconsistent_decisions(rows), "decisions"), (destinations.colliding_categories(rows.filter("model_decision = 'classify'")), "categories")):
        destinations.must_be_empty(problems, f"the classification has bad {message}")
    parent = grouping.parent_category(F.col("model_decision"), F.col("category"), allowed)
    from ledgerloom.functions.text import safe_category

    rows = rows.withColumn("category", safe_category(parent)).select("relative_path", "file_name", "sha256", "card_sha256", "category", "classification_source", "model_decision")
    return _place(spark, rows, [F.col("category")], source, destination, P.new_batch(reports), operation, scope=FIRST_LEVEL)


def _place(spark: SparkSession, rows: DataFrame, levels: list, source: str, destination: str, folder: Path, operation: str, **more: object) -> Path:
    root = str(Path(destination).resolve())
    wanted = F.concat_ws("/", F.lit(root), *levels, "file_name")
    found = F.col("source_relative") if "source_relative" in rows.columns else F.col("relative_path")
    rows = rows.withColumns({"ordinal": F.col("relative_path"), "wanted_path": wanted, "source_relative": found})
    placed = naming.assign_destinations(_present(spark, rows, source))
    base = str(Path(source).resolve())
    out = placed.select(F.lit(operation).alias("operation"), *[c for c in rows.columns if c not in ("ordinal", "wanted_path", "source_relative", "file_name")], F.concat(F.lit(base + "/"), "source_relative").alias("source_path"), "destination_path", "status", "detail", "ordinal")
    return _plan(out, folder, operation, root, more | {"source_root": base})


#: What the plans of the stages cover; a plan of one is not taken for that of another.
FIRST_LEVEL, MERGED, TAGGING = "level-1 parents of all files", "approved targets of all fanworks", "tags of all organised files"


def _bound(spark: SparkSession, plan_folder: Path) -> dict:
    """What the approval of a plan must name: its batch, scope, roots and rows, as its summary has them, after its chain was followed."""
    verify(spark, plan_folder)
    summary = _complete(plan_folder)
    return {k: summary[k] for k in ("batch", "scope", "source_root", "destination_root", "rows") if k in summary}


def execute(spark: SparkSession, plan_folder: Path, approval: Path | None = None, operations: tuple[str, ...] = ("copy", "move")) -> dict[str, int]:
    """Copy or move the files of an approved plan, in tasks. The approval holds for this batch, its scope and its roots alone."""
    return effects.execute(spark, plan_folder, effects.approval_of(plan_folder, approval), operations, **_bound(spark, plan_folder))


#: What stage 070 refines; later stages accept only batches of this scope.
SCOPE = "fanwork works and deterministic groups of special directories"
WORK = "group_id string, subcategory string, model_version string, prompt_version string, ordinal long"
MEDIUM = "id string, name string, medium string, model_version string, prompt_version string, ordinal long"
REFINED_TABLE = ("relative_path", "parent_category", "fanwork_source_category", "subcategory", "selected_for_refinement", "classification_source", "used_fallback", "review_notes")
ASK_WORKS = "Name the work that each fan-made card belongs to: a short directory name, of `labels` where one fits, 其他 if none can be told. Answer in JSON: {\"results\": [{\"id\", \"subcategory\"}]}."
ASK_MEDIA = f"Give the medium in which each work first appeared, one of {'、'.join(grouping.MEDIA)}. Do not rename, merge or split works. Answer in JSON: {{\"results\": [{{\"id\", \"fanwork_source_category\"}}]}}."


def _read(spark: SparkSession, folder: Path, name: str, schema: str, key: str, versions: tuple[str, str]) -> DataFrame:
    """The last answer of each key to these versions, from a checkpoint that may not be there."""
    rows = CheckpointLog(folder, name).read(spark, schema).filter((F.col("model_version") == versions[0]) & (F.col("prompt_version") == versions[1]))
    return decisions.last_wins(rows, [key])


def _ask_works(spark: SparkSession, folder: Path, wanted: DataFrame, scanned: Path, client: Client, system: str, versions: tuple[str, str], batch_size: int, workers: int) -> tuple[DataFrame, int]:
    """(group_id, subcategory) of the fanworks ``wanted`` (group_id, card_sha256), and the number without an answer. Only fanworks are ever asked about."""
    index = _relation(spark, scanned, "index").filter(VALID).withColumn("ordinal", F.col("relative_path"))
    unique = decisions.first_wins(index.select("card_sha256", "card", "ordinal"), ["card_sha256"])
    destinations.must_be_empty(wanted.join(unique, "card_sha256", "left_anti"), "content is missing from the index")
    inputs = model_inputs(unique.join(wanted.select("group_id", "card_sha256").distinct(), "card_sha256"), keep=("group_id",))
    pending = inputs.filter(has_semantic_content()).drop("id").withColumnRenamed("group_id", "id")
    known = _read(spark, folder, "works", WORK, "group_id", versions)
    pending = pending.join(known.select(F.col("group_id").alias("id")), "id", "left_anti")
    labels = dict.fromkeys(r.subcategory for r in known.select("subcategory").distinct().collect())  # directories of one level

    def record(k: str, r: dict) -> dict:
        labels.setdefault(r["subcategory"])
        return {"group_id": k, "subcategory": r["subcategory"], "model_version": versions[0], "prompt_version": versions[1]}

    bare = lambda x: {k: x[k] for k in ("id", "name", "creator", "tags")}  # noqa: E731  # refused content is asked about by its metadata, once
    left = _ask(folder, "works", pending, client, f"{system}\n{ASK_WORKS}", lambda items: {"labels": list(labels), "cards": items}, lambda r: bool(str(r.get("subcategory") or "").strip()), record, batch_size, workers, bare)
    return _read(spark, folder, "works", WORK, "group_id", versions).select("group_id", "subcategory"), left


def _ask_media(spark: SparkSession, folder: Path, names: DataFrame, client: Client, system: str, versions: tuple[str, str], batch_size: int, workers: int) -> tuple[DataFrame, int]:
    """(subcategory, medium) of the works ``names`` (subcategory), and the number without an answer."""
    asked = names.filter(F.col("subcategory") != grouping.OTHER).distinct().select(grouping.source_group_id(F.col("subcategory")).alias("id"), F.col("subcategory").alias("name"))
    known = _read(spark, folder, "media", MEDIUM, "id", versions)
    pending = asked.join(known.select("id"), "id", "left_anti").orderBy(F.expr("name COLLATE zh"))
    name_of: dict[str, str] = {}

    def payload(items: list[dict]) -> dict:
        name_of.update((x["id"], x["name"]) for x in items)
        return {"works": items}

    record = lambda k, r: {"id": k, "name": name_of[k], "medium": r["fanwork_source_category"], "model_version": versions[0], "prompt_version": versions[1]}
    left = _ask(folder, "media", pending, client, f"{system}\n{ASK_MEDIA}", payload, lambda r: str(r.get("fanwork_source_category") or "").strip() in grouping.MEDIA, record, batch_size, workers)
    return _read(spark, folder, "media", MEDIUM, "id", versions).select(F.col("name").alias("subcategory"), "medium"), left


def _with_media(rows: DataFrame, media: DataFrame) -> DataFrame:
    """``rows`` with fanwork_source_category and source_category_source, of the works' ``media`` (subcategory, medium)."""
    known = media.select(F.col("subcategory").alias("__work"), grouping.source_medium(F.col("medium")).alias("__medium"))
    fanwork = F.col("selected_for_refinement") & (F.col("parent_category") == grouping.FANWORK)
    joined = rows.join(known, F.col("subcategory") == F.col("__work"), "left")
    return joined.withColumns({"fanwork_source_category": F.when(fanwork, F.coalesce("__medium", F.lit(grouping.OTHER))), "source_category_source": F.when(fanwork, F.when(F.col("__medium").isNull(), "fallback").otherwise("model"))}).drop("__work", "__medium")


def _write_refinement(spark: SparkSession, folder: Path, out: DataFrame, left: int, media_left: int) -> Path:
    columns = ["relative_path", "file_name", "sha256", "card_sha256", "model_decision", "original_category", "parent_category", "selected_for_refinement", "fanwork_source_category", "source_category_source", "subcategory", "refinement_source", "used_fallback"]
    out.select(columns).write.mode("overwrite").parquet(str(folder / "refinements"))
    written = _relation(spark, folder, "refinements")
    source = F.coalesce("source_category_source", "refinement_source")
    _table(_for_people(written.withColumn("classification_source", source), REFINED_TABLE), folder, "review")
    taxonomy: dict[str, dict[str, int]] = {}
    # Parents by their files, of equal ones the first seen; a row for each directory reaches the driver.
    parents = written.filter("selected_for_refinement").groupBy("parent_category").agg(F.count(F.lit(1)).alias("files"), F.min("relative_path").alias("first")).orderBy(F.desc("files"), "first").collect()
    for p in parents:
        taxonomy[p.parent_category] = {}
    for r in grouping.leaf_counts(written.filter("selected_for_refinement"), "parent_category", "subcategory").collect():
        taxonomy[r.parent_category][r.subcategory] = r.files
    P.write_json(folder / "taxonomy.json", taxonomy)
    done = "incomplete" if left or media_left else "complete"
    return _done(folder, done, scope=SCOPE, files=written.count(), selected=list(taxonomy), unanswered=left, media_unanswered=media_left, fallback_files=written.filter("used_fallback").count())


@chained("classified", "scanned")
def refine(spark: SparkSession, classified: Path, reports: str, allowed: list[str], works: DataFrame | None = None, media: DataFrame | None = None, threshold: int = grouping.THRESHOLD, scanned: Path | None = None, client: Client | None = None, system: str = "", versions: tuple[str, str] = ("given", "given"), batch_size: int = 30, workers: int = 1, resume: Path | None = None, settings: dict | None = None, budget: dict | None = None) -> Path:
    """Second-level groups of the large refinable parents: by rule, or, for fanworks, by what the model says about the cards of ``scanned``, whose files must be there. Then the model is asked for the works' source media.

    ``works`` (group_id, subcategory) and ``media`` (subcategory, medium) are answers at hand, which are not asked for. Without a client, what is not at hand falls back.
    """
    summary = _complete(classified)
    folder = _begin(reports, resume, {"classified": str(classified), "scan": str(scanned), "threshold": threshold, "model_version": versions[0], "prompt_version": versions[1], "batch_size": batch_size, "scope": SCOPE} | (settings or {}), budget)
    c = _relation(spark, classified, "classifications")
    destinations.must_count(c, summary.get("files"), "the classification")
    if scanned is not None:
        index = _relation(spark, scanned, "index").filter(VALID)
        destinations.must_be_empty(c.join(index.select("relative_path", "card_sha256").distinct(), ["relative_path", "card_sha256"], "left_anti").select("relative_path"), "classified files are missing from the index")
        _index_errors(spark, scanned, folder)
    reasons = [F.nullif(F.col(x), F.lit("")) for x in grouping.REASONS if x in c.columns]
    rows = c.withColumn("parent_category", grouping.parent_category(F.col("model_decision"), F.col("category"), allowed))
    rows = rows.withColumns({"group_id": grouping.group_id(F.col("parent_category"), F.col("card_sha256")), "subcategory": grouping.special_subcategory(F.col("parent_category"), F.col("category"), grouping.reason_text(*reasons))})
    groups = grouping.resolve_groups(rows.filter("subcategory is not null"))
    selected, left, media_left = grouping.selected_parents(rows, threshold=threshold), 0, 0
    if works is None and client is not None and scanned is not None:
        wanted = rows.filter(F.col("parent_category") == grouping.FANWORK).join(F.broadcast(selected.select("parent_category")), "parent_category", "left_semi").select("group_id", "card_sha256").distinct()
        works, left = _ask_works(spark, folder, wanted, scanned, client, system, versions, batch_size, workers)
    if works is not None:
        named = works.select("group_id", F.lit(grouping.FANWORK).alias("parent_category"), grouping.normal_subcategory(F.lit(grouping.FANWORK), F.col("subcategory")).alias("subcategory"))
        groups = groups.unionByName(named.filter("subcategory is not null").withColumn("used_fallback", F.col("subcategory") == grouping.OTHER))
    out = grouping.refine(rows.drop("subcategory"), selected, groups).withColumn("original_category", F.col("category"))
    if media is None and client is not None:
        # Works are settled, written and only then asked about.
        out.write.mode("overwrite").parquet(str(folder / "grouped"))
        out = _relation(spark, folder, "grouped")
        fanworks = out.filter(F.col("selected_for_refinement") & (F.col("parent_category") == grouping.FANWORK))
        media, media_left = _ask_media(spark, folder, fanworks.select("subcategory"), client, system, versions, batch_size, workers)
    out = _with_media(out, media if media is not None else spark.createDataFrame([], "subcategory string, medium string"))
    return _write_refinement(spark, folder, out, left, media_left)


@chained("refined")
def enrich(spark: SparkSession, refined: Path, reports: str, client: Client, system: str = "", versions: tuple[str, str] = ("given", "given"), batch_size: int = 30, workers: int = 1, resume: Path | None = None, settings: dict | None = None, budget: dict | None = None) -> Path:
    """A complete refinement once more, with source media asked for anew; works are not asked about again. ``resume`` as in classify()."""
    summary = _complete(refined)
    if summary.get("scope") != SCOPE:
        raise ValueError("the refinement has another scope")
    folder = _begin(reports, resume, {"refined": str(refined), "model_version": versions[0], "prompt_version": versions[1], "batch_size": batch_size, "scope": SCOPE} | (settings or {}), budget)
    rows = _relation(spark, refined, "refinements").drop("fanwork_source_category", "source_category_source")
    destinations.must_count(rows, summary.get("files"), "the refinement")
    destinations.must_be_empty(destinations.bad_refinements(rows), "the refinement has bad rows")
    fanworks = rows.filter(F.col("parent_category") == grouping.FANWORK)
    media, left = _ask_media(spark, folder, fanworks.select("subcategory"), client, system, versions, batch_size, workers)
    return _write_refinement(spark, folder, _with_media(rows, media), 0, left)


@chained("refined")
def organise_refined(spark: SparkSession, refined: Path, source: str, destination: str, reports: str) -> Path:
    """A plan for the second level. ``source`` holds the files as stage 060 placed them, below their parents and perhaps under names with a hash; files that are not found there are looked for at their old paths."""
    summary = _complete(refined)
    if summary.get("scope") != SCOPE:
        raise ValueError("the refinement has another scope")
    P.require_empty(destination)
    rows = _relation(spark, refined, "refinements")
    destinations.must_count(rows, summary.get("files"), "the refinement")
    destinations.must_be_empty(rows.filter("selected_for_refinement != (subcategory is not null)"), "selection and subcategory do not go together")
    rows = rows.select("relative_path", "file_name", "sha256", "card_sha256", "parent_category", "subcategory", "selected_for_refinement", "refinement_source")
    files = cards.list_files(spark, f"file://{Path(source).resolve()}").select("relative_path", F.sha2("content", 256).alias("sha256"))
    rows = destinations.organised_sources(rows, files).withColumn("source_relative", F.coalesce("source_relative", "relative_path"))
    return _place(spark, rows, [F.col("parent_category"), F.col("subcategory")], source, destination, P.new_batch(reports), "copy", scope=SCOPE)


def _fanwork_index(fanwork: DataFrame, found: DataFrame) -> DataFrame:
    """Every fanwork file with the candidate of its directory, however many directories there are; Spark splits the files of a large one."""
    files = fanwork.select("relative_path", "sha256", "card_sha256", F.col("subcategory").alias("current_directory"), "fanwork_source_category")
    return files.join(found.select("current_directory", "canonical_name", "suggested_target"), "current_directory")


@chained("refined", "organised")
def propose_merges(spark: SparkSession, refined: Path, organised: Path, reports: str) -> Path:
    """Candidates for merging the second-level directories of fanworks, after the refinement and the executed plan were found equal."""
    summary, plan = _complete(refined), _summary(organised)
    if summary.get("scope") != SCOPE or plan.get("scope") != SCOPE:
        raise ValueError("refinement and plan are not of the same scope")
    P.execution_evidence(organised, plan["plan_sha256"], plan["rows"], "copied")
    rows = _relation(spark, refined, "refinements")
    destinations.must_count(rows, summary.get("files"), "the refinement")
    destinations.must_count(rows, plan["rows"], "the plan's refinement")
    destinations.must_be_empty(destinations.repeated_paths(rows), "paths are empty or repeated")
    destinations.must_be_empty(destinations.bad_refinements(rows), "the refinement has bad rows")
    planned = parts.read_parts(spark, organised, "relative_path string, sha256 string, card_sha256 string, parent_category string, subcategory string")
    destinations.must_be_empty(merging.reconcile(rows, planned, "relative_path", ["sha256", "card_sha256", "parent_category", "subcategory"]), "refinement and plan differ")
    folder = P.new_batch(reports)
    fanwork = rows.filter((F.col("parent_category") == grouping.FANWORK) & F.col("subcategory").isNotNull())
    merging.candidates(merging.directory_stats(fanwork, "subcategory", "fanwork_source_category")).write.parquet(str(folder / "candidates"))
    found = _relation(spark, folder, "candidates")
    merging.check_candidates(found)
    digest, n = parts.write_parts(found.withColumn("ordinal", F.struct(-F.col("file_count"), F.expr("current_directory COLLATE zh"))), folder, name="candidates-review")
    # Every file of a fanwork, by path: what is approved are these files, too.
    index = _fanwork_index(fanwork, found)
    index_digest, files = parts.write_parts(index.withColumn("ordinal", F.col("relative_path")), folder, name="fanwork-index")
    bound = {"candidates_sha256": digest, "fanwork_index_sha256": index_digest}
    P.write_approval(folder, **bound, overrides=[])
    return _done(folder, candidates=n, files=files, **bound)


def _overrides(spark: SparkSession, given: list[dict], found: DataFrame) -> DataFrame:
    """(current_directory, approved_target) of an approval's overrides, which a person wrote: each needs a reason, a directory of the candidates that no other names, and a valid target."""
    from ledgerloom.functions.text import directory_name

    rows = spark.createDataFrame([(o.get("current_directory"), o.get("approved_target"), o.get("reason")) for o in given], "current_directory string, approved_target string, reason string")
    rows = rows.select(directory_name(F.col("current_directory")).alias("current_directory"), directory_name(F.col("approved_target")).alias("approved_target"), "reason")
    bad = rows.filter("current_directory is null or approved_target is null or trim(coalesce(reason, '')) = ''")
    unknown = rows.join(found.select("current_directory"), "current_directory", "left_anti")
    repeated = rows.groupBy("current_directory").count().filter("count > 1")
    for problems, what in ((bad, "incomplete"), (unknown, "of unknown directories"), (repeated, "repeated")):
        if wrong := problems.take(3):
            raise P.NotApproved(f"overrides are {what}: {wrong}")
    return rows.select("current_directory", "approved_target")


@chained("proposed", "refined")
def organise_merged(spark: SparkSession, proposed: Path, refined: Path, source: str, destination: str, reports: str) -> Path:
    """A plan of all files with the approved targets; the policy and the totals in the approval must be those of the candidates."""
    approval = json.loads((proposed / "approval.json").read_text(encoding="utf-8"))
    for key, name in (("candidates_sha256", "candidates-review"), ("fanwork_index_sha256", "fanwork-index")):
        if approval.get("approved") is not True or approval.get(key) != parts.root_as_found(spark, proposed, name):
            raise P.NotApproved(f"{name} is not approved as it stands")
    P.require_empty(destination)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _relation(spark, proposed, "candidates").schema)
    found, policy = parts.read_parts(spark, proposed, schema, "candidates-review"), approval["below_minimum_policy"]
    totals = merging.policy_totals(found, policy["recommendation"]).first().asDict()
    if totals != {k: policy[k] for k in totals}:
        raise P.NotApproved(f"the policy's totals are not the candidates': {totals}")
    overrides = _overrides(spark, approval.get("overrides") or [], found)
    approved = merging.approved_targets(found, overrides, policy["recommendation"], policy["approved_target"])
    waiting = approved.filter(F.col("approved_target") == merging.WAITING).agg(F.coalesce(F.sum("file_count"), F.lit(0))).first()[0]
    if waiting != approval["expected_waiting_bucket_file_count"]:
        raise P.NotApproved(f"{waiting} files wait, not {approval['expected_waiting_bucket_file_count']}")
    rows = _relation(spark, refined, "refinements")
    targets = approved.select(F.col("current_directory").alias("__dir"), "approved_target", "approval_source")
    fanwork = (F.col("parent_category") == grouping.FANWORK) & F.col("subcategory").isNotNull()
    rows = rows.join(targets, fanwork & (F.col("subcategory") == F.col("__dir")), "left").drop("__dir")
    destinations.must_be_empty(rows.filter(fanwork != F.col("approved_target").isNotNull()), "a fanwork has no approved target")
    rows = rows.withColumnRenamed("subcategory", "current_directory").select("relative_path", "file_name", "sha256", "card_sha256", "parent_category", "current_directory", "approved_target", "approval_source")
    return _place(spark, rows, [F.col("parent_category"), F.col("approved_target")], source, destination, P.new_batch(reports), "copy", scope=MERGED)


# --- Tags.


def tags_of(parent: str, target: str) -> Column:
    """The tags of an organised file: its parent and, of a fanwork, the target."""
    return F.array_distinct(F.array_compact(F.array(parent, F.when(F.col(parent) == grouping.FANWORK, F.col(target)))))


@chained("organised")
def plan_tags(spark: SparkSession, organised: Path, source: str, destination: str, reports: str, replace: bool = False, unchanged: tuple[str, ...] = ()) -> Path:
    """Which tags each organised file gets, with the hash of what will be written. ``unchanged`` names files, by path, that are copied as they are."""
    P.require_empty(destination)
    organised_plan = _complete(organised)
    if organised_plan.get("scope") != MERGED or organised_plan["destination_root"] != str(Path(source).resolve()):
        raise ValueError("the tags need the plan that gave all files their approved targets, and its destination")
    P.check_approval(spark, organised, effects.approval_of(organised), ("copy",), **_bound(spark, organised))
    P.execution_evidence(organised, organised_plan["plan_sha256"], organised_plan["rows"], "copied")
    folder, root, base = P.new_batch(reports), str(Path(destination).resolve()), str(Path(source).resolve())
    planned = parts.read_parts(spark, organised, "destination_path string, sha256 string, parent_category string, approved_target string")
    rows = planned.select(F.regexp_replace("destination_path", "^" + base.replace(".", r"\.") + "/", "").alias("relative_path"), "sha256", "parent_category", F.col("approved_target").alias("ip_category"), tags_of("parent_category", "approved_target").alias("tags_to_add"))
    rows = rows.withColumn("copy_unchanged", F.col("relative_path").isin(*unchanged) if unchanged else F.lit(False))
    exceptions = spark.createDataFrame([(u,) for u in unchanged], "relative_path string")
    destinations.must_be_empty(exceptions.join(rows, "relative_path", "left_anti"), "an exception names no file")
    preview = effects.tag_previews(rows.withColumn("source_path", F.concat(F.lit(base + "/"), "relative_path")), replace)
    out = rows.join(preview, "relative_path", "left").select(
        F.lit("replace_tags" if replace else "append_tags").alias("operation"), "relative_path", "parent_category", "ip_category", "tags_to_add", "tags_actually_added", "metadata_chunks_updated", "copy_unchanged", F.concat(F.lit(base + "/"), "relative_path").alias("source_path"), F.concat(F.lit(root + "/"), "relative_path").alias("destination_path"), F.col("sha256"), "output_sha256", F.coalesce("status", F.lit("source_invalid")).alias("status"), F.coalesce("detail", F.lit("the source is missing")).alias("detail"), F.col("relative_path").alias("ordinal"),
    )
    out.write.parquet(str(folder / "tags"))  # read for the plan and for its totals
    written = _relation(spark, folder, "tags")
    return _plan(written, folder, "replace_tags" if replace else "append_tags", root, {"scope": TAGGING, "source_root": base, "totals": tag_totals(written).first().asDict()})


def tag_totals(plan: DataFrame) -> DataFrame:
    """added, already_tagged, unchanged, invalid of a tag plan's rows: tags that are added, files that need none, files copied as they are, files that cannot be written."""
    ready, n = F.col("status") == "ready", F.coalesce(F.size("tags_actually_added"), F.lit(0))
    return plan.agg(F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0)).alias("added"), F.count_if(ready & ~F.col("copy_unchanged") & (n == 0)).alias("already_tagged"), F.count_if(ready & F.col("copy_unchanged")).alias("unchanged"), F.count_if(~ready).alias("invalid"))


def execute_tags(spark: SparkSession, plan_folder: Path, approval: Path | None = None) -> dict[str, int]:
    """Write the tagged copies of an approved plan, in tasks; what is written must have the planned hash."""
    return effects.execute(spark, plan_folder, effects.approval_of(plan_folder, approval), ("append_tags", "replace_tags"), effects.write_tags, effects.TAGS, **_bound(spark, plan_folder))


def latest(reports: str, accept: Callable[[Path], bool] = lambda folder: True) -> Path:
    """The newest complete batch below ``reports``."""
    for folder in sorted(Path(reports).iterdir(), reverse=True):
        if (folder / "summary.json").is_file() and _summary(folder)["status"] == "complete" and accept(folder):
            return folder
    raise FileNotFoundError(f"no complete batch in {reports}")


def latest_of(*reports: str) -> Path:
    """The newest complete batch of the first folder that has one: later reviews go before earlier ones."""
    for r in reports:
        try:
            return latest(r)
        except FileNotFoundError:
            continue
    raise FileNotFoundError("no complete batch")
