"""Approved plans, executed in tasks.

1. Which destinations exist already is written down before anything is made. What
   stands there later with the planned hash was then made by an earlier attempt
   of this execution, so that tasks may be repeated, run twice or be lost.
2. Each task makes its files (plans/files.py) and gives a row for each; the log is
   the table of these rows, so that it has one for each planned file, whatever
   the number of attempts.

An execution that was interrupted goes on from what it wrote down.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans import files, parts
from ledgerloom.plans import plan as P
from ledgerloom.sources import cards

LOG = "executed_utc string, operation string, source_path string, destination_path string, sha256 string, result string, detail string"
COPY = "source_path string, destination_path string, sha256 string, status string"
TAGS = COPY + ", output_sha256 string, tags_to_add array<string>, copy_unchanged boolean"
#: Files of a task.
FILES = 2_000

#: Makes one file: (row, approval, staging) to the result.
Act = Callable[[dict, dict, str], str]


def copy(row: dict, approval: dict, staging: str) -> str:
    """Copy, or move, a file that still has the planned hash."""
    source, target, sha256 = row["source_path"], row["destination_path"], row["sha256"]
    move = approval["operation"] == "move"

    def write(out: object) -> None:
        if files.copied_to(source, out) != sha256:
            raise ValueError("the source has changed")

    made_before = files.hash_of(target) == sha256
    if not made_before or not move:
        if files.hash_of(source) != sha256:
            raise ValueError("the source has changed")
        files.make(target, staging, sha256, write)
    if not move:
        return "copied"
    try:
        if files.exists(source):
            files.remove(source)
        return "moved"
    except OSError:
        return "copied_source_delete_failed"


def write_tags(row: dict, approval: dict, staging: str) -> str:
    """Write a tagged copy of a file, or, of an exception, the file as it is."""
    fs, path = files.opened(row["source_path"])
    with fs.open_input_stream(path) as f:
        data = f.read()
    if cards.sha256_of(data) != row["sha256"]:
        raise ValueError("the source has changed")
    output = data if row["copy_unchanged"] else cards.write_tags(data, Path(row["destination_path"]).suffix, list(row["tags_to_add"]), approval["operation"] == "replace_tags")[0]
    files.make(row["destination_path"], staging, row["output_sha256"], lambda out: out.write(output))
    return "unchanged_copy_written" if row["copy_unchanged"] else "tagged_copy_written"


def _looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(existed=[files.exists(p) for p in batch["destination_path"]])


def _done(act: Act, approval: dict, staging: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def one(row: dict) -> tuple[str, str]:
        try:
            if row["existed"]:
                raise FileExistsError("the destination existed")
            if not row["destination_path"].startswith("/") and "://" not in row["destination_path"] or not P.is_inside(row["destination_path"], approval["destination_root"], strictly=True):
                raise ValueError("the destination is outside its root")
            return act(row, approval, staging), ""
        except (OSError, ValueError, cards.Unreadable) as e:
            return "failed", str(e)

    def done(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                result, detail = one(row)
                out.append((datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z", approval["operation"], row["source_path"], row["destination_path"], row["sha256"], result, detail))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in LOG.split(", ")])

    return done


def looked_up(rows: DataFrame) -> DataFrame:
    """``rows`` with existed: whether the destination is there. Write it before anything is made."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(_looked_up, kinds + ", existed boolean")


def made(rows: DataFrame, approval: dict, staging: str, act: Act = copy) -> DataFrame:
    """The log (LOG) of making each of ``rows``, which looked_up() gave; write it once. A row that fails stops no other. The files are dealt to tasks by their names."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // FILES))
    return rows.repartition(tasks, "destination_path").mapInPandas(_done(act, approval, staging), LOG)


PREVIEW = ", ".join(c for c in cards.TAGGED.split(", ") if c != "output binary")


def tag_previews(rows: DataFrame, replace: bool = False) -> DataFrame:
    """What tagging would give (PREVIEW) for ``rows`` (relative_path, source_path, sha256, tags_to_add, copy_unchanged); files are read one by one where their rows are, so that no task holds several."""

    def one(r: dict) -> tuple:
        try:
            fs, path = files.opened(r["source_path"])
            with fs.open_input_stream(path) as f:
                data = f.read()
        except FileNotFoundError:
            return r["relative_path"], None, None, None, None, "source_invalid", "the source is missing"
        return cards.tag_one(r["relative_path"], data, Path(r["source_path"]).suffix, r["sha256"], list(r["tags_to_add"]), r["copy_unchanged"], replace)[:-1]

    def previews(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(r) for r in batch.to_dict("records")], columns=[c.split()[0] for c in PREVIEW.split(", ")]).astype({"metadata_chunks_updated": "Int32"})

    asked = rows.select("relative_path", "source_path", "sha256", "tags_to_add", "copy_unchanged")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // FILES))
    return asked.repartition(tasks, "relative_path").mapInPandas(previews, PREVIEW)


def complete(table: Path) -> bool:
    """Whether Spark has committed the table."""
    return (table / "_SUCCESS").exists()


def log_of(spark: SparkSession, folder: Path) -> DataFrame:
    """The rows of an execution."""
    return spark.read.schema(LOG).json(str(folder / "execution"))


def counts_of(log: DataFrame) -> DataFrame:
    """result, files of an execution's log."""
    return log.groupBy("result").agg(F.count(F.lit(1)).alias("files"))


def execute(spark: SparkSession, folder: Path, approval: dict, operations: tuple[str, ...] = ("copy", "move"), act: Act = copy, schema: str = COPY, **bound: object) -> dict[str, int]:
    """Do what the plan in ``folder`` says, if it is approved as it stands; counts by result. A failed row does not stop the others and leaves no part of a file."""
    P.check_approval(spark, folder, approval, operations, **bound)
    log = folder / "execution"
    if complete(log):
        raise FileExistsError(f"{folder} was executed already")
    before = folder / "before-execution"
    if not complete(before):
        planned = parts.read_parts(spark, folder, schema).filter(F.col("status").isin("planned", "ready")).drop("status")
        looked_up(planned).write.mode("overwrite").parquet(str(before))
    rows = spark.read.parquet(str(before))
    staging = files.join(approval["destination_root"], f".{folder.name}")
    try:
        made(rows, approval, staging, act).write.mode("overwrite").json(str(log))
    finally:
        files.remove_folder(staging)
    counts = {r.result: r.files for r in counts_of(log_of(spark, folder)).collect()}
    P.write_json(folder / "execution-summary.json", {"plan_sha256": approval["plan_sha256"], "operation": approval["operation"], "results": counts})
    return counts


def approval_of(folder: Path, given: Path | None = None) -> dict:
    return json.loads((given or folder / "approval.json").read_text(encoding="utf-8"))
