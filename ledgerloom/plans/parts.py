"""Ordered relations as files with hashes: range-sorted parts, a digest of each, and a root over the digests.

Tasks write the parts and hash what they write; the driver sees one line for each part. A changed, missing or
exchanged byte of any part changes the root, which is what a person approves.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.ordering import in_order
from ledgerloom.plans.files import join, opened

#: Rows of a part, about.
ROWS = 500_000


def root_of(parts: list[dict]) -> str:
    """The digest over the parts' digests, in order."""
    return hashlib.sha256("".join(f"{p['sha256']} {p['rows']} {p['name']}\n" for p in parts).encode()).hexdigest()


def _writer(folder: str, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (part, at, line), sorted so, to a file for each part. An attempt writes under a name of its own; what it renames to has the same bytes, whichever comes last."""

    def close(fs, out, temporary: str, part: int, rows: int, size: int, digest) -> pa.RecordBatch:
        out.close()
        final = f"{name}-{part:05d}.jsonl"
        fs.move(temporary, join(temporary.rpartition("/")[0], final))
        return pa.RecordBatch.from_pydict({"part": [part], "name": [final], "rows": [rows], "bytes": [size], "sha256": [digest.hexdigest()]})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        fs.create_dir(base, recursive=True)
        part = None
        for batch in batches:
            for k, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != part:
                    if part is not None:
                        yield close(fs, out, temporary, part, rows, size, digest)
                    part, rows, size, digest = k, 0, 0, hashlib.sha256()
                    temporary = join(base, f".{uuid.uuid4().hex}.part")
                    out = fs.open_output_stream(temporary)
                data = line.encode() + b"\n"
                out.write(data)
                digest.update(data)
                rows, size = rows + 1, size + len(data)
        if part is not None:
            yield close(fs, out, temporary, part, rows, size, digest)

    return write


def write_parts(rows: DataFrame, folder: Path, ordinal: str = "ordinal", name: str = "plan") -> tuple[str, int]:
    """Write ``rows`` without ``ordinal``, in its order, as JSON lines below folder/name, as a table for people, and a manifest; (root, number of rows)."""
    columns = [c for c in rows.columns if c != ordinal]
    n = max(1, -(-rows.count() // ROWS))
    dealt = in_order(rows, [F.col(ordinal)], n, drop=[ordinal])
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    lines = dealt.select(F.col("__part").alias("part"), F.col("__at").alias("at"), line.alias("line"))
    written = lines.repartitionById(n, F.col("part").cast("int")).sortWithinPartitions("part", "at").mapInArrow(_writer(str(folder / name), name), "part long, name string, rows long, bytes long, sha256 string")
    parts = [r.asDict() for r in sorted(written.collect(), key=lambda r: r.part)]
    kinds = dict(rows.dtypes)
    cell = lambda c: F.array_join(c, " | ") if kinds[c].startswith("array") else F.to_json(c) if kinds[c].startswith("struct") else F.col(c).cast("string")
    table = dealt.select("__part", "__at", *(F.coalesce(cell(c), F.lit("")).alias(c) for c in columns)).repartitionById(n, F.col("__part").cast("int")).sortWithinPartitions("__part", "__at")
    table.select(columns).write.option("quoteAll", True).option("escape", '"').option("header", True).csv(str(folder / f"{name}-table"))
    root, total = root_of(parts), sum(p["rows"] for p in parts)
    (folder / f"{name}-manifest.json").write_text(json.dumps({"root": root, "rows": total, "columns": columns, "parts": parts}, indent=1) + "\n", encoding="utf-8")
    return root, total


def manifest(folder: Path, name: str = "plan") -> dict:
    return json.loads((folder / f"{name}-manifest.json").read_text(encoding="utf-8"))


def hashed(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (name, sha256) with actual, the hash of the file of that name below ``folder``, or null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                try:
                    with fs.open_input_stream(join(base, name)) as f:
                        while block := f.read(1 << 20):
                            digest.update(block)
                    found.append(digest.hexdigest())
                except FileNotFoundError:
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["name", "sha256", "actual"])

    return run


def changed_parts(spark: SparkSession, folder: Path, name: str = "plan") -> list[str]:
    """The parts whose bytes are not those of the manifest; every part is hashed, in tasks."""
    parts = manifest(folder, name)["parts"]
    if not parts:
        return []
    rows = spark.createDataFrame([(p["name"], p["sha256"]) for p in parts], "name string, sha256 string").repartition(len(parts))
    actual = rows.mapInArrow(hashed(str(folder / name)), "name string, sha256 string, actual string")
    return sorted(r.name for r in actual.filter("actual is null or actual != sha256").collect())


def root_as_found(spark: SparkSession, folder: Path, name: str = "plan") -> str | None:
    """The root of the parts as they are now; None if any is not what the manifest says."""
    said = manifest(folder, name)
    return None if changed_parts(spark, folder, name) else root_of(said["parts"])


def read_parts(spark: SparkSession, folder: Path, schema: str, name: str = "plan") -> DataFrame:
    """The rows of the parts that the manifest names; other files in the folder are not looked at."""
    parts = manifest(folder, name)["parts"]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").option("lineSep", "\n").json([str(folder / name / p["name"]) for p in parts])
