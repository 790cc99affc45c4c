"""Line-delimited JSON: a repairing, a tolerant and a strict reader; checkpoints; policy documents; batch folders."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import canonical_json as cj

PREFIX = '{"relative_path":'
RECORDS = "start_line long, end_line long, json string, repaired boolean, error string"
_PARSED = pa.schema([("start_line", pa.int64()), ("end_line", pa.int64()), ("json", pa.string()), ("repaired", pa.bool_()), ("error", pa.string())])
#: Bytes of text that a task holds as Python objects at once; a longer record is alone.
SLICE = 4 << 20
_SHORT = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"?', re.DOTALL)


def escape_controls(s: str) -> str:
    """Raw control characters within strings as escapes."""
    escape = lambda m: _SHORT.get(m[0], f"\\u{ord(m[0]):04x}")
    return _STRING.sub(lambda m: re.sub(r"(\\.)|([\x00-\x1f])", lambda c: c[1] or escape(c), m[0], flags=re.DOTALL), s)


def parse_record(raw: str, start: int, end: int, orphan: bool = False) -> tuple:
    """(start_line, end_line, JSON, repaired, error): as it stands, or with control characters escaped."""
    if orphan:
        return start, end, None, False, "content before the first record"
    try:
        cj.load(raw)
        return start, end, raw, False, None
    except (ValueError, RecursionError) as first:
        try:
            cj.load(fixed := escape_controls(raw))
            return start, end, fixed, True, None
        except (ValueError, RecursionError) as second:
            return start, end, None, False, f"{first}; repair failed: {second}"


def slices(batch: pa.RecordBatch, texts: pa.Array, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch``, all of it in order, in pieces of at most ``size`` bytes of ``texts``, or of one row."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def read_repairing(spark: SparkSession, path: str, prefix: str = PREFIX) -> DataFrame:
    """A row for each record of the file or folder: start_line, end_line, json, repaired, error.

    Lines end at LF only. A record begins at a line with ``prefix`` and takes the lines up to the next. The file is split at those beginnings by the reader itself, so records are parsed in parallel; lines are counted by split, and the sums of the splits before are added.
    """
    # A separator of LF and prefix keeps records whole, and U+2028 and lone CR within them.
    rows = spark.read.option("lineSep", "\n" + prefix).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    lines = rows.withColumn("lines", F.length("value") - F.length(F.replace("value", F.lit("\n"))) + 1)
    # A task counts within a split of a file, never over a whole file; the splits before it give the offset.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum("lines").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("file", "block").orderBy("place")
    lines = lines.withColumn("own", F.sum("lines").over(within)).join(splits, ["file", "block"])
    lines = lines.withColumn("after", F.col("own") + F.col("offset")).withColumn("first", F.col("after") == F.col("lines"))

    def records(rows: pa.RecordBatch) -> Iterator[tuple]:
        for value, first, n, after in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            start = after - n + 1
            if first:
                value = value.removeprefix("\ufeff")
                if not value.startswith(prefix):
                    for i, line in enumerate(value.split("\n")):
                        if line.strip():
                            yield parse_record("", start + i, start + i, orphan=True)
                    continue
            else:
                value = prefix + value
            kept = [x.removesuffix("\r") for x in value.split("\n")]
            end = after
            if kept[-1] == "" and len(kept) > 1:  # the LF that ends the file
                kept, end = kept[:-1], after - 1
            yield parse_record("\n".join(kept), start, end)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, batch.column(0)):
                yield pa.RecordBatch.from_pylist([dict(zip(_PARSED.names, r, strict=True)) for r in records(rows)], schema=_PARSED)

    return lines.select("value", "first", "lines", "after").mapInArrow(parsed, RECORDS)


def read_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a log whose last line may be torn; any other bad line fails. A missing file is empty."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], schema)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    lines = lines.filter(F.trim("line") != "").withColumn("good", F.try_parse_json("line").isNotNull() | (F.trim("line") == "null"))
    last = lines.agg(F.max(F.struct("block", "place")).alias("last"), F.max(F.when(~F.col("good"), F.struct("block", "place"))).alias("bad"), F.count_if(~F.col("good")).alias("n")).first()
    if last.n > 1 or last.n == 1 and last.bad != last.last:
        raise ValueError(f"{path}: a line before the last is not JSON")
    return lines.filter("good").select(F.from_json("line", schema).alias("r")).select("r.*")


def read_strict(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Every line must be a record of the schema."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def read_checkpoint(rows: DataFrame, model: str, prompt: str, ordinal: str = "ordinal") -> DataFrame:
    """Of checkpoint rows by the same model and prompt, the last of each content."""
    from ledgerloom.operators.decisions import last_wins

    return last_wins(rows.filter((F.col("model_version") == model) & (F.col("prompt_version") == prompt)), ["card_sha256"], ordinal)


def allowed_categories(document: str, headings: tuple[str, ...] = ("第一优先级", "第二优先级")) -> list[str]:
    """The list items under the priority headings of a policy document, in order, without repeats; an error if there are none."""
    found, inside = [], False
    for line in (unicodedata.normalize("NFKC", x).strip() for x in document.splitlines()):
        if line.startswith("#"):
            inside = line.lstrip("#").strip().startswith(tuple(unicodedata.normalize("NFKC", h) for h in headings))
        elif inside and line and (item := re.sub(r"^(?:[-*+]|\d+[.)、])\s*", "", line).strip()):
            found.append(item)
    if not found:
        raise ValueError("the policy lists no category")
    return list(dict.fromkeys(found))


def latest_artifact(spark: SparkSession, folder: str, name: str, accept: Callable[[str], bool] = lambda batch: True) -> str:
    """The file ``name`` in the newest batch folder, by name, that has it and is accepted."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for batch in sorted((s.getPath().toString() for s in fs.listStatus(base) if s.isDirectory()), reverse=True):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{batch}/{name}")
        if fs.exists(path) and accept(batch):
            return path.toString()
    raise FileNotFoundError(f"{name} in {folder}")


def remap_prefix(path: str, moved: dict[str, str]) -> str:
    """A path below an old root, case aside, as below its new root."""
    for old, new in moved.items():
        low = path.lower()
        if low == old.lower() or low.startswith(old.lower().rstrip("/") + "/"):
            return new.rstrip("/") + path[len(old.rstrip("/")) :]
    return path
