"""Card files: PNG with embedded JSON, or JSON alone, to typed rows; and tags written back.

Every file gives a row. What cannot be read gets one of the failure statuses.
"""

from __future__ import annotations

import base64
import binascii
import functools
import hashlib
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import canonical_json as cj
from ledgerloom.plans.files import exists, join, listing, opened
from ledgerloom.plans.scratch import written

# File format, field names and versions.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
V1_FIELDS = ("name", "description", "personality", "scenario", "first_mes", "mes_example")
TEXT_FIELDS = (*V1_FIELDS, "creator_notes", "creator", "character_version", "system_prompt", "post_history_instructions")
LIST_FIELDS = ("tags", "alternate_greetings")
CHUNKS = ("ccv3", "chara")
SPECS = {"chara_card_v2": 2, "chara_card_v3": 3}

CARD = (
    "struct<spec_version string, name string, description string, personality string, scenario string, first_mes string, mes_example string, fav boolean, creator_notes string, "
    "system_prompt string, post_history_instructions string, alternate_greetings array<string>, tags array<string>, creator string, character_version string, group_only_greetings array<string>, nickname string, character_book string, extensions string>"
)
CARD_FIELDS = [f.split()[0] for f in CARD.removeprefix("struct<").removesuffix(">").split(", ")]
RECORD = f"relative_path string, file_name string, extension string, size_bytes long, modified_utc string, sha256 string, status string, detail string, metadata_chunk string, version int, card_sha256 string, warnings array<string>, card {CARD}"

#: Files and bytes of a listing's task, about; bytes of content that it gives on at once, about.
FILES, BYTES, SLICE = 2_000, 64 << 20, 4 << 20
_ENTRY = "relative_path string, folder boolean, size_bytes long, modified timestamp"
_ENTRY_TYPES = (pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC"))


class Unreadable(Exception):
    def __init__(self, status: str, detail: str):
        super().__init__(detail)
        self.status = status


def as_text(value: object) -> str:
    """Null as empty; what is no string in ECMAScript's spelling."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, dict):
        return "[object Object]"
    if isinstance(value, list):
        return ",".join(map(as_text, value))
    return cj.dump(value)


def as_list(value: object) -> list[str]:
    if isinstance(value, str):
        return [x for x in (cj.shorten_ends(y) for y in value.split(",")) if x]
    return ["null" if x is None else as_text(x) for x in value] if isinstance(value, list) else []


def version_of(card: object) -> int | None:
    if not isinstance(card, dict):
        return None
    if card.get("spec") in SPECS if isinstance(card.get("spec"), str) else False:
        return SPECS[card["spec"]]
    return 1 if "spec" not in card and all(k in card for k in V1_FIELDS) else None


def data_of(card: dict, version: int) -> dict | None:
    data = card if version == 1 else card.get("data")
    return data if isinstance(data, dict) else None


def extract(card: dict, version: int) -> dict:
    """The typed projection of a payload; ValueError without an object of data."""
    data = data_of(card, version)
    if data is None:
        raise ValueError("the card has no object-valued data")
    notes = data.get("creator_notes")
    if version == 1 and notes is None:
        notes = data.get("creatorcomment")
    notes, many = as_text(notes), data.get("creator_notes_multilingual")
    if version == 3 and isinstance(many, dict):
        notes = next((many[k] for k in ("en", "creator_notes") if isinstance(many.get(k), str)), notes)
    out = {k: as_text(data.get(k)) for k in (*V1_FIELDS, "creator", "character_version")}
    out |= {k: "" if version == 1 else as_text(data.get(k)) for k in ("system_prompt", "post_history_instructions")}
    book, extensions = data.get("character_book"), data.get("extensions")
    return out | {
        "spec_version": f"{version}.0",
        "fav": card["fav"] if isinstance(card.get("fav"), bool) else False,
        "creator_notes": notes,
        "alternate_greetings": as_list(data.get("alternate_greetings")),
        "tags": as_list(data.get("tags")),
        "group_only_greetings": as_list(data.get("group_only_greetings")) if version == 3 else None,
        "nickname": as_text(data.get("nickname")) if version == 3 else None,
        "character_book": None if version == 1 or book is None else cj.dump(book),
        "extensions": cj.dump(extensions) if isinstance(extensions, dict) else None,
    }


def warnings_for(card: dict, version: int) -> list[str]:
    data = data_of(card, version)
    if data is None:
        return ["data is missing or is not an object"]
    lists = (*LIST_FIELDS, *["group_only_greetings"] * (version == 3))
    return [f"{k} is not a string" for k in TEXT_FIELDS if data.get(k) is not None and not isinstance(data[k], str)] + [f"{k} is neither a string nor an array" for k in lists if data.get(k) is not None and not isinstance(data[k], str | list)]


def decode_metadata(text: str) -> object:
    """Base64, padded or not, of UTF-8 JSON."""
    if not re.fullmatch(r"[A-Za-z0-9+/]*={0,2}", text) or len(text) % 4 == 1:
        raise ValueError("invalid Base64")
    bare = text.rstrip("=")
    return cj.load(base64.b64decode(bare[: len(bare) - (len(bare) % 4 == 1)] + "=" * (-len(bare) % 4)).decode("utf-8-sig"))


def chunks(data: bytes) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(start, end, type, body) up to IEND, their checksums verified."""
    if data[:8] != SIGNATURE:
        raise Unreadable("invalid_png", "the PNG signature is missing")
    at = 8
    while at + 12 <= len(data):
        n = struct.unpack_from(">I", data, at)[0]
        end = at + 12 + n
        if end > len(data):
            raise Unreadable("corrupt_png", "a chunk ends past the end of the file")
        if zlib.crc32(data[at + 4 : end - 4]) != struct.unpack_from(">I", data, end - 4)[0]:
            raise Unreadable("corrupt_png", "a chunk fails its CRC")
        yield at, end, data[at + 4 : at + 8], data[at + 8 : end - 4]
        if data[at + 4 : at + 8] == b"IEND":
            return
        at = end
    raise Unreadable("corrupt_png", "there is no IEND chunk")


def _card_chunk(kind: bytes, body: bytes) -> tuple[str, str] | None:
    nul = body.find(b"\0")
    if kind != b"tEXt" or not 0 < nul < len(body) - 1:
        return None
    keyword = body[:nul].decode("latin-1").lower()
    return (keyword, body[nul + 1 :].decode("latin-1")) if keyword in CHUNKS else None


def parse_png(data: bytes) -> tuple[dict, int, str]:
    return card_of((kind, body) for _, _, kind, body in chunks(data))


def card_of(parts: Iterable[tuple[bytes, bytes]]) -> tuple[dict, int, str]:
    """(card, version, keyword) of the first chunk, of (type, body), that decodes to a known version, any ccv3 before any chara."""
    found = [x for kind, body in parts if (x := _card_chunk(kind, body))]
    if not found:
        raise Unreadable("no_card_metadata", "there is no card metadata")
    failure = None
    for keyword, text in sorted(found, key=lambda x: CHUNKS.index(x[0])):
        try:
            card = decode_metadata(text)
        except (ValueError, binascii.Error, RecursionError) as e:
            failure = failure or Unreadable("metadata_decode_failed", str(e))
            continue
        if version := version_of(card):
            return card, version, keyword
        failure = Unreadable("unsupported_card_spec", "the card's version is not known")
    raise failure


def parse_json(data: bytes) -> tuple[dict, int, None]:
    try:
        card = cj.load(data.decode("utf-8-sig"))
    except (ValueError, RecursionError) as e:
        raise Unreadable("json_decode_failed", str(e)) from e
    if not (version := version_of(card)):
        raise Unreadable("unsupported_card_spec", "the card's version is not known")
    return card, version, None


def parse(data: bytes, extension: str) -> tuple[dict, int, str | None]:
    return parse_png(data) if extension.lower() == ".png" else parse_json(data)


def decode(path: str, data: bytes, extension: str) -> dict:
    return decoded(path, lambda: parse(data, extension))


def decoded(path: str, parsed: Callable[[], tuple[dict, int, str | None]]) -> dict:
    """The row of one file. The content hash is there as soon as a card was parsed, even if its data is missing."""
    row = dict.fromkeys(("status", "detail", "metadata_chunk", "version", "card_sha256", "warnings", "card")) | {"relative_path": path}
    try:
        card, version, keyword = parsed()
    except Unreadable as e:
        return row | {"status": e.status, "detail": str(e)}
    row |= {"metadata_chunk": keyword, "version": version, "card_sha256": cj.content_hash(card)}
    try:
        warnings = warnings_for(card, version)
        return row | {"card": extract(card, version), "warnings": warnings, "status": "valid_with_warnings" if warnings else "valid"}
    except ValueError as e:
        return row | {"status": "unsupported_card_spec", "detail": str(e)}


def sha256_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's file sources leave a name out."""
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name and not (folder and name.startswith(("_metadata", "_common_metadata")))


def _inside(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What lies in each of the folders, whose paths are relative to ``root``; empty files and hidden names are left out."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = fs.get_file_info(listing(join(base, folder)))
                for i in range(0, len(found), FILES):
                    rows = [(folder + x.base_name, x.type == pafs.FileType.Directory, x.size or 0, (x.mtime_ns or 0) // 1000) for x in found[i : i + FILES] if x.type == pafs.FileType.Directory or x.type == pafs.FileType.File and x.size]
                    rows = [r for r in rows if not _hidden(r[0].rpartition("/")[2], r[1])]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, _ENTRY_TYPES, strict=True)], names=["relative_path", "folder", "size_bytes", "modified"])

    return entries


def _contents(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows with the content of their files behind them, some at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(root)
        for batch in batches:
            start, held, size = 0, [], 0
            for i, path in enumerate(batch.column("relative_path").to_pylist()):
                with fs.open_input_stream(join(base, path)) as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= SLICE or i == batch.num_rows - 1:
                    own = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(held, pa.binary())], names=[*own.schema.names, "content"])
                    start, held, size = i + 1, [], 0

    return read


def list_names(spark: SparkSession, folder: str) -> DataFrame:
    """relative_path, file_name, extension, size_bytes, modified_utc of all PNG and JSON files below ``folder``, whatever their case.

    Tasks list, a job for each level of folders, and the names are written: the driver sees how many there are. Their content is not read, but
    its size and the number of files deal them to tasks; Spark's own file sources hold all names on the driver, and count each file as 4 MB.
    """
    if not exists(folder):
        raise FileNotFoundError(f"{folder} is not there")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    card = ~F.col("folder") & F.lower("relative_path").rlike(r"\.(png|json)$")
    level, folders, levels, files, size = spark.range(1).select(F.lit("").alias("relative_path")), 1, [], 0, 0
    while folders:
        entries = written(level.repartition(min(folders, partitions), "relative_path").mapInArrow(_inside(folder), _ENTRY), "listed")
        levels.append(entries.filter(card))
        level = entries.filter("folder").select(F.concat("relative_path", F.lit("/")).alias("relative_path"))
        folders, *here = entries.agg(F.count_if("folder"), F.count_if(card), F.coalesce(F.sum(F.when(card, F.col("size_bytes"))), F.lit(0))).first()
        files, size = files + here[0], size + here[1]
    tasks = max(1, min(files, partitions), -(-files // FILES), -(-size // BYTES))
    found = functools.reduce(DataFrame.unionByName, levels).repartition(tasks, "relative_path")
    name, extension = F.element_at(F.split("relative_path", "/"), -1), F.lower(F.regexp_extract("relative_path", r"(\.[^./]+)$", 1))
    return found.select("relative_path", name.alias("file_name"), extension.alias("extension"), "size_bytes", F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("modified_utc"))


def list_paths(spark: SparkSession, folder: str) -> DataFrame:
    """path of all PNG and JSON files below ``folder``, whatever their case; their content is not read."""
    root = opened(folder)[1] if folder.startswith("file:") else folder
    return list_names(spark, folder).select(F.concat(F.lit(root.rstrip("/") + "/"), "relative_path").alias("path"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of list_names() with content, read by the tasks that the names are dealt to."""
    return list_names(spark, folder).mapInArrow(_contents(folder), "relative_path string, file_name string, extension string, size_bytes long, modified_utc string, content binary")


def scan(files: DataFrame) -> DataFrame:
    """File records: the listing's columns without the content, with sha256 and the decoded card. Each file is read once."""
    listed = ["relative_path", "file_name", "extension", "size_bytes", "modified_utc"]
    decoded_columns = ["status", "detail", "metadata_chunk", "version", "card_sha256", "warnings", "card"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [decode(p, c, e) for p, c, e in zip(batch.relative_path, batch.content, batch.extension, strict=True)]
            out = batch[listed].reset_index(drop=True)
            out["sha256"] = [hashlib.sha256(c).hexdigest() for c in batch.content]
            yield out.join(pd.DataFrame(rows, columns=decoded_columns)).astype({"version": "Int32"})

    return files.select(*listed, "content").mapInPandas(run, RECORD)


def counted(index: DataFrame, column: str) -> DataFrame:
    """label, count of a column of file records."""
    return index.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def normal_tag(value: object) -> str:
    return cj.shorten_ends(unicodedata.normalize("NFKC", as_text(value)))


def update_tags(card: dict, version: int, additions: list[str], replace: bool = False) -> list[str]:
    """Change the card's tags in place; the tags added. Original tags stay as they are, unless replaced."""
    data = data_of(card, version)
    if data is None:
        raise ValueError("the card has no object-valued data")
    tags = [] if replace else as_list(data.get("tags"))
    seen, added = {normal_tag(t) for t in tags}, []
    for tag in map(normal_tag, additions):
        if tag and tag not in seen:
            added.append(tag)
            seen.add(tag)
    data["tags"] = tags + added
    return added


def write_tags(data: bytes, extension: str, additions: list[str], replace: bool = False) -> tuple[bytes, list[str], int | None]:
    """(new bytes, tags added, chunks rewritten or None for JSON). In a PNG every decodable card chunk is rewritten; all other bytes stay."""
    if extension.lower() != ".png":
        card, version, _ = parse_json(data)
        added = update_tags(card, version, additions, replace)
        return (cj.dump(card, indent=2) + "\n").encode(), added, None
    primary = parse_png(data)[2]
    out, result, count, end = [data[:8]], None, 0, 8
    for start, end, kind, body in chunks(data):
        piece = data[start:end]
        if found := _card_chunk(kind, body):
            try:
                card = decode_metadata(found[1])
                if version := version_of(card):
                    added = update_tags(card, version, additions, replace)
                    body = body[: body.index(b"\0") + 1] + base64.b64encode(cj.dump(card).encode())
                    piece = struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
                    count += 1
                    if found[0] == primary and result is None:
                        result = added
            except (ValueError, binascii.Error):
                pass  # what cannot be decoded stays
        out.append(piece)
    return b"".join(out) + data[end:], result or [], count


TAGGED = "relative_path string, source_sha256 string, output_sha256 string, tags_actually_added array<string>, metadata_chunks_updated int, status string, detail string, output binary"


def tag_one(path: str, data: bytes, extension: str, sha256: str, additions: list[str], unchanged: bool, replace: bool = False) -> tuple:
    """The row (TAGGED) of one file."""
    actual = hashlib.sha256(data).hexdigest()
    if actual != sha256:
        return path, actual, None, None, None, "source_invalid", "the source's SHA-256 differs from the plan's", None
    if unchanged:
        return path, actual, actual, [], 0, "ready", "copied unchanged", data
    try:
        output, added, count = write_tags(data, extension, list(additions), replace)
    except (Unreadable, ValueError) as e:
        return path, actual, None, None, None, "source_invalid", str(e), None
    return path, actual, hashlib.sha256(output).hexdigest(), added, count, "ready", "", output


def tag_files(files: DataFrame, tags: DataFrame, replace: bool = False) -> DataFrame:
    """Preview of tag writing: ``tags`` has relative_path, sha256, tags_to_add and copy_unchanged for files of a listing. Output bytes are part of the rows; a changed source is ``source_invalid``."""

    def tagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([tag_one(*row, replace) for row in zip(batch.relative_path, batch.content, batch.extension, batch.sha256, batch.tags_to_add, batch.copy_unchanged, strict=True)], columns=[x.split()[0] for x in TAGGED.split(", ")]).astype({"metadata_chunks_updated": "Int32"})

    return files.join(tags.select("relative_path", "sha256", "tags_to_add", "copy_unchanged"), "relative_path").mapInPandas(tagged, TAGGED)
