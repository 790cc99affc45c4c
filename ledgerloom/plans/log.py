"""A log of JSON lines that survives its writer: sealed segments, and an open one whose last line may be torn.

What goes on with a log first cuts the torn line off, so that nothing is ever
written behind it: the valid prefix is written anew and put in place of the
segment. Full segments are sealed by a rename. Compaction keeps the last record
of each key of the sealed segments in a table, and names it in the log's head,
which is replaced whole; what is not named there any more is removed after that.
"""

from __future__ import annotations

import io
import json
import threading
import uuid
from collections.abc import Iterable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.decisions import last_wins
from ledgerloom.plans.files import join, listing, opened
from ledgerloom.sources.jsonl import read_strict, read_tolerant

#: Bytes of a segment after which it is sealed.
SEGMENT = 64 << 20
BLOCK = 1 << 20


def _good(line: bytes) -> bool:
    try:
        json.loads(line)
    except ValueError:
        return False
    return True


class CheckpointLog:
    """The log ``name`` in ``folder`` (a path or URI). Opening it for writing mends its tail; one writer at a time, of any number of threads."""

    def __init__(self, folder: object, name: str, segment: int = SEGMENT):
        self.place, self.name, self.segment = str(folder), name, segment
        self.fs, self.base = opened(self.place)
        self.lock, self.out, self.size = threading.Lock(), None, 0

    # --- What there is.

    def _path(self, name: str) -> str:
        return join(self.base, name)

    def _head(self) -> dict:
        """{base, from, ordinal}: the compacted table, the first segment behind it, and the last ordinal in it."""
        try:
            with self.fs.open_input_stream(self._path(f"{self.name}-head.json")) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return {"base": None, "from": 0, "ordinal": 0}

    def sealed(self) -> list[str]:
        """The sealed segments that count, in order."""
        found = self.fs.get_file_info(listing(self.base))
        numbers = sorted(int(x.base_name[len(self.name) + 1 : -6]) for x in found if x.base_name.startswith(f"{self.name}-") and x.base_name.endswith(".jsonl") and x.base_name[len(self.name) + 1 : -6].isdigit())
        return [self._segment(n) for n in numbers if n >= self._head()["from"]]

    def _segment(self, n: int) -> str:
        return f"{self.name}-{n:08d}.jsonl"

    def records(self) -> Iterator[dict]:
        """The records behind the compacted table, one after the other; a torn last line is left out, any other bad line fails."""
        bad = None
        for name in [*self.sealed(), f"{self.name}.jsonl"]:
            try:
                f = io.BufferedReader(self.fs.open_input_stream(self._path(name)))
            except FileNotFoundError:
                continue
            with f:
                for line in f:
                    if bad is not None and line.strip():
                        raise ValueError(f"{bad}: a line before the last is not JSON")
                    if _good(line):
                        yield json.loads(line)
                    elif line.strip():
                        bad = name

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """All records of the schema; compacted keys have one."""
        rows = read_tolerant(spark, join(self.place, f"{self.name}.jsonl"), schema)
        if sealed := self.sealed():
            rows = rows.unionByName(read_strict(spark, [join(self.place, s) for s in sealed], schema))
        base = self._head()["base"]
        return rows if base is None else rows.unionByName(spark.read.schema(schema).parquet(join(self.place, base)))

    # --- Going on.

    def _tail(self, name: str) -> tuple[int, bytes]:
        """(where the last line that is not blank begins, that line); (0, b"") of an empty segment."""
        with self.fs.open_input_file(self._path(name)) as f:
            end, held = f.size(), b""
            while end:
                begin = max(0, end - BLOCK)
                f.seek(begin)
                held = f.read(end - begin) + held
                text = held.rstrip(b" \t\r\n")
                if text and (cut := text.rfind(b"\n")) >= 0:
                    return begin + cut + 1, text[cut + 1 :]
                if text and not begin:
                    return 0, text
                end = begin
        return 0, b""

    def mend(self) -> int:
        """Make the open segment end in a whole line; the number of bytes that went."""
        name = f"{self.name}.jsonl"
        info = self.fs.get_file_info(self._path(name))
        if info.type == pafs.FileType.NotFound or not info.size:
            return 0
        begin, line = self._tail(name)
        good = bool(line) and _good(line)
        keep = begin + len(line) if good else begin
        with self.fs.open_input_file(self._path(name)) as f:
            f.seek(info.size - 1)
            if good and f.read(1) == b"\n":
                return 0
            temporary = self._path(f".{name}.{uuid.uuid4().hex}")
            f.seek(0)
            with self.fs.open_output_stream(temporary) as out:
                left = keep
                while left:
                    block = f.read(min(BLOCK, left))
                    out.write(block)
                    left -= len(block)
                if good:
                    out.write(b"\n")
        self.fs.move(temporary, self._path(name))
        return info.size - keep

    def _last_ordinal(self) -> int:
        for name in (f"{self.name}.jsonl", *reversed(self.sealed())):
            if self.fs.get_file_info(self._path(name)).type != pafs.FileType.NotFound and (line := self._tail(name)[1]):
                return int(json.loads(line).get("ordinal") or 0)
        return self._head()["ordinal"]

    def append(self, records: Iterable[dict]) -> None:
        """Write the records, each with the next ordinal, before this returns."""
        with self.lock:
            if self.out is None:
                self.fs.create_dir(self.base, recursive=True)
                self.mend()
                self.ordinal = self._last_ordinal()
                self._open()
            lines = []
            for r in records:
                self.ordinal += 1
                lines.append(json.dumps(r | {"ordinal": self.ordinal}, ensure_ascii=False).encode() + b"\n")
            data = b"".join(lines)
            self.out.write(data)
            self.out.flush()
            self.size += len(data)
            if self.size >= self.segment:
                self._seal()

    def _open(self) -> None:
        path = self._path(f"{self.name}.jsonl")
        info = self.fs.get_file_info(path)
        self.size = info.size or 0
        self.out = self.fs.open_append_stream(path)

    def _seal(self) -> None:
        self.out.close()
        last = self.sealed()
        n = int(last[-1][len(self.name) + 1 : -6]) + 1 if last else self._head()["from"]
        self.fs.move(self._path(f"{self.name}.jsonl"), self._path(self._segment(n)))
        self._open()

    def close(self) -> None:
        with self.lock:
            if self.out is not None:
                self.out.close()
                self.out = None

    def compact(self, spark: SparkSession, schema: str, keys: list[str]) -> None:
        """Keep of the sealed segments, and of what was compacted before, the last record of each key. Readers see the log before or after it, never between."""
        sealed, head = self.sealed(), self._head()
        if not sealed:
            return
        rows = read_strict(spark, [join(self.place, s) for s in sealed], schema)
        if head["base"] is not None:
            rows = rows.unionByName(spark.read.schema(schema).parquet(join(self.place, head["base"])))
        base = f"{self.name}-base-{uuid.uuid4().hex}"
        last_wins(rows, keys).write.parquet(join(self.place, base))
        new = {"base": base, "from": int(sealed[-1][len(self.name) + 1 : -6]) + 1, "ordinal": int(json.loads(self._tail(sealed[-1])[1])["ordinal"])}
        temporary = self._path(f".{self.name}-head.{uuid.uuid4().hex}")
        with self.fs.open_output_stream(temporary) as out:
            out.write(json.dumps(new).encode())
        self.fs.move(temporary, self._path(f"{self.name}-head.json"))
        for s in sealed:
            self.fs.delete_file(self._path(s))
        if head["base"] is not None:
            self.fs.delete_dir(self._path(head["base"]))
