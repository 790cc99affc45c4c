"""Card files as a Spark data source.

``spark.read.format("card_files").load(folder)`` gives the rows of a scan. With
option("verify", "cards") a PNG is read by ranges: chunk headers, and the chunks that
can hold a card; image data is stepped over, and neither it nor the file is
hashed. Without it every byte is read once, checked and hashed.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerloom.plans.files import listing, opened
from ledgerloom.sources import cards

FIELDS = [f.split()[0] for f in cards.RECORD.split(", card struct")[0].split(", ")] + ["card", "bytes_read"]
#: Bytes and files of a partition at most; a larger file is alone.
PARTITION_BYTES, PARTITION_FILES = 64 << 20, 5_000
SUFFIXES = (".png", ".json")


class _Counted:
    """A file that counts what is read of it."""

    def __init__(self, f: object, size: int):
        self.f, self.size, self.at, self.read_bytes = f, size, 0, 0

    def take(self, n: int) -> bytes:
        data = self.f.read(n)
        self.at, self.read_bytes = self.at + len(data), self.read_bytes + len(data)
        return data

    def step(self, n: int) -> None:
        self.at += n
        self.f.seek(self.at)


def card_chunks(f: _Counted) -> Iterator[tuple[bytes, bytes]]:
    """(type, body) of the text chunks up to IEND, their checksums verified; all others are stepped over."""
    if f.take(8) != cards.SIGNATURE:
        raise cards.Unreadable("invalid_png", "the PNG signature is missing")
    while f.at + 12 <= f.size:
        head = f.take(8)
        n, kind = struct.unpack(">I", head[:4])[0], head[4:]
        if f.at + n + 4 > f.size:
            raise cards.Unreadable("corrupt_png", "a chunk ends past the end of the file")
        if kind in (b"tEXt", b"IEND"):
            body = f.take(n)
            if zlib.crc32(kind + body) != struct.unpack(">I", f.take(4))[0]:
                raise cards.Unreadable("corrupt_png", "a chunk fails its CRC")
            if kind == b"IEND":
                return
            yield kind, body
        else:
            f.step(n + 4)
    raise cards.Unreadable("corrupt_png", "there is no IEND chunk")


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, str, int, str]]):
        self.files = files


class CardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.place, self.verify = options["path"], options.get("verify", "all")
        if self.verify not in ("all", "cards"):
            raise ValueError("verify is all or cards")

    def partitions(self) -> list[InputPartition]:
        """Names and sizes only; links are left out."""
        fs, base = opened(self.place)
        out, held, size = [], [], 0
        selector = listing(base)
        selector.recursive = True
        for info in fs.get_file_info(selector):
            if info.type != pafs.FileType.File or not info.base_name.lower().endswith(SUFFIXES) or isinstance(fs, pafs.LocalFileSystem) and os.path.islink(info.path):
                continue
            if held and (size + info.size > PARTITION_BYTES or len(held) == PARTITION_FILES):
                out.append(_Files(held))
                held, size = [], 0
            modified = datetime.fromtimestamp((info.mtime_ns or 0) / 1e9, UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
            held.append((info.path, info.path[len(base.rstrip("/")) + 1 :], info.size, modified))
            size += info.size
        return out + [_Files(held)] * bool(held)

    def read(self, partition: _Files) -> Iterator[tuple]:
        fs = opened(self.place)[0]
        for path, relative, size, modified in partition.files:
            name = relative.rpartition("/")[2]
            extension = "." + name.rpartition(".")[2].lower()
            with fs.open_input_file(path) as f:
                own = _Counted(f, size)
                if self.verify == "cards" and extension == ".png":
                    row, digest = cards.decoded(relative, lambda own=own: cards.card_of(card_chunks(own))), None
                else:
                    data = own.take(size)
                    row, digest = cards.decode(relative, data, extension), hashlib.sha256(data).hexdigest()
            card = row["card"]
            row |= {"file_name": name, "extension": extension, "size_bytes": size, "modified_utc": modified, "sha256": digest, "bytes_read": own.read_bytes, "card": card and tuple(card[k] for k in cards.CARD_FIELDS)}
            yield tuple(row[k] for k in FIELDS)


class CardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "card_files"

    def schema(self) -> str:
        return cards.RECORD + ", bytes_read long"

    def reader(self, schema: object) -> DataSourceReader:
        return CardReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CardSource)
