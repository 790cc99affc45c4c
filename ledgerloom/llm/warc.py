"""WARC: a deterministic sharded writer, and its reader.

Records are range-sorted: narrow rows are sorted by page_id, their bytes summed
up, and every ``shard_bytes`` of the sum a shard begins, so that bounds depend
on the rows alone. Payloads then go once, each to the task of its shard. Within
a shard, files roll at a compressed size. Headers, digests, record ids and dates are
made anew from the rows, so that the same rows give the same bytes. A file is
written under a temporary name and renamed when it is whole; the manifest,
written last, names the files that count, so that repeated attempts do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh_path, join_one, materialise, partitions_for, text_of

#: Uncompressed bytes of a shard; in larger tables shards are larger, so that there are ``MAX_SHARDS`` at most, whose bounds the driver and each task hold.
SHARD_BYTES, MAX_SHARDS = 32 << 20, 100_000
#: Compressed bytes at which a file is closed.
ROLL_BYTES = 32 << 20
#: About the bytes of a record beside its payload.
RECORD_BYTES = 600
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of URLs, by RFC 4122
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, shard long, sequence long, records long, bytes long, first_id long, last_id long, sha256 string"


def record_id(page_id: int | None, repeat: int = 0) -> str:
    """The same for the same page in every run; ``repeat`` tells rows with one page_id apart."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}:{repeat}')}>"


def digest32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def format_record(page_id: int | None, repeat: int, url: str | None, payload: bytes, sha1_hex: str, refers: tuple[int | None, str | None] | None) -> bytes:
    """An uncompressed record: response, or revisit of ``refers`` (page_id, url); a revisit's block is the HTTP header alone, with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, repeat)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or 'about:blank').split())}",
        f"WARC-Payload-Digest: sha1:{digest32(sha1_hex)}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers[0])}", f"WARC-Refers-To-Target-URI: {' '.join((refers[1] or 'about:blank').split())}", f"X-Refers-To-Page: {refers[0]}"] if refers else []),
        *([f"X-Page: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(record: bytes, level: int) -> bytes:
    """A gzip member without a time stamp."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


class _Files:
    """Writes the files of a task, one shard after the other."""

    def __init__(self, folder: str, roll_bytes: int):
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.roll_bytes, self.attempt, self.out = roll_bytes, uuid.uuid4().hex, None
        self.shard, self.sequence = None, 0

    def add(self, shard: int, page_id: int | None, member: bytes) -> tuple | None:
        """Write a member; the manifest row of the file that this closes, if any."""
        closed = None
        if shard != self.shard:
            closed = self.close()
            self.shard, self.sequence = shard, 0
        elif self.out is not None and self.size + len(member) > self.roll_bytes:
            closed = self.close()
        if self.out is None:
            # Attempts write side by side; what they rename to is the same, and so are the bytes.
            self.path = f"{self.root}/shard-{shard:013d}-{self.sequence:05d}.warc.gz"
            self.temporary = f"{self.path}.{self.attempt}.open"
            self.fs.create_dir(self.root, recursive=True)
            self.out, self.size, self.records, self.first, self.sha = self.fs.open_output_stream(self.temporary), 0, 0, page_id, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.size, self.records, self.last = self.size + len(member), self.records + 1, page_id
        return closed

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temporary, self.path)
        row = self.path, self.shard, self.sequence, self.records, self.size, self.first, self.last, self.sha.hexdigest()
        self.out, self.sequence = None, self.sequence + 1
        return row


def _verdicts(keys: DataFrame) -> DataFrame:
    """(page_id, sha1, first_id, first_url) of the revisits: of equal payloads, all but the smallest page_id. Null page_ids take no part."""
    named = keys.filter("page_id is not null").select("page_id", "url", "sha1", "size")
    # One row for each payload; of rows with one page_id, the smallest url.
    first = named.groupBy("sha1", "size").agg(F.min(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = join_one(named, materialise(first, "firsts"), ["sha1", "size"], "n")
    return joined.filter("page_id != first.page_id").select("page_id", "sha1", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")).distinct()


def shard_bounds(keys: DataFrame, shard_bytes: int) -> list[int]:
    """The first page_id of each shard, ascending; rows of one page_id stay together.

    The sum of bytes runs within the partitions of a range sort and over their totals, so that the bounds are the same however the rows lie.
    """
    spark = keys.sparkSession
    by_page = keys.filter("page_id is not null").groupBy("page_id").agg(F.sum("weight").alias("weight"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(by_page.repartitionByRange(n, "page_id").withColumn("part", F.spark_partition_id()), "page_sizes")
    totals = ranged.groupBy("part").agg(F.sum("weight").alias("weight")).orderBy("part").collect()  # a row for each partition
    sums = np.cumsum([0, *(t.weight for t in totals)]).tolist()
    before = spark.createDataFrame([(t.part, b) for t, b in zip(totals, sums, strict=False)], "part int, before long")
    running = F.sum("weight").over(Window.partitionBy("part").orderBy("page_id"))
    shard = F.floor((F.col("before") + running - F.col("weight")) / max(shard_bytes, -(-sums[-1] // MAX_SHARDS), 1))
    rows = ranged.join(F.broadcast(before), "part").withColumn("shard", shard)
    return sorted(r.first for r in rows.groupBy("shard").agg(F.min("page_id").alias("first")).collect())


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, level: int = 6) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``folder``, which executors reach by its URI; return the manifest, also written to ``folder``/manifest.

    A null html is an empty payload. Equal payloads, empty ones too, are written once: the record of the smallest page_id is the response, others revisit it. Of rows with the same page_id and payload all but the first revisit the first.
    Rows with a null page_id are responses, dealt out by payload to shards behind the others. A payload that is longer than a shard or a file is written whole. An empty table gives an empty manifest. Other columns are not looked at.
    """
    spark = pages.sparkSession
    html = text_of("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).cast("long").alias("size"))
    keys = materialise(rows.select("page_id", "url", "sha1", "size", (F.col("size") + RECORD_BYTES).alias("weight")), "page_keys")
    bounds = shard_bounds(keys, shard_bytes)
    nameless = keys.filter("page_id is null").agg(F.sum("weight")).first()[0] or 0
    more = min(-(-nameless // shard_bytes), MAX_SHARDS)
    firsts = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def of_page(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, page_id.to_numpy(np.int64), side="right") - 1)

    shard = F.when(F.col("page_id").isNull(), (F.lit(len(bounds)) + F.pmod(F.xxhash64("sha1"), F.lit(max(more, 1)))).cast("int")).otherwise(of_page(F.coalesce("page_id", F.lit(0).cast("long"))))
    # Verdicts travel with the pages and stand before them, so that payloads are shuffled once.
    nothing = {"url": F.lit(None).cast("string"), "html": F.lit(None).cast("string"), "size": F.lit(0).cast("long")}
    both = rows.withColumns({"first_id": F.lit(None).cast("long"), "first_url": F.lit(None).cast("string"), "kind": F.lit(1)}).unionByName(_verdicts(keys).withColumns(nothing | {"kind": F.lit(0)}))
    both = both.withColumn("shard", shard)
    both = both.repartitionById(max(len(bounds) + more, 1), "shard").sortWithinPartitions("shard", "page_id", "sha1", "kind", "url")
    ordered = both.select(F.col("shard").cast("long").alias("shard"), "page_id", "sha1", "kind", "first_id", "first_url", "url", "html")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, verdict, last, repeat = _Files(folder, roll_bytes), None, None, 0
        for batch in batches:
            done = []
            for shard, page_id, sha1, kind, first_id, first_url, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    verdict = page_id, sha1, first_id, first_url
                    continue
                # The n-th row of a page_id; of the same payload, the first one's url.
                if page_id is None or last is None or last[0] != page_id:
                    repeat = 0
                else:
                    repeat += 1
                refers = verdict[2:] if verdict and verdict[:2] == (page_id, sha1) else (page_id, last[2]) if page_id is not None and last and last[:2] == (page_id, sha1) else None
                closed = files.add(shard, page_id, _member(format_record(page_id, repeat, url, html.encode(), sha1, refers), level))
                done += [closed] * (closed is not None)
                last = page_id, sha1, last[2] if last and last[:2] == (page_id, sha1) else url
            if done:
                yield manifest(done)
        if closed := files.close():
            yield manifest([closed])

    def manifest(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with names in lower case, block) of each member of a gzipped WARC file, read piece by piece."""
    inflate, buffer, pending = zlib.decompressobj(31), bytearray(), b""
    while True:
        pending = pending or stream.read(1 << 20)
        if not pending:
            if buffer:
                raise ValueError("a WARC file ends within a record")
            return
        buffer += inflate.decompress(pending)
        pending = inflate.unused_data
        if not inflate.eof:
            pending = b""
            continue
        inflate = zlib.decompressobj(31)
        head, _, rest = bytes(buffer).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        n = int(headers["content-length"])
        if not version.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
            raise ValueError("not a WARC record")
        yield headers, rest[:n]
        buffer.clear()


def read_archives(spark, manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record of the manifest's files, and payload (null for a revisit) with ``with_payload``.

    Digests of blocks, and payloads of responses, are checked; a file that does not match them fails the read.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 6 + with_payload]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for headers, block in parse_records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:")).split()[1])
                        sha1 = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
                        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                        if sha1(block) != headers["warc-block-digest"].removeprefix("sha1:") or kind == "response" and (len(payload) != size or sha1(payload) != digest):
                            raise ValueError(f"{path}: a digest does not match")
                        page, refers = headers.get("x-page"), headers.get("x-refers-to-page")
                        rows.append((page and int(page), headers["warc-target-uri"], size, digest, kind, refers and int(refers), payload if kind == "response" else None)[: len(kinds)])
                        held += len(payload) * with_payload + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    names = [x.split()[0] for x in schema.split(", ")] + ["payload"] * with_payload
    n = partitions_for(spark, manifest.agg(F.sum("bytes")).first()[0] or 0, 32 << 20)
    return manifest.select("path").repartition(n, "path").mapInArrow(read, schema + ", payload binary" * with_payload)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(spark, manifest, folder).drop("url")


#: Of five hexadecimal digits, four of base 32; rows of one page_id count as one page of several records, the first by payload and url.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT html, min(page_id) AS first_id FROM p WHERE page_id IS NOT NULL GROUP BY html
), numbered AS (
  SELECT p.*, first_id, row_number() OVER (PARTITION BY p.page_id, p.html) AS n FROM p LEFT JOIN firsts f ON f.html = p.html
)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT NULL AND (first_id <> page_id OR n > 1) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS NOT NULL AND (first_id <> page_id OR n > 1) THEN first_id END AS refers_to
FROM numbered
"""
