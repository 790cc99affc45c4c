"""Byte-level BPE by a sentencepiece model that is serialised from the vocabulary.

Each byte is written as one printable character; a token of rank r becomes a
piece with score -r, so the best-scored merge is the merge of lowest rank. The
model file is put together field by field: it is never trained.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chunk_coder import ChunkCoder, read_ranks
from ledgerloom.llm.worker import keep


@lru_cache(maxsize=1)
def byte_characters() -> str:
    """Position b holds the character for byte b: printable Latin-1 stands for itself, the others take code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(others)) for b in range(256))


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A BPE ModelProto: piece 0 is the unknown piece, piece r + 1 the token of rank r."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    characters = byte_characters()
    piece = lambda text, score, kind: _bytes(1, _bytes(1, text.encode()) + struct.pack("<Bf", 2 << 3 | 5, score) + _number(3, kind))
    pieces = [piece("<unk>", 0.0, 2)]
    pieces += [piece("".join(map(characters.__getitem__, token)), -float(rank), 1) for token, rank in sorted(ranks.items(), key=lambda x: x[1])]
    # model_type BPE, vocab_size, unk_id, and no id for beginning, end and padding.
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, 0) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    # Identity: no prefix, no white space removed or escaped.
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


def sentencepiece_coder(path: str) -> ChunkCoder:
    """By a serialised sentencepiece model. A worker keeps its coder."""
    return keep(("sentencepiece", path), lambda: _sentencepiece_coder(path))


def _sentencepiece_coder(path: str) -> ChunkCoder:
    import public_tokenizers
    import regex
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(read_ranks(path)))
    find, table = regex.compile(public_tokenizers.PATTERN).findall, {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}

    def encode(chunks: list[str]) -> list[bytes]:
        """Each match of the pattern is encoded by itself."""
        matches = [find(x) for x in chunks]
        mapped = [y.encode().decode("latin-1").translate(table) for x in matches for y in x]
        coded = iter(model.encode(mapped, num_threads=1) if mapped else [])
        out = []
        for x in matches:
            ids = [i for _ in x for i in next(coded)]
            out.append((np.array(ids, dtype=np.int64) - 1).astype("<u4").tobytes())
        return out

    return ChunkCoder(encode)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    return sorted(ranks := read_ranks(path), key=ranks.__getitem__)


def encode_text(path: str, texts: list[str | None]) -> list[list[int]]:
    return [np.frombuffer(x, dtype="<u4").tolist() for x in sentencepiece_coder(path).encode(texts)]


def decode_ids(path: str, ids: list[int]) -> bytes:
    """The inverse mapping: bytes, as ids may end within a character."""
    return b"".join(map(token_bytes(path).__getitem__, ids))


def encode_documents(docs: DataFrame, ranks_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids as binary with ``with_ids``) of every row of (doc_id, text).

    A null text counts as empty: no ids, digests of nothing. Repeated rows and null doc_ids are kept; other columns are ignored. An empty table gives no rows; texts of any length are encoded whole.
    """
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sentencepiece_coder(ranks_path)
        for batch in batches:
            n, hashes, decoded, kept = [], [], [], []
            for _, ids in coder.encode_in_steps(batch.column(1).to_pylist()):
                n.append(len(ids) // 4)
                hashes.append(digest(ids))
                decoded.append(digest(decode_ids(ranks_path, np.frombuffer(ids, dtype="<u4").tolist())))
                kept += [ids] * with_ids
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string()), *[pa.array(kept, pa.binary())] * with_ids]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + with_ids])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
