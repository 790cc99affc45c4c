"""Encode whole texts through a cache of space-led chunks.

The byte-level pattern always breaks before a space that a non-space character
follows, whatever stands before it, so the ids of a text are the ids of the
chunks between such spaces, each led by its space. Chunks repeat, texts do not:
a worker encodes each chunk once and joins bytes from then on.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

from ledgerloom.llm.worker import keep

#: A space that cannot end a chunk: white space or nothing follows it.
_INNER_SPACE = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
#: Longer chunks are encoded but not kept.
_LONGEST_KEPT = 64


class ChunkCoder:
    """``encode_chunks`` maps strings to their ids, each as little-endian unsigned 32-bit integers."""

    def __init__(self, encode_chunks: Callable[[list[str]], list[bytes]], limit: int = 600_000):
        self.encode_chunks, self.limit = encode_chunks, limit
        self.heads: dict[str, bytes] = {"": b""}
        self.tails: dict[str, bytes] = {}

    def _learn(self, known: dict[str, bytes], wanted: set[str], lead: str) -> list[str]:
        """Encode what is missing; return the chunks to forget after this batch."""
        missing = sorted(wanted.difference(known))
        room = self.limit - len(known)
        for chunk, ids in zip(missing, self.encode_chunks([lead + x for x in missing]), strict=True):
            known[chunk] = ids
        short = [x for x in missing if len(x) <= _LONGEST_KEPT]
        return [x for x in missing if len(x) > _LONGEST_KEPT] + short[max(room, 0) :]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [[""] if not t else _CUT.split(t) if _INNER_SPACE.search(t) else t.split(" ") for t in texts]
        heads = self._learn(self.heads, {x[0] for x in split}, "")
        tails = self._learn(self.tails, set().union(*(x[1:] for x in split)), " ")
        first, rest = self.heads, self.tails
        out = [first[x[0]] + b"".join([rest[y] for y in x[1:]]) for x in split]
        for known, extra in ((first, heads), (rest, tails)):
            for x in extra:
                del known[x]
        return out

    def encode_in_steps(self, texts: list[str | None], characters: int = 1_000_000) -> Iterator[tuple[int, bytes]]:
        """(position, ids) for each text, in batches of about this many characters."""
        start, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= characters or i + 1 == len(texts):
                yield from enumerate(self.encode(texts[start : i + 1]), start)
                start, size = i + 1, 0


def _cut_by_bytes(ids: np.ndarray, id_bytes: np.ndarray, lengths: list[int]) -> list[bytes]:
    """Cut the ids of joined chunks at the chunks' byte lengths."""
    ends = np.searchsorted(np.cumsum(id_bytes[ids]), np.cumsum(lengths), side="left") + 1
    raw, out, at = ids.astype("<u4").tobytes(), [], 0
    for n, end in zip(lengths, ends.tolist(), strict=True):
        if n:
            out.append(raw[4 * at : 4 * end])
            at = end
        else:
            out.append(b"")
    return out


def json_coder(path: str) -> ChunkCoder:
    """By the tokenizers library from a byte-level BPE file. A worker keeps its coder."""
    return keep(("tokenizers", path), lambda: _json_coder(path))


def _json_coder(path: str) -> ChunkCoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    id_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
    for token, i in vocabulary.items():
        id_bytes[i] = len(token)  # a byte is one mapped character

    def encode(chunks: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(chunks), 2000):
            some = chunks[start : start + 2000]
            if all(x[:1] == " " for x in some):  # joined, the library need not be called for each
                ids = tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids
                out += _cut_by_bytes(np.array(ids, dtype=np.int64), id_bytes, [len(x.encode()) for x in some])
            else:
                out += [np.array(x.ids, dtype="<u4").tobytes() for x in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return out

    return ChunkCoder(encode)


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def rank_coder(path: str) -> ChunkCoder:
    """By the tiktoken library from a file of ranks. A worker keeps its coder."""
    return keep(("tiktoken", path), lambda: _rank_coder(path))


def _rank_coder(path: str) -> ChunkCoder:
    import public_tokenizers
    import tiktoken

    coder = tiktoken.Encoding(f"ranks of {path}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return ChunkCoder(lambda chunks: [np.array(coder.encode_ordinary(x), dtype="<u4").tobytes() for x in chunks])
