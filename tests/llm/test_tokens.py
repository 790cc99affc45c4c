import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import byte_bpe, packing, token_counts
from ledgerloom.llm.chunk_coder import ChunkCoder, json_coder, rank_coder

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \n b\n", "　x  y \xa0z", "it's 12 3x!!  ...", "\x1c a \x85 b", "x\n\n  y", "\U0001f600 hé  ", "a" * 300 + "  b", "  'll 's", "\t\ta", "q\r\n r", "\x00 \x01"]


@pytest.fixture(scope="module")
def exact():
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    return coder.encode_ordinary


@pytest.fixture(scope="module")
def docs(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None), (None, "no id"), (5, rows[5][1])]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, length string")


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("coder", [byte_bpe.sentencepiece_coder(RANKS), rank_coder(RANKS), json_coder(JSON)], ids=["sentencepiece", "tiktoken", "tokenizers"])
def test_odd_texts(coder, exact):
    assert [ids_of(x) for x in coder.encode(ODD)] == [exact(t) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(" \n\t\xa0ab'sé1!　"), max_size=30))
def test_chunks_join_to_the_whole(exact, text):
    assert ids_of(byte_bpe.sentencepiece_coder(RANKS).encode([text])[0]) == exact(text)
    assert ids_of(json_coder(JSON).encode([text])[0]) == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids if len(text) < 3 else True


def test_cache_limit(exact):
    coder = ChunkCoder(rank_coder(RANKS).encode_chunks, limit=3)
    texts = ["a b c d e f", "f e d c b a", "g" * 100 + " " + "h" * 100]
    assert [ids_of(x) for x in coder.encode(texts)] == [exact(t) for t in texts] and len(coder.tails) <= 3
    assert [i for i, _ in coder.encode_in_steps(texts, 5)] == [0, 1, 2] and list(coder.encode_in_steps([])) == []


def test_model_is_serialised_from_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258}
    model = sentencepiece.SentencePieceProcessor(model_proto=byte_bpe.serialise_model(ranks))
    assert model.get_piece_size() == 260 and [i - 1 for i in model.encode("abcbc")] == [258, 257]
    with pytest.raises(ValueError):
        byte_bpe.serialise_model({b"a": 1})


def test_op7_round_trip(docs, exact):
    rows, df = docs
    want = sorted(((i, len(ids := exact(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)
    assert sorted(map(tuple, byte_bpe.encode_documents(df, RANKS).collect()), key=repr) == want
    assert byte_bpe.decode_ids(RANKS, byte_bpe.encode_text(RANKS, ["héé\U0001f600"])[0]).decode() == "héé\U0001f600"
    assert byte_bpe.encode_documents(df.limit(0), RANKS).count() == 0


def check_packing(rows, pieces, exact, most=1024):
    sequences, documents, ids = defaultdict(list), defaultdict(list), {}
    for i, t in rows:
        ids[i] = [*exact(t or ""), 0]
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(np.array(own[p.start : p.start + p.length], "<u4").tobytes())
        sequences[p.sequence_id].append((p.offset, p.length))
        documents[p.doc_id].append((p.start, p.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= most
    count = defaultdict(int)
    for i, _ in rows:
        count[i] += 1
    for i, spans in documents.items():
        at = 0
        for k, (start, length) in enumerate(sorted(spans)):
            assert start == at
            at += length if k % count[i] == count[i] - 1 else 0
        assert at == len(ids[i])
    assert set(documents) == set(ids)
    return sum(p.length for p in pieces) / most / len(sequences)


@pytest.mark.parametrize("together", [50_000, 3])
def test_op3_every_id_once(docs, exact, together, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", together)
    rows, df = docs
    assert check_packing(rows, packing.pack_documents(df, JSON).collect(), exact) > 0.97
    assert packing.pack_documents(df.limit(0), JSON).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=20))
def test_patterns_use_every_piece(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    used = defaultdict(int)
    for lengths, n in patterns:
        assert sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True) and n > 0
        for x in lengths:
            used[x] += n
    assert used == histogram
    slots = packing.pattern_slots(patterns)
    for x, n in histogram.items():
        spans = sorted(s[1:3] for s in slots if s[0] == x)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_pieces_with_ids_and_bad_lengths(docs):
    p = packing.tokenised_pieces(docs[1], JSON, 16, with_ids=True).first()
    assert zlib.crc32(p.ids) == p.ids_crc32
    with pytest.raises(ValueError):
        packing.shortest_pack_first({5: 1}, 4)


def test_op5_suffix_sums(docs, exact, monkeypatch):
    rows, df = docs
    lengths = [len(exact(t or "")) for _, t in rows]
    for block in (1024, 7):
        monkeypatch.setattr(token_counts, "BLOCK", block)
        sums = token_counts.suffix_sums(token_counts.length_histogram(df, RANKS)).cache()
        got = sums.collect()
        assert sorted(r.n_tokens for r in got) == sorted(set(lengths))
        for r in got:
            n = r.n_tokens
            assert (r.n_docs, r.docs_below, r.docs_from, r.tokens_from) == (lengths.count(n), sum(x < n for x in lengths), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n))
            assert r.truncated_tokens == sum(min(x, n) for x in lengths) and r.total_tokens == sum(lengths)
            assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for limit in (0, 1, 100, 257, 10**6):
        assert token_counts.truncated_total(sums, limit) == sum(min(x, limit) for x in lengths)
    assert token_counts.length_quantile(sums, 0.5) == sorted(lengths)[-(-len(lengths) // 2) - 1]
    assert token_counts.suffix_sums(token_counts.length_histogram(df.limit(0), RANKS)).count() == 0


def test_ranks_file():
    assert base64.b64decode(open(RANKS, "rb").readline().split()[0]) in byte_bpe.read_ranks(RANKS)
