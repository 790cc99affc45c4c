import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import components, hard_negatives, importance, simhash, words
from ledgerloom.llm.crc_algebra import crcs, joined, shifted
from ledgerloom.llm.gray_index import GrayIndex, gray_rank

# --- Hard negatives.


def brute_negatives(rows):
    one = {}
    for i, vec, label in rows:
        if i is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        q = (label, [math.floor(256 * x) for x in vec])
        one[i] = min(one.get(i, q), q)
    one = {i: ((label + 1) % 10 if i % 7 == 0 else label, q) for i, (label, q) in one.items()}
    out = []
    for a in (i for i in one if i % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(one[a][1], q, strict=False)), i, label) for i, (label, q) in one.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == one[a][0]][:5]:
            fits = [(-t, n) for t, n, label in scored if label != one[a][0] and 50 * -s <= 100 * -t <= 95 * -s]
            out += [(a, p, k + 1, n, -s, t) for k, (t, n) in enumerate(fits[:3])]
    return sorted(out)


def vectors(seed=3, n=400, size=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        scale = rng.choice([0.01, 0.3, 1.0, 5.0])
        rows.append((i, [scale * rng.gauss(0.3, 1) for _ in range(size)], rng.choice([0, 0, 0, 1, 2, 9])))
    hot = [0.5] * size
    rows += [(1000 + i, hot, i % 3) for i in range(150)]  # ties
    rows += [(2000, None, 1), (2050, hot, None), (2100, [1.0, None, 1.0], 1), (2150, [math.nan] * size, 1), (2200, [math.inf] * size, 0), (None, hot, 1), (2250, [], 0), (2300, [0.25, 0.5], 1)]
    return rows + rows[50:52] + [(100, [9.0] * size, 8)]  # repeated rows, and a vec_id with two contents


SCHEMA = "vec_id long, embedding array<float>, label int, q int, windows string"


@pytest.mark.parametrize("block, bucket, least", [(4096, 1024, 256), (3, 16, 8)])
def test_hard_negatives_against_brute_force(spark, block, bucket, least, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    monkeypatch.setattr(hard_negatives, "LEAST_CHUNK", least)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in vectors()]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in hard_negatives.hard_negatives(df).collect())
    assert got == brute_negatives(rows) and len(got) > 50


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1, 1, ""), (50, [1.0], 2, 1, "")], SCHEMA)  # no positives
    assert hard_negatives.hard_negatives(alone).count() == 0


def test_buckets_are_pruned_by_the_bound():
    import pyarrow as pa

    window = [{"tag": 1, "positive": 100, "low": 50, "high": 1000}]
    anchors = pa.RecordBatch.from_pydict({"vec_id": [0], "label": pa.array([0], pa.int32()), "norm2": [100], "q": [[10, 0]], "windows": pa.array([window], pa.list_(pa.struct([(k, pa.int64()) for k in ("tag", "positive", "low", "high")])))})
    search = hard_negatives._Search(anchors, 1, False)
    q = np.array([[9, 0], [8, 0]])
    assert search.bucket(np.array([7, 8]), np.array([1, 1], dtype=np.int32), np.array([81, 64]), q)
    assert search.score.tolist() == [[90]] and search.found.tolist() == [[7]]
    # The running best is 90: a norm of 8.9 cannot reach it, and the window is closed.
    assert not search.bucket(np.array([9]), np.array([1], dtype=np.int32), np.array([79]), np.array([[8, 3]]))
    assert not len(search.live)


def test_large_components_are_exact(spark):
    df = spark.createDataFrame([(0, [30000.0, 1.0], 0, 1, ""), (1, [30000.0, 3.0], 1, 1, ""), (2, [24000.0, 5.0], 2, 1, ""), (3, [24000.0, 6.0], 2, 1, "")], SCHEMA)
    got = [(r.negative_id, r.negative_score) for r in hard_negatives.hard_negatives(df).orderBy("rank").collect()]
    assert got == [(3, 7680000 * 6144000 + 256 * 1536), (2, 7680000 * 6144000 + 256 * 1280)]


# --- SimHash.


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_classes(rows, radius=2):
    code = [plain_fingerprint(t) for _, t in rows]
    parent = {}
    for i in range(len(rows)):
        for j in range(i):
            if (code[i] ^ code[j]).bit_count() <= radius:
                components.union(parent, i, j)
    root = [components.find(parent, i) for i in range(len(rows))]
    least = {r: min((d for (d, _), x in zip(rows, root, strict=True) if x == r and d is not None), default=None) for r in set(root)}
    return [(d, f"{c:016x}", least[r]) for (d, _), c, r in zip(rows, code, root, strict=True)]


def texts(seed=11):
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcdefghij") * rng.randrange(1, 5) + rng.choice(["", "é", "Q"]) for _ in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 40, 400]))]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(rng.choice([" ", "\n", "\t \r\n"]).join(w))
    rows += ["", None, " \n", "one", "Two words", "ONE", "x" * 500, "a b c " * 3000]
    return [(None if i % 31 == 5 else i // 2 if i % 37 == 0 else i + 100, t) for i, t in enumerate(rows)]


def test_simhash_against_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, code int, component_id int").repartition(4)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.similar_documents(df).collect()), key=repr)
    assert got == sorted(brute_classes(rows), key=repr)
    assert len({r[2] for r in got}) < len({r[1] for r in got})


def test_simhash_of_an_empty_table_and_of_null_ids(spark):
    schema = "doc_id long, text string"
    assert simhash.similar_documents(spark.createDataFrame([], schema)).count() == 0
    got = simhash.similar_documents(spark.createDataFrame([(None, "a b c d"), (None, None)], schema)).collect()
    assert [(r.doc_id, r.component_id) for r in got] == [(None, None)] * 2


def test_simhash_on_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = simhash.op12_simhash(spark, small)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == sorted(brute_classes(rows))


def test_codes_in_many_ranges(spark, monkeypatch):
    """Codes around a few centers, over many ranges: links across their borders are found."""
    rng = random.Random(2)
    codes = set()
    for _ in range(8):
        center = rng.getrandbits(64)
        codes |= {center ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(6))}) for _ in range(60)}
    codes |= {rng.getrandbits(64) for _ in range(200)}
    codes = sorted(codes)
    monkeypatch.setattr(simhash, "RANGE", 16)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    ranks = (gray_rank(np.array(codes, dtype=np.uint64)) ^ np.uint64(1 << 63)).view(np.int64).tolist()
    links = simhash.near_codes(spark.createDataFrame([(signed(c), r) for c, r in zip(codes, ranks, strict=True)], "code long, rank long")).collect()
    found, wanted = {}, {}
    for u, v in links:
        components.union(found, u, v)
    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 2:
                components.union(wanted, signed(a), signed(b))
    assert [components.find(found, signed(c)) for c in codes] == [components.find(wanted, signed(c)) for c in codes]
    assert all((u ^ v) & (1 << 64) - 1 for u, v in links)


def test_gray_ranks_and_index():
    sequence = [i ^ i >> 1 for i in range(1000)]  # the Gray sequence itself
    assert gray_rank(np.array(sequence, dtype=np.uint64)).tolist() == list(range(1000))
    rng = np.random.default_rng(4)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300, dtype=np.uint64), np.arange(400, dtype=np.uint64)]))
    codes = codes[np.argsort(gray_rank(codes))]
    index = GrayIndex(codes)
    assert len(index.levels) == 3
    # What the nodes on the way down hold is the code, each bit once.
    assert all((a[1] & np.repeat(b[1], 16)[: len(a[1])]).max() == 0 for a, b in zip(index.levels[1:], index.levels, strict=False))
    for radius in (0, 2, 5):
        q, c = index.search(codes, radius)
        assert sorted(zip(q.tolist(), c.tolist(), strict=True)) == [(i, j) for i in range(len(codes)) for j in range(len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= radius]
    same = np.zeros(len(codes), dtype=np.int64)
    assert not len(index.search(codes, 64, same, same)[0])  # one group: nothing to look for


# --- Importance resampling.


def test_crc_algebra():
    rng = random.Random(8)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 8, 64, 65, 200]))) for _ in range(80)]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    end = np.cumsum([len(p) for p in parts])
    start = end - [len(p) for p in parts]
    one = crcs(data, start, end)
    assert one.tolist() == [zlib.crc32(p) for p in parts]
    both = joined(one[:-1], one[1:], (end - start)[1:])
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    far = shifted(np.array([123], dtype=np.uint32), np.array([100_003]))  # linear: the shift of a sum is the sum of the shifts
    assert far[0] == shifted(np.array([120], dtype=np.uint32), np.array([100_003]))[0] ^ shifted(np.array([3], dtype=np.uint32), np.array([100_003]))[0]


def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def plain_resampling(rows, target):
    words_, buckets = zip(*(plain_features(t) for _, t in rows), strict=True) if rows else ((), ())
    s, t = Counter(b for x in buckets for b in x), Counter(b for x in target for b in plain_features(x)[1])
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for (d, _), n, x in zip(rows, words_, buckets, strict=True):
        weight = sum(map(gain, x)) // len(x) if x else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(x), weight, score, None, n])
    drawn = sorted((x for x in out if x[0] is not None and x[5] >= 20), key=lambda x: (-x[3], x[0]))
    for i, x in enumerate(drawn[: 25 * len(drawn) // 100]):
        x[4] = i + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


@pytest.mark.parametrize("segment", [4 << 20, 50])
def test_resampling_against_plain(spark, segment, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["Der", "naïve", "x1", "zebra-crossing", "ÉTÉ", "a_b", "quantum", "lot", "of", "w" * 90]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 19, 20, 60])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "...;;\x7f"), (None, "the lost words " * 20), (7, rows[7][1]), (503, "a b " * 5000)]
    target = ["quantum lot of lots", None, "été été zebra"]
    if segment < 100:  # in one process, so that the patch holds
        monkeypatch.setattr(words, "SEGMENT", segment)
        monkeypatch.setattr(words, "GROUP", 10)
        from ledgerloom.llm.rolling import column_bytes

        import pyarrow as pa

        data, offsets = column_bytes(pa.array([t for _, t in rows]))
        found = [[] for _ in rows]
        for piece in words.pieces(data, offsets, words.ALPHANUMERIC, 1):
            for r, v in zip(*(x.tolist() for x in importance.features(piece)), strict=True):
                found[piece.first + r].append(v % 10000)
        assert [Counter(f) for f in found] == [Counter(plain_features(t)[1]) for _, t in rows]
        monkeypatch.setattr(simhash, "SHINGLE", 3)
        assert simhash.fingerprints_of(data, offsets)[1].tolist() == [plain_fingerprint(t) for _, t in rows]
        return
    df = spark.createDataFrame([(*r, 1.5, "n") for r in rows], "doc_id long, text string, score double, n string").repartition(5)
    got = importance.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"))
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()), key=repr) == plain_resampling(rows, target)


def test_resampling_of_empty_tables(spark):
    empty, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b"), (2, "lots of words " * 10)], "doc_id long, text string")
    assert importance.resampled(empty, some).count() == 0
    assert sorted((r.doc_id, r.n_features) for r in importance.resampled(some, empty).collect()) == [(1, 3), (2, 59)]


def test_longer_runs_are_composed_too():
    import pyarrow as pa

    from ledgerloom.llm.rolling import column_bytes

    text = "one two three four"
    (piece,) = words.pieces(*column_bytes(pa.array([text])), words.ALPHANUMERIC, 2)
    w = text.split()
    assert sorted(importance.features(piece, 3)[1].tolist()) == sorted(zlib.crc32(" ".join(w[i : i + n]).encode()) for n in (1, 2, 3) for i in range(5 - n))
