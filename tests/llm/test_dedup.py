import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import components as components_module
from ledgerloom.llm import near_dedup, suffix_dedup
from ledgerloom.llm.components import components
from ledgerloom.llm.deep_shallow import BlindTrie, sort_suffixes


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    parent, inverted = {d: d for d in sets}, defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)
    for d, s in sets.items():
        for y, n in Counter(y for x in s for y in inverted[x] if y < d).items():
            if 100 * n >= 75 * (len(s) + len(sets[y]) - n):
                a, b = find(d), find(y)
                parent[max(a, b)] = min(a, b)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def planted(seed=5, n=300):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.choice([3, 5, 30, 200]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(words) // 18)):
            words[rng.randrange(len(words))] = rng.choice(["q", "R", "é"])
        rows.append((i, " ".join(words).upper() if i % 3 else "\n ".join(words)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "x")]


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = planted()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int").repartition(5)
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect())) == brute_components(rows)


def test_near_duplicates_on_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    want = brute_components([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect())) == want
    kept = near_dedup.without_near_duplicates(df)
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, _, k in want if k] and kept.columns == df.columns


def test_op2_sql_against_brute_force():
    import duckdb
    import pandas as pd

    rows = planted()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": [d for d, _ in rows], "text": pd.array([t for _, t in rows], dtype="string")}))
    assert sorted(con.sql(near_dedup.ORACLE_SQL).fetchall()) == brute_components(rows)


def test_near_duplicates_nulls_and_repeats(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(3, text), (3, text), (7, text), (None, text), (9, None)], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(3, 3, 3, True), (3, 3, 3, True), (7, 3, 3, False), (None, 3, None, True), (9, 0, 9, True)], key=repr)
    assert sorted((r.doc_id for r in near_dedup.without_near_duplicates(df).collect()), key=repr) == [3, 9, None]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def naive_super_min_hash(elements, places):
    best = [2**64 - 1] * places
    for e in elements:
        order = list(range(places))
        for j in range(places):
            r = int(near_dedup.mix(np.array([(int(e) + (j + 1) * int(near_dedup._GOLDEN)) % 2**64], dtype=np.uint64))[0])
            k = j + ((r & 0xFFFFFFFF) * (places - j) >> 32)
            order[j], order[k] = order[k], order[j]
            best[order[j]] = min(best[order[j]], (j << 32) | r >> 32)
    return best


def test_super_min_hash_is_the_sequential_one_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 500):
        h = rng.integers(0, 2**63, n).astype(np.uint64)
        assert near_dedup.super_min_hash(np.zeros(n, np.int64), h, 1, 32)[0].tolist() == naive_super_min_hash(h, 32)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    row = np.repeat([0, 1], 700)
    s = near_dedup.super_min_hash(row, np.concatenate((common, a, common, b)), 2)
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.12


def test_long_texts_in_pieces(monkeypatch):
    """Segments and pieces change neither sets nor signatures, and bound what a long text takes."""
    rng = random.Random(8)
    texts = ["", "x" * 300, "a b", " ".join(rng.choice(["word", "É" * 40, "x" * 90, "Y"]) + rng.choice(["", "\n"]) for _ in range(400)), "tail of it " * 9, "z" * 64 + " " + "z" * 65]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    row, h = near_dedup.shingle_sets(data, offsets)
    want = near_dedup.super_min_hash(row, h, len(texts))
    sizes = np.bincount(row, minlength=len(texts))
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    monkeypatch.setattr(near_dedup, "SEGMENT", 64)
    monkeypatch.setattr(near_dedup, "PIECE", 7)
    again = near_dedup.shingle_sets(data, offsets)
    assert np.bincount(again[0], minlength=len(texts)).tolist() == sizes.tolist()
    short = [i for i, t in enumerate(texts) if all(len(w.encode()) <= 64 for w in t.split())]
    assert all(h[row == i].tolist() == again[1][again[0] == i].tolist() for i in short)
    assert (near_dedup.super_min_hash(row, h, len(texts)) == want).all()


def test_one_very_long_text(spark):
    """Eight million bytes are compared like any others."""
    words = [f"w{i * 7919 % 100_003}" for i in range(1_200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-9000])), (3, " ".join(words[:600_000])), (4, "short one of six words here")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: c for d, (_, c) in got.items()} == {1: 1, 2: 1, 3: 1 if len(shingles(rows[2][1])) >= 0.75 * len(shingles(rows[0][1])) else 3, 4: 4}
    assert got[1][0] == len(shingles(rows[0][1]))


@pytest.mark.parametrize("spokes", [1_000_000, 20])
def test_hubs_are_dealt_out(spark, spokes, monkeypatch):
    monkeypatch.setattr(components_module, "SPOKES", spokes)
    edges = [(i, 5) for i in range(6, 200)] + [(500, i) for i in range(200, 300)] + [(500, 5), (900, 901)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long").repartition(6)).collect()}
    assert got == {i: 5 for i in [*range(5, 300), 500]} | {900: 900, 901: 900}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(200), 100 + rng.randrange(200)) for _ in range(150)] + [(7, None), (500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long").repartition(6)).collect()}
    parent = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            parent.setdefault(a, a), parent.setdefault(b, b)
    for _ in range(300):
        for a, b in edges:
            if a in parent and b in parent:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_deep_shallow_sorts():
    rng = np.random.default_rng(1)
    for trial in range(30):
        n = int(rng.integers(60, 2500))
        flat = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        if trial % 2:
            flat[n // 2 :] = flat[: n - n // 2]
        at = np.arange(n - 50)
        first = rng.integers(0, 3, len(at)) if trial % 3 == 0 else None
        order, group = sort_suffixes(flat, at, 50, first)
        keys = [(0 if first is None else int(first[i]), flat[i : i + 50].tobytes()) for i in at]
        ordered = [keys[i] for i in order]
        assert ordered == sorted(keys)
        assert all((ordered[i] == ordered[i - 1]) == (group[i] == group[i - 1]) for i in range(1, len(ordered)))


def test_blind_trie():
    strings = [bytes(x) for x in np.random.default_rng(3).integers(0, 3, (200, 6)).astype(np.uint8)]
    ordered = BlindTrie(strings).in_order()
    assert [strings[g[0]] for g in ordered] == sorted(set(strings)) and sorted(i for g in ordered for i in g) == list(range(200))
    assert all(len({strings[i] for i in g}) == 1 for g in ordered)


def brute_removals(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49) if d is not None else ():
            w = raw[i : i + 50]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        mask = bytearray(len(raw))
        for i in range(len(raw) - 49) if d is not None else ():
            if first[raw[i : i + 50]] < d:
                mask[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, m in zip(raw, mask, strict=True) if not m)
        out.append((d, len(raw), sum(mask), sum(m and (not i or not mask[i - 1]) for i, m in enumerate(mask)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(3)
    own = ["".join(rng.choice("abé d") for _ in range(rng.choice([40, 49, 50, 51, 60, 90, 200]))) for _ in range(30)]
    rows = [(i, "".join(rng.choice(own) + rng.choice(["", "x", "\n"]) for _ in range(rng.randrange(6)))) for i in range(150)]
    return rows + [(None, own[5] * 3), (None, None), (7, None), (8, ""), (500, "$" * 3000), (501, "$" * 2000), (400, "ab" * 700), (401, "ab" * 700), (9, rows[9][1]), (9, rows[9][1]), (3, own[6] + own[7] * 2), (-4, own[6])]


@pytest.mark.parametrize(("hot", "in_batch"), [(20_000, 256), (3, 256), (20_000, 3)])
def test_suffix_dedup_against_brute_force(spark, hot, in_batch, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_IN_BATCH", in_batch)
    monkeypatch.setattr(suffix_dedup, "SORTED_TOGETHER", 50)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.catalog.listTables()
    assert sorted(map(tuple, suffix_dedup.removal_report(df).collect()), key=repr) == brute_removals(rows)
    assert spark.catalog.listTables() == before


def test_suffix_dedup_on_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    want = brute_removals([(r.doc_id, r.text) for r in df.collect()])
    assert sorted(map(tuple, suffix_dedup.removal_report(df).collect()), key=repr) == want


def test_op10_sql_against_brute_force():
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for rows in (passages(), []):
        con.register("documents", pd.DataFrame({"doc_id": pd.array([d for d, _ in rows], dtype="Int64"), "text": pd.array([t for _, t in rows], dtype="string")}))
        assert sorted(con.sql(suffix_dedup.ORACLE_SQL).fetchall(), key=repr) == brute_removals(rows)


def test_long_text_is_cut_into_segments(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 200)
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 5000).astype(np.uint8)
    covered = set()
    for row, start, length, _, _ in suffix_dedup.runs_of(data, np.array([0, 30, 4000, 5000])):
        for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True):
            covered |= {(r, s + i) for i in range(n - 49)}
    assert covered == {(1, i) for i in range(3970 - 49)} | {(2, i) for i in range(1000 - 49)}


def test_places_beyond_32_bits():
    doc, tkey = np.array([5, 4, 5]), np.array([1, 1, 1])
    for big in (0, 1 << 33):
        (batch,) = suffix_dedup._by_document(suffix_dedup.ASK, doc, tkey, np.array([[3], [big + 7], [9]]))
        rows = [{"doc_id": r["doc_id"], "tkey": r["tkey"], "kind": r["kind"], "data": r["data"]} for r in batch.to_pylist()]
        said = {d: sorted(suffix_dedup._numbers([r for r in rows if r["doc_id"] == d], 1, suffix_dedup.ASK).tolist()) for d in (4, 5)}
        assert said == {4: [big + 7], 5: [3, 9]}


def test_without_repeats_keeps_rows_and_columns(spark):
    p = "é" * 40
    df = spark.createDataFrame([(1, p, "a"), (2, "x" + p + "y", "b"), (3, None, "c"), (None, p, "d")], "doc_id long, text string, rank string").selectExpr("rank", "doc_id", "text")
    got = {r.rank: r.text for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {"a": p, "b": "xy", "c": None, "d": p}
    assert suffix_dedup.without_repeats(df).columns == df.columns and suffix_dedup.without_repeats(df.limit(0)).count() == 0
