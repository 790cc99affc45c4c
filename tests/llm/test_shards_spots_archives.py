import base64
import gzip
import hashlib
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import sharding, spot_signatures, warc
from ledgerloom.llm.common import fresh_path


def check_shards(rows, got, shards=8):
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    for v in by_shard.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
    assert set(by_shard) <= set(range(shards)) and {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    return [sum(r.size for r in by_shard[s]) for s in range(shards)]


def test_op6_on_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    sizes = check_shards([(r.doc_id, r.text) for r in df.collect()], sharding.assign_shards(df).collect())
    assert max(sizes) - min(sizes) <= 0.02 * max(sizes)


def test_op6_hot_group_nulls_and_repeats(spark):
    rows = [(i, "copy " * 20) for i in range(4000)] + [(10_000 + i, f"text {i}" * (i % 9)) for i in range(4000)] + [(None, "n"), (None, None), (5, None), (5, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int").repartition(5)
    sizes = check_shards(rows, sharding.assign_shards(df).collect())
    assert max(sizes) - min(sizes) <= 0.02 * max(sizes)
    assert sharding.assign_shards(df.limit(0)).count() == 0


def test_small_groups_stay_together(spark):
    rows = [(i, f"text {i // 3}") for i in range(600)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shard = {r.doc_id: r.shard for r in got}
    assert all(len({shard[i] for i in range(k, k + 3)}) == 1 for k in range(0, 600, 3))


def test_large_groups_stay_together_where_they_fit(spark):
    """Three copies that are over 1/64 of a shard, in a table of over 131,072 bytes."""
    rows = [(i, "copied text " * 350) for i in range(3)] + [(10 + i, f"text {i} " * (i % 40 + 1)) for i in range(6000)]
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes = check_shards(rows, got)
    assert len({r.shard for r in got if r.doc_id < 3}) == 1 and max(sizes) - min(sizes) <= 0.02 * max(sizes)


def test_a_third_of_a_small_table_is_split(spark):
    """At any size a group that alone unbalances a shard is split, and no other."""
    rows = [(i, "copy " * 20) for i in range(200)] + [(1000 + i, f"other {i // 2:03d} " * 4) for i in range(1000)]
    assert sum(len(t) + 1 for _, t in rows) < 8 * sharding.CELLS
    got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sizes, shard = check_shards(rows, got), {r.doc_id: r.shard for r in got}
    assert max(sizes) - min(sizes) <= 0.02 * max(sizes)
    assert all(shard[1000 + i] == shard[1001 + i] for i in range(0, 1000, 2))


def test_groups_are_split_only_if_they_do_not_fit():
    vectors = np.array([[30, 1, 1]] * 4 + [[5, 1, 1]] * 4)
    items, _ = sharding.pack(vectors, [np.array([0, 1]), np.array([2, 3]), *(np.array([i]) for i in range(4, 8))], 2)
    assert sorted(len(g) for g in items) == [1, 1, 1, 1, 2, 2]
    items, _ = sharding.pack(vectors, [np.array([0, 1, 2, 3]), *(np.array([i]) for i in range(4, 8))], 2)
    assert {len(g) for g in items} == {1}


def test_dot_product_placing():
    vectors = np.array([[10, 1, 1], [1, 10, 1], [9, 1, 1], [1, 9, 1]])
    place = sharding.place_cells(vectors, 2)
    totals = np.array([vectors[place == s].sum(axis=0) for s in (0, 1)])
    assert (totals.max(axis=0) - totals.min(axis=0)).max() <= 1


def plain_places(vectors, shards):
    """The dot product rule, one item after the other."""
    total = [sum(v[d] for v in vectors) for d in range(3)]
    loads = [[v[d] * shards / total[d] for d in range(3)] for v in vectors]
    residual, place = [[1.0] * 3 for _ in range(shards)], [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-max(loads[i]), i)):
        scores = [sum(r * x for r, x in zip(room, loads[i], strict=True)) for room in residual]
        place[i] = max(range(shards), key=lambda s: (round(scores[s], 12), -s))
        residual[place[i]] = [r - x for r, x in zip(residual[place[i]], loads[i], strict=True)]
    return place


def test_placing_against_a_plain_version():
    rng = np.random.default_rng(4)
    for shards in (2, 5, 8):
        vectors = rng.integers(1, 1000, (60, 3))
        assert sharding.place_cells(vectors, shards).tolist() == plain_places(vectors.tolist(), shards)


def test_levelling_spares_tokens_and_rows():
    """Bytes end within a hundredth of each other, tokens and rows near it."""
    vectors = np.random.default_rng(5).integers([50, 5, 1], [5000, 900, 4], (3000, 3))
    place = sharding.place_groups(list(range(3000)), vectors, 8)
    loads = np.array([vectors[place == s].sum(axis=0) for s in range(8)])
    assert ((loads.max(axis=0) - loads.min(axis=0)) <= 0.025 * loads.mean(axis=0)).all()


def test_equal_texts_of_documents_share_a_shard(spark):
    """All groups of the table but those that alone would unbalance a shard."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in df.collect()}
    got, shards, size = sharding.assign_shards(df).collect(), defaultdict(set), defaultdict(int)
    for r in got:
        shards[text[r.doc_id]].add(r.shard)
        size[text[r.doc_id]] += r.size
    limit = sum(size.values()) / 8 / sharding.SPLIT
    assert [t for t, s in shards.items() if len(s) > 1 and size[t] <= limit] == []


def test_write_shards_with_clashing_columns(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", -i, "s") for i in range(40)], "doc_id long, text string, shard int, slot string")
    sharding.write_shards(df, sharding.assign_shards(df), str(tmp_path / "clash"))
    back = spark.read.parquet(str(tmp_path / "clash"))
    assert set(back.columns) == {"doc_id", "text", "shard", "slot", "shard_", "slot_"} and sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == [(i, -i, "s") for i in range(40)]


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    sharding.write_shards(df, sharding.assign_shards(df), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and {r.shard for r in back.collect()} == set(range(8))


def brute_chains(text):
    """Signatures as tuples of words."""
    import regex

    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
    content, anchored = [], []
    for i, w in enumerate(words):
        if w not in spot_signatures.COMMON:
            content.append(w)
            anchored.append(i > 0 and words[i - 1] in spot_signatures.ANCHORS)
    every = [(tuple(content[i : i + 3]), anchored[i]) for i in range(len(content) - 2)]
    spots = {c for c, a in every if a}
    return spots if len(spots) >= spot_signatures.FEW else {c for c, _ in every}


def near(a, b, x, y):
    if not a or not b:
        return float(not a and not b and x.lower() == y.lower())
    return len(a & b) / len(a | b)


def check_fingerprints(rows, got):
    named = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda x: (x[0], x[1]))
    following = [(i, t, named[(k + 1) % len(named)][1]) for k, (i, t) in enumerate(named)] + [(None, t or "", t or "") for i, t in rows if i is None]
    sets = [(i, frozenset(brute_chains(t)) or t.lower()) for i, t, _ in following]
    class_of = {}
    for i, s in sets:
        class_of[s] = min((x for x in (class_of.get(s), i) if x is not None), default=None)
    want = []
    for (i, t, after), (_, s) in zip(following, sets, strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = map(brute_chains, (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(near(a, b, t, edited), 9), round(near(a, c, t, after), 9), class_of[s]))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), r.class_id) for r in got), key=repr) == sorted(want, key=repr)


def test_op8_on_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = spot_signatures.fingerprints(df).collect()
    check_fingerprints(rows, got)
    text = dict(rows)
    prints = defaultdict(set)
    for r in got:
        prints[text[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_op8_odd_rows(spark):
    rows = [(None, "x y"), (None, None), (5, ""), (5, "the big cat sat"), (-3, "The BIG cat, sat on the mat of red wool"), (900_000, "é" * 9), (7, "the a of"), (7, "the a of")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, bucket int")
    check_fingerprints(rows, spot_signatures.fingerprints(df).collect())
    assert spot_signatures.fingerprints(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    assert spot_signatures.fingerprints(one).first().near_next == 1.0
    ends = [(2**63 - 1, "the last of all"), (-(2**63), "the first of all"), (0, "an odd middle one of them"), (2**63 - 2, "x"), (None, "the first of all")]
    check_fingerprints(ends, spot_signatures.fingerprints(spark.createDataFrame(ends, "doc_id long, text string")).collect())


def test_op8_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(spot_signatures, "BUCKET_BYTES", 100)
    monkeypatch.setattr(spot_signatures, "BLOCK", 16)
    rows = [(i * i, f"the word{i} sees a house{i % 7} near the lake by night{i % 5} and day") for i in range(300)]
    check_fingerprints(rows, spot_signatures.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_similar_pairs(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    sets = {r.doc_id: frozenset(r.fingerprint.split()) for r in spot_signatures.fingerprints(df).collect()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    own = sorted((i, s) for s, i in first.items())
    want = {(a, b) for k, (a, x) in enumerate(own) for b, y in own[:k] if len(x & y) >= 0.5 * len(x | y)}
    pairs, members = spot_signatures.similar_pairs(df, 0.5)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: first[s] for i, s in sets.items()}


@pytest.mark.parametrize("block", [2048, 8])
def test_similar_pairs_in_blocks(spark, block, monkeypatch):
    """Near copies whose signatures are shared by many."""
    monkeypatch.setattr(spot_signatures, "BLOCK", block)
    rng = np.random.default_rng(6)
    base = [f"the w{i} x{i} y{i}" for i in range(40)]
    rows = [(i, " ".join(x for k, x in enumerate(base) if k not in rng.integers(0, 40, 3)) + f" the own{i % 50} a b{i % 50} c") for i in range(60)]
    sets = {i: brute_chains(t) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    own = sorted((i, s) for s, i in first.items())
    want = {(a, b) for k, (a, x) in enumerate(own) for b, y in own[:k] if len(x & y) >= 0.75 * len(x | y)}
    pairs, _ = spot_signatures.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.a, r.b) for r in pairs.collect()} == want and len(want) > 100


def test_op8_plan_has_no_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (spot_signatures.op8_spot_signatures(spark, small), spot_signatures.compared(docs), *spot_signatures.similar_pairs(docs))]
    assert not any(x in plan for plan in plans for x in ("Python", "Arrow", "Pandas"))
    assert plans[1].count("split(") == 2


def brute_pages(rows):
    first, seen, out = {}, set(), []
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = i is not None and (first[h or ""] != i or (i, raw) in seen)
        seen.add((i, raw))
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=repr)


PAGES = [(5, "u", "x"), (3, "v", "x"), (3, "v", "x"), (None, None, None), (None, "a", "x"), (9, None, None), (8, "q", ""), (-7000, "q", "z\r\n\r\né" * 1000), (10**12, "http://a b", "z"), (3, "v", "other")]


def test_op9_sql_against_brute_force(small):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for rows in (PAGES, [(r[0], None, r[1]) for r in con.sql(f"SELECT page_id, html FROM '{small}/pages.parquet'").fetchall()]):
        frame = pd.DataFrame({"page_id": pd.array([r[0] for r in rows], dtype="Int64"), "html": pd.array([r[2] for r in rows], dtype="string")})
        con.register("pages", frame)
        assert sorted(con.sql(warc.ORACLE_SQL).fetchall(), key=repr) == brute_pages(rows)
        con.unregister("pages")


def archive(spark, df, **more):
    folder = fresh_path(spark, "warc-test")
    return warc.write_archives(df, folder, **more), folder


def test_op9_on_pages(spark, small):
    df = spark.read.parquet(f"{small}/pages.parquet")
    assert sorted(map(tuple, warc.op9_warc(spark, small).collect()), key=repr) == brute_pages([(r.page_id, r.url, r.html) for r in df.collect()])


def test_archives_round_trip_and_are_deterministic(spark):
    df = spark.createDataFrame([(*r, "k") for r in PAGES], "page_id long, url string, html string, kind string")
    manifest, folder = archive(spark, df, shard_bytes=2500, roll_bytes=300)
    back = warc.read_archives(spark, manifest, folder, with_payload=True).collect()
    assert sorted(((r.page_id, *tuple(r)[2:6]) for r in back), key=repr) == brute_pages(PAGES)
    assert {r.page_id: r.payload.decode() for r in back if r.record_type == "response" and r.page_id in (-7000, 10**12)} == {-7000: PAGES[7][2], 10**12: "z"}
    rows = manifest.collect()
    assert all(hashlib.sha256(Path(r.path).read_bytes()).hexdigest() == r.sha256 and Path(r.path).stat().st_size == r.bytes for r in rows)
    assert not list(Path(rows[0].path).parent.glob("*.open"))
    again, _ = archive(spark, df.repartition(5), shard_bytes=2500, roll_bytes=300)
    name = lambda r: (r.path.rsplit("/", 1)[1], r.sha256)
    assert sorted(map(name, rows)) == sorted(map(name, again.collect()))
    first = gzip.decompress(Path(rows[0].path).read_bytes())
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_empty_pages_and_damage(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    manifest, folder = archive(spark, df.limit(0))
    assert manifest.count() == 0 and warc.read_archives(spark, manifest, folder).count() == 0
    manifest, folder = archive(spark, df)
    path = Path(manifest.first().path)
    record = gzip.decompress(path.read_bytes())
    path.write_bytes(gzip.compress(record[: record.index(b"sha1:") + 5] + b"A" * 32 + record[record.index(b"sha1:") + 37 :]))
    with pytest.raises(Exception, match="digest|WARC"):
        warc.read_archives(spark, manifest, folder).collect()
