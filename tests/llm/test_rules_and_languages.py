import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language_id, quality_rules


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = ["", None, " \n\t", "a b c d e a b c d e f", "x\nx\n\nx\ny\r\ny", "é\xa0é #$%", "a " * 30, "one two three four five six", "a\x0bb\x0cc\x1cd"]


def test_measures():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(200)]
    assert [quality_rules.measure_text(t) for t in texts] == [brute_measures(t) for t in texts]


def test_repeats_with_many_words():
    words = [str(i).encode() for i in range(9000)]
    assert quality_rules._repeat_words(words[:8000] + words[:50]) == 100
    assert quality_rules._repeat_words(words + [b"0"]) == 0


def test_host_verdicts(spark):
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(i, "bad", "x") for i in range(60)] + [(i, "fine", good) for i in range(100, 400)] + [(500, "bad", good), (501, None, good), (502, None, "x"), (503, "tiny", "x"), (504, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    assert got[500].host_rejected and not got[500].kept and not got[500].base_failed
    assert got[501].kept and not got[502].kept and not got[504].kept and got[100].kept
    assert got[0].base_failed
    kept = quality_rules.passing(df.withColumn("n_words", F.lit("clash")))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept} and kept.columns == [*df.columns, "n_words"]
    assert quality_rules.judge(df.limit(0)).count() == 0 and quality_rules.passing(df.limit(0)).count() == 0


def test_shrinking_needs_evidence(spark):
    """One failing document does not condemn a host among sound ones."""
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(i, f"h{i // 20}", "x" if i % 20 == 0 else good) for i in range(2000)] + [(5000, "single", "x"), (5001, "single", good)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert not any(r.rejected for r in quality_rules.host_verdicts(quality_rules.measured(df)).collect())


def test_many_hosts_are_joined_by_shuffle(spark, monkeypatch):
    rows = [(i, f"h{i % 7}", "x" if i % 7 < 3 else "a b c d e f g h i j k") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(tuple, quality_rules.judge(df).collect()))
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", 1)
    assert sorted(map(tuple, quality_rules.judge(df).collect())) == want


def test_op1_equals_sql(spark, small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    df = quality_rules.op1_quality_rules(spark, small)
    want = con.sql(quality_rules.ORACLE_SQL)
    assert sorted(map(tuple, df.select(want.columns).collect())) == sorted(want.fetchall())


@pytest.fixture(scope="module")
def model(spark):
    return language_id.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert (model.weights != 0).mean() < 0.5


def test_nothing_is_learned_from_held_out_rows(spark):

    text = {True: "le la des un une est dans pour", False: "the and of that with was for"}
    rows = [(i, text[zlib.crc32(str(i).encode()) % 4 == 2], "fr" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in range(80)]
    df = spark.createDataFrame(rows + [(100, None, "xx"), (None, "hola", "es"), (101, "hola", None)], "doc_id long, text string, lang string")
    m = language_id.train(df)
    assert m.languages == ["en"]
    got = {r.doc_id: r for r in language_id.identify(df, m).collect()}
    assert got[100].lang_pred == "und" and got[101].lang_pred == "en" and got[None].held_out is False
    assert {i for i, r in got.items() if r.held_out} == {i for i, t, lang in rows if lang == "fr"} | {i for i in (100, 101) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_undetermined_and_empty(spark, model):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 %%"), (4, "the and of the"), (4, "the and of the")], "doc_id long, text string")
    got = sorted((r.doc_id, r.lang_pred) for r in language_id.identify(df, model).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert {r.doc_id for r in language_id.identified(df.withColumn("score", F.lit(0)), model).collect()} == {4}
    empty = df.limit(0).withColumn("lang", F.lit(None).cast("string"))
    assert language_id.identify(empty).count() == 0


def test_calibration_softens_overconfidence():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    logits = np.zeros((400, 2))
    logits[np.arange(400), np.where(rng.random(400) < 0.75, y, 1 - y)] = 10.0
    p = language_id.softmax(np.array([10.0, 0.0]) / language_id.calibrate(logits, y)).max()
    assert abs(p - 0.75) < 0.06
    assert language_id.calibrate(np.zeros((0, 2)), np.zeros(0, np.int64)) == 1.0


def test_features_of_whole_long_texts():
    places, counts = language_id.features("ab " * 50_000)
    assert counts.sum() > 400_000 and len(places) < 20
    assert language_id.features("Ab")[0].tolist() == language_id.features("aB")[0].tolist()


def plain_features(text):
    """The n-grams of a text by the definition, one at a time."""
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return {}
    chars = " " + re.sub(r" +", " ", "".join(c if c.isalpha() else " " for c in text)) + " "
    counts = Counter()
    for i in range(len(chars)):
        h = 0
        for n, m in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
            if i + n < len(chars):
                h = (h ^ ord(chars[i + n])) * m & 0xFFFFFFFF
                h ^= h >> 15
                counts[h % language_id.FEATURES] += 1
    return counts


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 1 << 20])
def test_features_against_plain_ones(monkeypatch, segment):
    monkeypatch.setattr(language_id, "SEGMENT", segment)
    for text in [None, "", " ", "12 %%", "a", " a", "a ", "ab", "A1b--c", "  the  cat,, sat", "\u0130stanbul \u03a3\u03a3", "x" * 50, "\U0001d4d0\U0001f600z", "\u4e2d\u6587 text \u0939\u093f"]:
        places, counts = language_id.features(text)
        assert dict(zip(places.tolist(), counts.tolist(), strict=True)) == plain_features(text), text


def test_training_against_plain_ftrl(spark):
    """Document frequencies, TF-IDF, FTRL with elastic net, temperature and predictions of a small table, each by its definition."""
    words = {"en": "the and of that with was for this have from".split(), "fr": "le la des une est dans pour avec pas que".split(), "de": "der die und das nicht mit ist ein auch von".split()}
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(1, 9))), lang) for i, lang in enumerate(rng.choices(sorted(words), k=90))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    # The sample's order is by Spark's hash; all else is plain.
    marks = {r.doc_id: r.m for r in df.select("doc_id", F.xxhash64(F.col("doc_id"), F.lit("sample")).alias("m")).collect()}
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    languages = sorted({lang for *_, lang in known})
    df_of = Counter(place for _, text, _ in known for place in plain_features(text))

    def vector(text):
        x = {p: math.log(1 + c) * (math.log((1 + len(known)) / (1 + df_of[p])) + 1) for p, c in plain_features(text).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {p: x[p] / norm for p in sorted(x)}

    fitted, kept = [], []
    first_seen = sorted({lang for *_, lang in known})
    for lang in first_seen:
        own = sorted((r for r in known if r[2] == lang), key=lambda r: (marks[r[0]] % 1_000_000, marks[r[0]]))
        for i, (_, text, _) in enumerate(own):
            (kept if i % language_id.CALIBRATION_EVERY == language_id.CALIBRATION_EVERY - 1 else fitted).append((vector(text), languages.index(lang)))
    z, n, bias = defaultdict(float), defaultdict(float), language_id.FEATURES

    def weight(key):
        if abs(z[key]) <= language_id.L1:
            return 0.0
        return -(z[key] - math.copysign(language_id.L1, z[key])) / ((language_id.BETA + math.sqrt(n[key])) / language_id.ALPHA + language_id.L2)

    def scores(x, temperature=1.0):
        logits = [(sum(v * weight((p, k)) for p, v in x.items()) + weight((bias, k))) / temperature for k in range(len(languages))]
        e = [math.exp(s - max(logits)) for s in logits]
        return [v / sum(e) for v in e]

    order = np.random.default_rng(0)
    for _ in range(language_id.EPOCHS):
        for i in order.permutation(len(fitted)).tolist():
            x, y = fitted[i]
            p = scores(x)
            steps = []
            for k in range(len(languages)):
                for place, v in [*x.items(), (bias, 1.0)]:
                    steps.append(((place, k), v * (p[k] - (k == y)), weight((place, k))))
            for key, g, w in steps:
                z[key] += g - (math.sqrt(n[key] + g * g) - math.sqrt(n[key])) / language_id.ALPHA * w
                n[key] += g * g
    # The temperature of least loss on a fine grid; the library's must be as good.
    def loss(t):
        return -sum(math.log(scores(x, t)[y]) for x, y in kept)

    temperature = language_id.train(df).temperature
    assert loss(temperature) <= min(loss(math.exp(t / 20)) for t in range(-80, 81)) + 1e-9
    for i, text, _ in rows:
        p = scores(vector(text), temperature)
        assert abs(got[i].score - max(p)) < 1e-4 and got[i].lang_pred == languages[p.index(max(p))]
