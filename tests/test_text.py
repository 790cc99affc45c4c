import re

from pyspark.sql import functions as F

from ledgerloom.functions import canonical_json as cj
from ledgerloom.functions import text as T


def values(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", column.alias("v"))
    return [r.v for r in rows.orderBy("i").collect()]


def test_squeeze_and_compact(spark):
    assert values(spark, T.squeeze("t"), " a\u00a0\u3000b\ufeff", None, "") == ["a b", "", ""]
    assert values(spark, T.compact("t", 3), "abcd", "abc", "a  bcd") == ["abc…", "abc", "a b…"]


def test_compact_array(spark):
    df = spark.createDataFrame([(["abcdef", " x ", "c"],), (None,)], "t array<string>").select(T.compact_array("t", 2, 3).alias("v"))
    assert [r.v for r in df.collect()] == [["abc…", "x"], []]


def test_names(spark):
    assert values(spark, T.directory_name("t"), "ＡＢ  c", "a:b", "con", "con.txt", "x.", "..", "", "a" * 41, "原神") == ["AB c", None, None, None, None, None, None, None, "原神"]
    assert values(spark, T.open_category("t"), "__x", "ok", " ok ") == [None, "ok", "ok"]
    assert values(spark, T.safe_category("t"), "a/b", "a. .", "nul", "a?") == ["a_b", "a", None, "a_"]
    assert values(spark, T.closed_category("t", ["同人"]), " 同人", "x") == ["同人", None]


def test_merge_names(spark):
    assert values(spark, T.without_suffix("t"), "原神系列", "Fate作品系列同人", "系列", "原神 同人 系列") == ["原神", "Fate", "系列", "原神"]
    assert values(spark, T.comparison_key("t"), "C++", "C#", "BanG Dream！", "Blue—Archive") == ["c++", "c#", "bangdream", "bluearchive"]
    assert values(spark, T.canonical_name("t"), "bang dream系列", "月姬") == ["BanG Dream!", "月姬"]
    assert values(spark, T.identity("t"), " ＡＢ ", None) == ["ab", ""]


def test_canonical_json():
    value = cj.load('{"b":1.0,"10":1,"9":2,"create_date":5,"a":{"z":[1e21,1e-7,-0.0,0.1],"modification_date":1}}')
    assert cj.canonical(value) == '{"9":2,"10":1,"a":{"z":[1e+21,1e-7,0,0.1]},"b":1}'
    assert cj.canonical({"～": 1, "\U0001f600": 2}) == '{"\U0001f600":2,"～":1}'
    assert cj.text('\ud800é"\n') == '"\\ud800é\\"\\n"'
    assert cj.load('{"a":1,"a":2}') == {"a": 2}
    assert [cj.number(x) for x in (1e20, 2**53 + 1, 1.5e-7, 0.000001, 5e-324, 123.456)] == ["100000000000000000000", "9007199254740992", "1.5e-7", "0.000001", "5e-324", "123.456"]


def test_flatten_limits():
    assert cj.flatten({"a": ["x", {"b": "deep"}], "c": True, "d": None, "e": 1.0}, 100) == "true 1 x deep"
    assert cj.flatten(list(range(40)), 1000).split() == [str(i) for i in range(30)]
    assert cj.flatten({str(i) + "k": i for i in range(60)}, 1000).split() == [str(i) for i in range(50)]
    assert cj.flatten(["abc", "defg"], 5) == "abc d…"[:5] + "…"


def test_nulls_and_collation(spark):
    assert values(spark, T.nfkc("t"), None, "ａ", "a") == [None, "a", "a"]
    names = spark.createDataFrame([("b",), ("a",), ("B",)], "t string").orderBy(F.expr("t COLLATE UNICODE")).collect()
    assert [r.t for r in names] == ["a", "b", "B"]


def test_heads_decide_only_what_they_hold(spark):
    """Texts around the limit, runs of white space around the end of the head, blanks of every kind: as the plain rule, in Spark and in Python; no branch squeezes a text twice."""
    n, space = 20, " \t\n\v\f\r\u00a0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    texts = [None, "", " ", space * 9, "a b  c", "a" * n, "a" * (n + 1), "a" * n + space * 9, "a" * (n - 1) + " " * 99 + "b", "a" * n + " " * 99 + "b", " " * 99 + "word " * 30]
    texts += ["a" + " " * k + "b" * k + space + "c" * 7 for k in range(45)] + ["é\u2003\U0001f600 " * k for k in range(30)] + [c.join("xyz" * 9) for c in space] + ["\u200b\x85\x1c\x00 " * 9]

    def rule(t):
        t = re.sub(f"[{space}\u2000-\u200a]+", " ", t or "").strip(" ")
        return t[:n] + "…" if len(t) > n else t

    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", T.compact("t", n).alias("c"))
    assert [r.c for r in df.orderBy("i").collect()] == [rule(t) for t in texts]
    assert [cj.shorten(t, n) for t in texts if t is not None] == [rule(t) for t in texts if t is not None]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(coalesce(t#") == 2
