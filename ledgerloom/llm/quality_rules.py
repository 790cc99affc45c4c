"""Host-level quality rules.

Rules judge documents by measures of their whole text. Failures are counted by
host and rule; each host's rate is shrunk towards the rate of all hosts by a
beta prior, fitted to the hosts' rates by moments, so that a host with few
documents is judged by little evidence only. A host whose shrunk rate reaches
``worst_rate`` for some rule is rejected with all its documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, materialise

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
#: A host is rejected from this shrunk rate of failures on.
WORST_RATE = 0.5
#: Rejected hosts up to this number are broadcast; more are joined by salted shuffle.
BROADCAST_HOSTS = 50_000
SALTS = 32


def _rules(of: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Failures, as conditions on the measures ``of`` their names."""
    return {
        "few_words": of("n_words") < 10,
        "repeats": 100 * of("n_repeat_words") > 20 * of("n_words"),
        "symbols": 10 * of("n_symbols") > 3 * of("word_chars"),
        "dup_lines": 10 * of("n_dup_lines") > 3 * of("n_words"),
    }


#: Their failure is a document's base_failed.
BASE_RULES = ("few_words", "repeats")


def _repeat_words(words: list[bytes]) -> int:
    """Words in five-word windows that occur twice or more."""
    n = len(words) - 4
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    ids, size = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)), len(number)
    if size**5 < 1 << 63:
        key = (((ids[:n] * size + ids[1 : n + 1]) * size + ids[2 : n + 2]) * size + ids[3 : n + 3]) * size + ids[4 : n + 4]
    else:  # pairs of pairs, numbered anew so that they fit
        pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * len(pair) + pair[2:], return_inverse=True)[1]
        key = four[:n] * size + ids[4 : n + 4]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    covered = np.zeros(len(words), dtype=bool)
    for i in range(5):
        covered[i : i + n] |= hit
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # of bytes: at the six ASCII white-space characters
    space = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), len(text) - space, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeat_words(words)


def _measure(text: str) -> Column:
    """The measures of a text column, as a struct."""

    def measures(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES, dtype="int64")

    return F.pandas_udf(measures, ", ".join(f"{m} long" for m in MEASURES))(text)


@dataclass(frozen=True)
class Prior:
    """A beta prior: ``mean`` is the rate of all documents, ``weight`` the documents that the prior counts for."""

    mean: float
    weight: float


def _prior(hosts: int, n: float, n2: float, k: float, k2: float) -> Prior:
    """By moments: from the number of hosts, the sums of n, n^2 and k, and of k^2 / n, over hosts with n documents and k failures."""
    mean = k / n if n else 0.0
    spread = mean * (1 - mean)
    within = hosts - 1
    room = spread * (n - (n2 / n if n else 0) - within)
    share = ((k2 - k * mean) - spread * within) / room if room > 0 else 0.0
    share = min(max(share, 1e-4), 0.99)
    return Prior(mean, (1 - share) / share)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with the measures. A null or empty text measures 0."""
    return docs.withColumn("__measures", _measure("text")).select("*", *(F.col("__measures")[m].alias(m) for m in MEASURES)).drop("__measures")


def host_verdicts(measures: DataFrame, host: str = "source", worst_rate: float = WORST_RATE) -> DataFrame:
    """For each host: n, failures and shrunk rate by rule, and rejected. Documents without a host count for none."""
    rules = _rules()
    counts = measures.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(r) for r, c in rules.items()))
    counts = materialise(counts, "hosts")
    sums = counts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("n2"), *(F.sum(r).alias(r) for r in rules), *(F.sum(F.col(r) * F.col(r).cast("double") / F.col("n")).alias(f"{r}_2") for r in rules)).first()
    priors = {r: _prior(sums.hosts, float(sums.n or 0), sums.n2 or 0.0, float(sums[r] or 0), sums[f"{r}_2"] or 0.0) for r in rules}
    rates = {r: (F.col(r) + p.mean * p.weight) / (F.col("n") + p.weight) for r, p in priors.items()}
    return counts.select("*", *(x.alias(f"{r}_rate") for r, x in rates.items()), (F.greatest(*rates.values()) >= worst_rate).alias("rejected"))


def _with_verdicts(rows: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    """``rows`` with ``__host_rejected``."""
    rejected = verdicts.filter("rejected").select(F.col("host").alias("__host"), F.lit(True).alias("__rejected"))
    if len(rejected.take(BROADCAST_HOSTS + 1)) <= BROADCAST_HOSTS:
        joined = rows.join(F.broadcast(rejected), F.col(host) == F.col("__host"), "left")
    else:  # a host with a large share of the rows is dealt to SALTS tasks
        salted = rejected.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__row_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, (F.col(host) == F.col("__host")) & (F.col("__row_salt") == F.col("__salt")), "left").drop("__row_salt", "__salt")
    return joined.withColumn("__host_rejected", F.coalesce("__rejected", F.lit(False))).drop("__host", "__rejected")


def judge(docs: DataFrame, host: str = "source", worst_rate: float = WORST_RATE) -> DataFrame:
    """doc_id, the measures, base_failed, host_rejected, kept for every row.

    A null host is never rejected; repeated rows count each time, and so do rows with a null doc_id, which stays null. A null or empty text has no words and
    fails. Texts of any length are measured whole. An empty table gives no rows. Other columns than doc_id, text and ``host`` are not looked at.
    """
    rows = materialise(measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("__source"), "text")).drop("text"), "measures")
    rules = _rules()
    failed = F.lit(False)
    for r in BASE_RULES:
        failed = failed | rules[r]
    judged = _with_verdicts(rows, host_verdicts(rows, "__source", worst_rate), "__source").withColumn("base_failed", failed)
    return judged.select("doc_id", *MEASURES, "base_failed", F.col("__host_rejected").alias("host_rejected"), (~F.col("base_failed") & ~F.col("__host_rejected")).alias("kept"))


def passing(docs: DataFrame, host: str = "source", worst_rate: float = WORST_RATE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, which must not be called ``__m``, ``__host``, ``__rejected`` or ``__host_rejected``; else as judge(). Texts are measured twice, for the hosts and for the rows, so that no text is shuffled."""
    narrow = measured(docs.select(F.col(host).alias("__source"), "text")).drop("text")
    verdicts = host_verdicts(narrow, "__source", worst_rate)
    marked = docs.withColumn("__m", _measure("text"))
    measure = lambda m: F.col("__m")[m]
    rules, failed = _rules(measure), F.lit(False)
    for r in BASE_RULES:
        failed = failed | rules[r]
    return _with_verdicts(marked.filter(~failed), verdicts, host).filter("not __host_rejected").select(docs.columns)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_FAILS = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * word_chars",
    "dup_lines": "10 * n_dup_lines > 3 * n_words",
}

ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS w FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM texts)
), twice AS (
  SELECT doc_id, i FROM windows WINDOW same AS (PARTITION BY doc_id, w) QUALIFY count(*) OVER same > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM texts
), m AS (
  SELECT t.doc_id, t.source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l.lines) - len(list_distinct(l.lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN lines l ON t.doc_id = l.doc_id LEFT JOIN covered c ON t.doc_id = c.doc_id
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, {", ".join(f"(count(*) FILTER (WHERE {c}))::DOUBLE AS {r}" for r, c in _FAILS.items())} FROM m WHERE source IS NOT NULL GROUP BY source
), sums AS (
  SELECT count(*) AS h, sum(n) AS n, sum(n * n) AS n2, {", ".join(f"sum({r}) AS {r}, sum({r} * {r} / n) AS {r}_2" for r in _FAILS)} FROM hosts
), shares AS (
  SELECT {", ".join(f"{r} / n AS {r}_p, CASE WHEN {r} / n * (1 - {r} / n) * (n - n2 / n - (h - 1)) > 0 THEN (({r}_2 - {r} * {r} / n) - {r} / n * (1 - {r} / n) * (h - 1)) / ({r} / n * (1 - {r} / n) * (n - n2 / n - (h - 1))) ELSE 0 END AS {r}_s" for r in _FAILS)} FROM sums
), priors AS (
  SELECT {", ".join(f"{r}_p, (1 - least(greatest({r}_s, 1e-4), 0.99)) / least(greatest({r}_s, 1e-4), 0.99) AS {r}_w" for r in _FAILS)} FROM shares
), verdicts AS (
  SELECT source, greatest({", ".join(f"({r} + {r}_p * {r}_w) / (n + {r}_w)" for r in _FAILS)}) >= {WORST_RATE} AS rejected FROM hosts, priors
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILS["few_words"]} OR {_FAILS["repeats"]} AS base_failed,
  coalesce(rejected, false) AS host_rejected, NOT ({_FAILS["few_words"]} OR {_FAILS["repeats"]}) AND NOT coalesce(rejected, false) AS kept
FROM m LEFT JOIN verdicts v ON m.source = v.source
"""
