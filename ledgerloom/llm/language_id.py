"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of letters (anything else counts as a space) are hashed to ``FEATURES``
places. Document frequencies are counted over all training documents; the
weights are fitted, by follow-the-regularised-leader with elastic-net
penalties, on a sample of at most ``PER_LANGUAGE`` documents of each language,
and the scores are calibrated by a temperature on a part of it held back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.worker import tidy

UNDETERMINED = "und"
FEATURES = 1 << 15
#: The bound of the sample that the weights are fitted on, for each language.
PER_LANGUAGE = 400
#: More languages than this are refused.
MOST_LANGUAGES = 1000
#: Of the sample, every n-th document serves calibration only.
CALIBRATION_EVERY = 5
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-4
#: Documents of a filtering stage whose calibrated score is lower are rejected.
LEAST_SCORE = 0.4

#: Characters of a text that are hashed at once.
SEGMENT = 1 << 20

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_BLANK = np.uint32(32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> Iterator[np.ndarray]:
    """The characters of a text, ``SEGMENT`` at a time: letters, and one space for what stands between them; a space in front and one behind."""
    follows = True  # what is no letter is kept behind a letter and at the beginning
    for begin in range(0, len(text), SEGMENT):
        codes = np.frombuffer(text[begin : begin + SEGMENT].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        kept = np.where(letter, codes, _BLANK)[letter | np.append(follows, letter[:-1])]
        follows = letter[-1]
        yield np.concatenate(([_BLANK] * (begin == 0), kept, [_BLANK] * (begin + SEGMENT >= len(text)))).astype(np.uint32)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of the n-grams of 1 to 3 characters of the whole text in lower case; empty if it has no letter.

    Very long texts are hashed a segment at a time; n-grams go on across segments.
    """
    counts, before, letters = np.zeros(FEATURES, dtype=np.int64), np.zeros(0, dtype=np.uint32), False
    for codes in _codes((text or "").lower()):
        letters = letters or bool((codes != _BLANK).any())
        codes = np.concatenate((before, codes))
        hashed, parts = np.zeros(len(codes), dtype=np.uint32), []
        for n, m in enumerate(_MULTIPLIERS):
            hashed = (hashed[: max(len(codes) - n, 0)] ^ codes[n:]) * m
            hashed ^= hashed >> np.uint32(15)
            parts.append(hashed[max(len(before) - n, 0) :] % np.uint32(FEATURES))  # those that end in this segment
        counts += np.bincount(np.concatenate(parts), minlength=FEATURES)
        before = codes[1 - len(_MULTIPLIERS) :]
    if not letters:
        return np.zeros(0, np.int64), np.zeros(0)
    places = np.flatnonzero(counts)
    return places, counts[places].astype(float)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (FEATURES + 1, languages); the last row is the bias
    temperature: float = 1.0

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[places]
        return x / (np.sqrt((x * x).sum()) or 1.0)

    def logits(self, places: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[places] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        """``und`` and 0 for a text without letters, or if nothing was learned."""
        places, counts = features(text)
        if not len(places) or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.logits(places, self.vector(places, counts)) / self.temperature)
        return self.languages[int(p.argmax())], float(p.max())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (places, values, language) by FTRL-proximal, one step for each example; L1 leaves most weights exactly 0."""
    z, n = np.zeros((FEATURES + 1, languages)), np.zeros((FEATURES + 1, languages))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(examples)).tolist():
            places, x, y = examples[i]
            at, x = np.append(places, FEATURES), np.append(x, 1.0)
            w = weights(z[at], n[at])
            error = softmax(x @ w)
            error[y] -= 1.0
            g = x[:, None] * error
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(z, n)


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least cross-entropy, by golden section on its logarithm; 1 without examples."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents that nothing is learned from; a null doc_id is not held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frequency, n = np.zeros(FEATURES + 1, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            frequency[features(text)[0]] += 1
            n += 1
    frequency[FEATURES] = n
    places = np.flatnonzero(frequency)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(frequency[places])], names=["place", "documents"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([p.astype("<u4").tobytes() for p, _ in found], pa.binary()), pa.array([c.astype("<f4").tobytes() for _, c in found], pa.binary())], names=["mark", "lang", "places", "counts"])


def sample_bound(n: int, per_language: int) -> int:
    """The largest hash, of all signed 64-bit ones, that 1.2 * ``per_language`` of ``n`` documents are expected not to exceed."""
    return min((1 << 63) - 1, -(1 << 63) + (12 * per_language << 64) // (10 * n))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the text and non-null lang of documents that are not held out.

    The sample of a language is its documents of least hash of doc_id and text; the driver gets about 1.2 * ``per_language`` of each.
    More than ``MOST_LANGUAGES`` values of lang raise, as the weights of all of them must fit into a worker.
    """
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("doc_id", "lang", "text")
    totals = {r.lang: r["count"] for r in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"lang has more than {MOST_LANGUAGES} values")
    languages = sorted(totals)
    if not languages:
        return Model([], np.ones(FEATURES), np.zeros((FEATURES + 1, 0)))
    frequency = np.zeros(FEATURES + 1)
    for r in known.select("text").mapInArrow(tidy(_document_frequencies), "place long, documents long").groupBy("place").agg(F.sum("documents").alias("n")).collect():  # FEATURES + 1 rows at most
        frequency[r.place] = r.n
    idf = np.log((1 + frequency[FEATURES]) / (1 + frequency[:FEATURES])) + 1
    bound = F.create_map(*(F.lit(x) for k, n in totals.items() for x in (k, sample_bound(n, per_language))))
    mark = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("sample"))
    some = known.filter(mark <= bound[F.col("lang")]).select(mark.alias("mark"), "lang", "text").mapInArrow(tidy(_vectors), "mark long, lang string, places binary, counts binary")
    rows: dict[str, list] = {}
    for r in sorted(some.collect(), key=lambda r: (r.lang, r.mark)):
        own = rows.setdefault(r.lang, [])
        if len(own) < per_language:
            own.append(r)
    if set(rows) != set(languages):
        raise ValueError(f"no sample of {sorted(set(languages) - set(rows))}")
    model, fitted, kept = Model(languages, idf, np.zeros((FEATURES + 1, len(languages)))), [], []
    for lang, own in rows.items():
        for i, r in enumerate(own):
            places = np.frombuffer(r.places, "<u4").astype(np.int64)
            example = places, model.vector(places, np.frombuffer(r.counts, "<f4").astype(float)), languages.index(lang)
            if len(places):
                (kept if i % CALIBRATION_EVERY == CALIBRATION_EVERY - 1 else fitted).append(example)
    model.weights = fit_ftrl(fitted, len(languages))
    model.temperature = calibrate(np.array([model.logits(p, x) for p, x, _ in kept]), np.array([y for *_, y in kept], dtype=np.int64))
    return model


def predictor(spark, model: Model) -> Callable[[str], Column]:
    """A function of a text column: struct of lang_pred and score."""
    shared = spark.sparkContext.broadcast(model)  # FEATURES rows of as many numbers as languages

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its text alone. Repeated rows get one answer; an empty table gives no rows.

    More than ``MOST_LANGUAGES`` values of lang among the documents learnt from raise. Of languages with equal scores the first by name is taken. Texts of any length are read whole. Other columns are not looked at.
    """
    predict = predictor(docs.sparkSession, model or train(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), predict("text").alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def identified(docs: DataFrame, model: Model | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least_score`` or more."""
    predict = predictor(docs.sparkSession, model or train(docs))
    rows = docs.withColumn("__language", predict("text"))
    return rows.filter((F.col("__language.lang_pred") != UNDETERMINED) & (F.col("__language.score") >= least_score)).select(docs.columns)


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
