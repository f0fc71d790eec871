"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased code points of a whole text, hashed into ``BUCKETS``. Document
frequencies come from all training documents. The classifier is fitted by follow-the-regularised-leader (proximal, per
coordinate) with elastic-net penalties on a bounded sample, about ``PER_LANGUAGE`` training documents of each language,
in one task; a fifth of the sample sets the temperature that calibrates its probabilities.

A text that is null or has no letter gets ``und`` and score 0, as does every text if no training document has a
language. Ties go to the language that sorts first. Repeated rows count as often as they occur. A null doc_id is in fold
0, so it is never learned from. Only text and, for training, lang are read; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
PER_LANGUAGE = 400
MAX_LANGUAGES = 1024  # beyond this many the fit stops with an error
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
UNKNOWN = "und"
_PIECE = 1 << 18  # code points handled at a time
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    overlap = max(ORDERS) - 1
    for begin in range(0, len(points), _PIECE):
        piece = points[begin:begin + _PIECE + overlap]
        own = len(piece) if begin + _PIECE >= len(points) else _PIECE
        value = np.zeros(len(piece), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(piece) < n:
                break
            value = (value[:len(piece) - n + 1] ^ (piece[n - 1:] + np.uint32(n))) * _FACTORS[n % 3]
            value ^= value >> np.uint32(15)
            if n in ORDERS:
                hashed = (value[:own] * _FACTORS[2]) >> np.uint32(32 - BUCKETS.bit_length() + 1)
                counts += np.bincount(hashed, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length TF-IDF values."""
    values = (1 + np.log(counts)) * idf
    return values / np.sqrt(values @ values) if len(values) else values


class Ftrl:
    """Multinomial FTRL-proximal with L1 and L2 penalties; the last column of the state is the bias."""

    def __init__(self, n_classes: int, n_features: int):
        self.z = np.zeros((n_classes, n_features + 1))
        self.n = np.zeros((n_classes, n_features + 1))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        l1 = np.where(at == self.z.shape[1] - 1, 0.0, L1)
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        at, values = np.append(at, self.z.shape[1] - 1), np.append(values, 1.0)
        w = self.weights(at)
        miss = softmax(w @ values)
        miss[label] -= 1
        gradient = miss[:, None] * values
        n = self.n[:, at]
        step = (np.sqrt(n + gradient ** 2) - np.sqrt(n)) / ALPHA
        self.z[:, at] += gradient - step * w
        self.n[:, at] = n + gradient ** 2


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the highest likelihood of the labels, from a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x buckets, float32
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, text: str) -> tuple[str, float]:
        at, counts = features(text)
        values = weighted(counts, self.idf[at])
        p = softmax((self.weights[:, at] @ values + self.bias) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def _fit(languages: list[str], idf: np.ndarray, rows: list[tuple[int, np.ndarray, np.ndarray, bool]]
         ) -> tuple[np.ndarray, np.ndarray, float]:
    learner = Ftrl(len(languages), BUCKETS)
    fit = [(label, at, weighted(counts, idf[at])) for label, at, counts, spare in rows if not spare]
    for _ in range(EPOCHS):
        for label, at, values in fit:
            learner.learn(at, values, label)
    weights = learner.weights(np.arange(BUCKETS + 1))
    spare = [(label, weights[:, at] @ weighted(counts, idf[at]) + weights[:, -1])
             for label, at, counts, held in rows if held]
    heat = temperature(np.array([x[1] for x in spare]), np.array([x[0] for x in spare], int))
    return weights[:, :-1], weights[:, -1], heat


def train(rows: DataFrame, text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Model of ``rows`` whose label is known; None if there are none."""
    known = rows.select(F.col(text).alias("text"), F.col(label).alias("lang")).where(
        F.col(text).isNotNull() & F.col(label).isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, per_language = np.zeros(BUCKETS, np.int64), {}
        for batch in batches:
            for one, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                df[features(one.as_py())[0]] += 1
                per_language[lang] = per_language.get(lang, 0) + 1
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.nulls(len(at), pa.string()), pa.array(df[at])],
                              names=["bucket", "lang", "n"])
        yield pa.record_batch([pa.nulls(len(per_language), pa.int32()), pa.array(list(per_language), pa.string()),
                               pa.array(list(per_language.values()), pa.int64())], names=["bucket", "lang", "n"])

    counted = (known.mapInArrow(frequencies, "bucket int, lang string, n bigint")
               .groupBy("bucket", "lang").agg(F.sum("n").alias("n")))
    counted = counted.limit(BUCKETS + MAX_LANGUAGES + 1).toArrow().to_pylist()  # one row for each bucket and language
    if len(counted) > BUCKETS + MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    per = {r["lang"]: r["n"] for r in counted if r["lang"] is not None}
    if not per:
        return None
    languages, n = sorted(per), sum(per.values())
    idf = np.full(BUCKETS, np.log(1 + n) + 1)
    for r in counted:
        if r["bucket"] is not None:
            idf[r["bucket"]] = np.log((1 + n) / (1 + r["n"])) + 1

    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / per[lang]))])
    draw = F.pmod(F.xxhash64(F.lit("draw"), "text"), F.lit(1 << 30))
    drawn = known.withColumn("draw", draw).where(F.col("draw") < F.element_at(share, F.col("lang")) * (1 << 30))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, n_of = features(batch.column(0)[i].as_py())
                yield pa.record_batch([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1),
                                       pa.array([at], pa.list_(pa.int32())), pa.array([n_of], pa.list_(pa.int32()))],
                                      names=["lang", "draw", "at", "counts"])

    def fit(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([("draw", "ascending"), ("lang", "ascending")])
        rows = [(languages.index(r["lang"]), np.array(r["at"], int), np.array(r["counts"]), i % 5 == 4)
                for i, r in enumerate(sample.select(["lang", "at", "counts"]).to_pylist())]
        weights, bias, heat = _fit(languages, idf, rows)
        return pa.table({"lang": languages, "weights": pa.array([x.astype(np.float32) for x in weights],
                                                               pa.list_(pa.float32())),
                         "bias": bias, "temperature": [heat] * len(languages)})

    sample = cut(drawn.select("text", "lang", "draw").mapInArrow(
        counts, "lang string, draw bigint, at array<int>, counts array<int>"), "language-sample")
    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(
        fit, "lang string, weights array<float>, bias double, temperature double").toArrow().to_pylist()
    fitted.sort(key=lambda r: r["lang"])
    return Model(languages, np.array([r["weights"] for r in fitted], np.float32),
                 np.array([r["bias"] for r in fitted]), idf, fitted[0]["temperature"])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predicted(texts: pa.Array, letters: pa.Array, model: Broadcast) -> tuple[list[str], list[float]]:
    found = [model.value.predict(t.as_py()) if ok and model.value is not None else (UNKNOWN, 0.0)
             for t, ok in zip(texts, letters.to_pylist())]
    return [x[0] for x in found], [x[1] for x in found]


def languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _predicted(batch.column(1), batch.column(2), shared)
            yield pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", has_letter(F.col("text")).alias("letters")).mapInArrow(
        read, f"doc_id {id_type}, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The documents, all columns as they are, whose language is told with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, scores = _predicted(batch.column(text), batch.column(batch.num_columns - 1), shared)
            keep = pa.array([s >= least for s in scores], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(keep)

    named = docs.select("*", has_letter(F.col("text")).alias("__letters"))
    return named.mapInArrow(read, docs.schema)
