"""Toxicity by class-conditional Kneser-Ney models of word pairs.

Each class, toxic and ordinary, has a model of a word after the word before it. A discount is taken from every count
that is not zero, and what is taken goes to the next model:

1. how often the class has the pair, of all pairs with this word before;
2. after how many different words the class has the word (its continuation count), of all the class's distinct pairs;
3. the continuation count over both classes together, the backoff that they share, of all distinct pairs;
4. one share for each known word and one for all unknown words.

The discount is ``DISCOUNT`` in 1 and 3. In 2, where a word that the class has after one other word only says little,
counts of 1, 2 and more have discounts of their own (``discounts``). Rare expressions have no limit of their own: they
live on what they share through 3 and 4. Probabilities of all words after a word, with the unknown word, add up to 1 in
each class.

A text is compared by the log-likelihood ratio of the two models, normalised by length: over the whole text after model
1, and of its strongest word after model 2 (a text with one slur in a thousand words is toxic as well). The sample is
dealt into ``PARTS`` by id; each part is held against the models of the other parts, and logistic calibration on all of
these ratios, weighted back to the classes' shares among all labels, makes a score of the two. Documents are scored by
the first of these models, so that their ratios come from as much text as the ratios calibrated on.

The models are fitted on a bounded sample of labelled documents, about ``PER_CLASS`` of each class: its ids are broadcast
and the counts of its distinct pairs come to the driver, one model after the other. All documents are scored over their
whole texts. Words are told apart by 64-bit hashes; two words with one hash would share their counts.

Null and empty texts have no expression, both ratios are 0. A document with several labels counts as toxic if one says
so; null labels are none. Without labels of both classes every score is 0. A null doc_id is in fold 0 and has no label.
Repeated rows get equal scores. Empty tables of documents give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut
from leakscope.llm.wordhash import SPACE, Words, byte_table, mix, words

PER_CLASS = 4000
PARTS = 4
DISCOUNT = 0.75
_TABLE = byte_table(SPACE)
_START = np.uint64(1)  # stands before the first word


def befores(w: Words) -> np.ndarray:
    """Hash of the word before each word."""
    before = np.empty_like(w.hash)
    before[1:] = w.hash[:-1]
    before[w.bounds[:-1][w.counts > 0]] = _START
    return before


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before) + word)


def _values(keys: np.ndarray, columns: list[np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whether each wanted key is among the sorted keys, and its value in every column (of any key if not)."""
    if not len(keys):
        return np.zeros(len(wanted), bool), [np.zeros(len(wanted)) for _ in columns]
    distinct, back = np.unique(wanted, return_inverse=True)  # sorted keys are found faster than scattered ones
    at = np.minimum(np.searchsorted(keys, distinct), len(keys) - 1)
    return (keys[at] == distinct)[back], [column[at][back] for column in columns]


@dataclass
class Model:
    """Log-likelihood ratios, toxic to ordinary, by sorted hashes."""

    word: np.ndarray  # hashes of words, and of what stands before first words
    alone: np.ndarray  # after model 2
    context: np.ndarray  # what a word before adds to a pair that neither class has
    pair: np.ndarray
    after: np.ndarray  # after model 1, of pairs that a class has
    unknown: float  # after model 2, of a word that neither class has

    def ratios(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """For every row the mean ratio of its words after the words before them, and the largest ratio of one word."""
        before = befores(w)
        known, (alone,) = _values(self.word, [self.alone], w.hash)
        alone = np.where(known, alone, self.unknown)
        known, (context,) = _values(self.word, [self.context], before)
        backed_off = np.where(known, context, 0.0) + alone
        known, (after,) = _values(self.pair, [self.after], pair_keys(before, w.hash))
        mean = np.bincount(w.row, np.where(known, after, backed_off), w.n_rows) / np.maximum(w.counts, 1)
        best = np.full(w.n_rows, -np.inf)
        np.maximum.at(best, w.row, alone)
        return mean, np.where(w.counts > 0, best, 0.0)


def _pair_counts(sample: DataFrame) -> DataFrame:
    """(before, word, ordinary_0, toxic_0, ordinary_1, ...): how often each pair is in each part of each class."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(1).to_numpy(zero_copy_only=False)
            for w in words(batch.column(0), _TABLE):
                before, of = befores(w), group[w.first + w.row]
                keys = pair_keys(before, w.hash) + of.astype(np.uint64)
                _, at, n = np.unique(keys, return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(before[at].view(np.int64)), pa.array(w.hash[at].view(np.int64)),
                                       pa.array(of[at], pa.int32()), pa.array(n, pa.int64())],
                                      names=["before", "word", "of", "n"])

    counted = (sample.select("text", (F.col("part") * 2 + F.col("toxic")).cast("int").alias("of"))
               .mapInArrow(read, "before bigint, word bigint, of int, n bigint"))
    return counted.groupBy("before", "word").agg(
        *[F.sum(F.when(F.col("of") == 2 * part + c, F.col("n")).otherwise(0)).alias(f"{name}_{part}")
          for part in range(PARTS) for c, name in enumerate(("ordinary", "toxic"))])


def discounts(counts: np.ndarray) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and from 3 on, by how many counts are 1, 2, 3 and 4.

    The estimate is that of modified Kneser-Ney smoothing; with few counts it is held between a tenth of the count and
    nearly all of it.
    """
    n = np.array([np.count_nonzero(counts == i) + 0.5 for i in range(5)])
    once = n[1] / (n[1] + 2 * n[2])
    return np.array([0.0, *[np.clip(i - (i + 1) * once * n[i + 1] / n[i], 0.1 * i, 0.98 * i) for i in (1, 2, 3)]])


def kneser_ney(before: np.ndarray, word: np.ndarray, counts: tuple[np.ndarray, np.ndarray]) -> Model:
    """Ratios of distinct pairs (hashes of the word before and of the word), with each class's count of the pair."""
    befores_, words_ = np.unique(before), np.unique(word)
    before_at = np.searchsorted(befores_, before).astype(np.int32)
    word_at = np.searchsorted(words_, word).astype(np.int32)
    n_pairs, n_words = max(len(word), 1), len(words_)
    left = DISCOUNT * n_words / n_pairs if n_words else 1.0
    nothing = left / (n_words + 1)
    shared = np.maximum(np.bincount(word_at, minlength=n_words) - DISCOUNT, 0) / n_pairs + nothing
    alone, unknown, context, after = [], [], [], np.zeros(len(word))
    for sign, count in zip((-1, 1), counts):
        has = (count > 0).astype(np.float32)
        kinds = np.bincount(word_at, has, n_words)
        distinct = np.count_nonzero(has)
        taken = discounts(kinds)[np.minimum(kinds, 3).astype(int)]
        freed = taken.sum() / distinct if distinct else 1.0
        of_word = (kinds - taken) / max(distinct, 1) + freed * shared
        seen = np.bincount(before_at, count, len(befores_))
        rest = np.where(seen > 0, DISCOUNT * np.bincount(before_at, has, len(befores_)) / np.maximum(seen, 1), 1.0)
        alone.append(np.log(of_word))
        unknown.append(np.log(freed * nothing))
        context.append(np.log(rest))
        p = np.maximum(count - DISCOUNT, 0) / np.maximum(seen, 1)[before_at]
        p += rest[before_at] * of_word[word_at]
        after += sign * np.log(p)
    every = np.union1d(befores_, words_)
    in_every = [np.zeros(len(every)), np.zeros(len(every))]
    in_every[0][:] = unknown[1] - unknown[0]
    in_every[0][np.searchsorted(every, words_)] = alone[1] - alone[0]
    in_every[1][np.searchsorted(every, befores_)] = context[1] - context[0]
    pairs = pair_keys(before, word)
    order = np.argsort(pairs)
    return Model(every, *in_every, pairs[order], after.astype(np.float32)[order], float(unknown[1] - unknown[0]))


def _model(counted: DataFrame, part: int) -> Model:
    """The model of all parts but one; as many rows come to the driver as the sample has distinct pairs."""
    others = [p for p in range(PARTS) if p != part]
    sums = [sum((F.col(f"{name}_{p}") for p in others), F.lit(0)).cast("int").alias(name)
            for name in ("ordinary", "toxic")]
    rows = counted.select("before", "word", *sums).where("ordinary + toxic > 0").toArrow()
    hashes = [rows[c].to_numpy().view(np.uint64) for c in ("before", "word")]
    counts = tuple(rows[c].to_numpy() for c in ("ordinary", "toxic"))
    del rows
    model = kneser_ney(*hashes, counts)
    del hashes, counts
    pa.default_memory_pool().release_unused()  # the driver goes on with the model alone
    return model


def _ratios(docs: DataFrame, model, *carry: str) -> DataFrame:
    """``carry`` columns, mean and best of every document, by a model that was broadcast."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.ratios(w) for w in words(batch.column(0), _TABLE)]
            mean, best = (np.concatenate([f[i] for f in found] or [np.zeros(0)]) for i in (0, 1))
            yield pa.record_batch([*batch.columns[1:], pa.array(mean), pa.array(best)],
                                  names=[*batch.schema.names[1:], "mean", "best"])

    given = docs.select("text", *carry)
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in given.schema.fields[1:])
    return given.mapInArrow(read, fields + "mean double, best double")


def calibrate(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights (mean, best, 1) of a logistic score, by penalised Newton steps on Platt's smoothed targets."""
    x = np.column_stack((x, np.ones(len(x))))
    target = np.where(toxic == 1, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((toxic == 0).sum() + 2))
    ridge = np.diag([1.0, 0.01, 0.001])  # the mean has small values and little to say
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + ridge @ w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return w


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id and score of every document, learned from ``labels(doc_id, toxic)`` and these documents' texts."""
    context = docs.sparkSession.sparkContext
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n_of = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if not (n_of.get(0) and n_of.get(1)):
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    share = [min(1.0, per_class / n_of[c]) for c in (0, 1)]
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "labelled"), F.lit(1 << 30))
    drawn = known.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 30))
    drawn = drawn.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "labelled"), F.lit(PARTS)).cast("int"))
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled"))
                 .select("text", "toxic", "part"), "toxic-sample")  # about 2 * per_class ids are broadcast
    counted = cut(_pair_counts(sample), "toxic-counts")
    x, y = [], []
    for part in reversed(range(PARTS)):
        shared = context.broadcast(_model(counted, part))
        held = _ratios(sample.where(F.col("part") == part), shared, "toxic").toArrow()
        x.append(np.column_stack((held["mean"], held["best"])))
        y.append(held["toxic"].to_numpy())
        if part:
            shared.destroy()
    x, y = np.concatenate(x), np.concatenate(y)
    w = calibrate(x, y, np.where(y == 1, 1 / share[1], 1 / share[0]))
    logit = F.col("mean") * float(w[0]) + F.col("best") * float(w[1]) + float(w[2])
    return _ratios(docs, shared, "doc_id").select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))
