"""Language-model scores from a subword lattice over a public vocabulary and the corpus' word counts.

A word is spelled by one piece that begins words and any number that continue them; byte pieces spell what no piece
does. The vocabulary's own scores weight the pieces at first: as log probabilities if it is a unigram one, else by
rank, as one over rank plus a constant. ``ROUNDS`` of expectation maximisation over the counts of all training words
then fit these weights to the corpus; the pieces stay the vocabulary's. A word's lattice probability is the sum over all its segmentations, by a forward recursion in log
space. One more arc spans a seen word whole, its discounted count; all that the discounts free goes to the lattice:

    P(word) = max(c - D, 0) / N + D * V / N * lattice(word)

with training counts c, all N tokens, V distinct ones and D from the numbers of words seen once and twice. So P sums to
at most 1 over all words, seen or not. The base gives every unseen word U = 0.5 / (N + 0.5 * (V + 1)), however many
there are. The end of a text is a token without a spelling. The log probability of a document, marginal over all segmentations, is the sum over its tokens, as its
lattice falls apart at the white space.

Scores of the ``FREQUENT`` most frequent words go to the tasks as a table, all rarer words are joined with the table of
all words, so both cover everything. Null counts as empty: one token, the end. Without training documents the
vocabulary's weights stay as they are. Repeated rows are scored each and counted each; a null doc_id is in fold 0. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 1 << 17
BYTES_SHARE = 0.01
ROUNDS = 3
LEAST_DISCOUNT = 0.55  # so that something is left for the lattice
_MARK = "▁"
_LONG = 48  # code points; longer words are spelled one by one
_FLUSH = 1 << 18
_TINY = -1e300
_SLOT_BITS = 20
_TOGETHER = 1 << 12  # words


@dataclass
class Pieces:
    """Pieces that begin words, without their mark, then those that continue them, then bytes as one; log weights."""

    begin: list[str]
    inner: list[str]
    log: np.ndarray

    def __post_init__(self):
        self.logs = self.log.tolist()
        self.longest = max(map(len, [*self.begin, *self.inner, "."]))
        self.tables = [_hash_table(self.begin, 0), _hash_table(self.inner, len(self.begin))]
        self.names = [{p: i for i, p in enumerate(self.begin)},
                      {p: i + len(self.begin) for i, p in enumerate(self.inner)}]

    def arc(self, piece: str, begins: bool) -> float | None:
        at = self.names[0 if begins else 1].get(piece)
        return None if at is None else float(self.log[at])


def load_pieces(path: str = VOCABULARY) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    scores = {p: s for p, s in scores.items() if p and _MARK not in p[1:]}
    ranked = sorted(scores, key=lambda p: (-scores[p], p))
    is_log = 0.5 < sum(np.exp(s) for s in scores.values()) < 2  # a unigram vocabulary's scores
    weight = {p: np.exp(scores[p]) if is_log else 1 / (rank + 2.7) for rank, p in enumerate(ranked)}
    weight.setdefault(_MARK, 1e-6 * sum(weight.values()))
    begin, inner = [p for p in weight if p[0] == _MARK], [p for p in weight if p[0] != _MARK]
    mass = np.array([weight[p] for p in [*begin, *inner]])
    log = np.log(np.append(mass / mass.sum() * (1 - BYTES_SHARE), BYTES_SHARE / 256))
    return Pieces([p[1:] for p in begin], inner, log)


def _step(state: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hash of a string by one more code point."""
    x = (state ^ (points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hash_table(names: list[str], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the pieces, their numbers, and whether any piece may begin with a string, by its hash's slot."""
    keys, may_begin = np.zeros(len(names), np.uint64), np.zeros(1 << _SLOT_BITS, bool)
    lengths = np.array([len(name) for name in names])
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        points = np.frombuffer("".join([names[i] for i in at]).encode("utf-32-le"), np.uint32).reshape(len(at), n)
        state = np.zeros(len(at), np.uint64)
        for j in range(n):
            state = _step(state, points[:, j])
            may_begin[_slot(state)] = True
        keys[at] = state
    order = np.argsort(keys)
    return keys[order], order + first, may_begin


def _slot(state: np.ndarray) -> np.ndarray:
    return state >> np.uint64(64 - _SLOT_BITS)


def _n_bytes(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)


def _arcs(points: np.ndarray, pieces: Pieces) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """From, to, rows of the words with such a piece, their pieces and log weights, for words of one length, the rows of
    ``points``. From -1 begins the word. Bytes are the arcs of one code point from the list's end."""
    n_words, n = points.shape
    points = np.ascontiguousarray(points.T)
    every, found = np.arange(n_words), []
    for i in range(-1, n):
        keys, numbers, may_begin = pieces.tables[0 if i < 0 else 1]
        rows, state, begin = every, np.zeros(n_words, np.uint64), max(i, 0)
        if i >= 0:
            found.append((i, i + 1, every, np.full(n_words, len(pieces.log) - 1),
                          pieces.log[-1] * _n_bytes(points[i])))
        for j in range(begin + 1, min(n, begin + pieces.longest) + 1):
            state = _step(state, points[j - 1][rows])
            alive = may_begin[_slot(state)]
            rows, state = rows[alive], state[alive]
            if not len(rows):
                break
            at = np.minimum(np.searchsorted(keys, state), len(keys) - 1)
            hit = keys[at] == state
            if hit.any():
                number = numbers[at[hit]]
                found.append((i, j, rows[hit], number, pieces.log[number]))
    return found


def _forward(n_words: int, n: int, arcs: list, pieces: Pieces) -> np.ndarray:
    alpha = np.full((n + 1, n_words), _TINY)
    alpha[0] = pieces.arc("", True)
    for i, j, rows, _, score in arcs:
        alpha[j, rows] = np.logaddexp(alpha[j, rows], score if i < 0 else alpha[i, rows] + score)
    return alpha


def forward_one(word: str, pieces: Pieces) -> float:
    """Log probability of one word, in time proportional to its length."""
    alpha = [pieces.arc("", True)] + [_TINY] * len(word)
    for j in range(1, min(len(word), pieces.longest) + 1):
        if (score := pieces.arc(word[:j], True)) is not None:
            alpha[j] = score
    byte = float(pieces.log[-1])
    for j in range(1, len(word) + 1):
        arcs = [alpha[j], alpha[j - 1] + byte * int(_n_bytes(np.array(ord(word[j - 1]))))]
        for i in range(max(0, j - pieces.longest), j):
            if (score := pieces.arc(word[i:j], False)) is not None:
                arcs.append(alpha[i] + score)
        top = max(arcs)
        alpha[j] = top + float(np.log(sum(np.exp(a - top) for a in arcs)))
    return alpha[-1]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Places and code points of the words of each length that is not too long, some thousand at a time."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths[lengths <= _LONG]).tolist():
        every = np.flatnonzero(lengths == n)
        for first in range(0, len(every), _TOGETHER):
            at = every[first:first + _TOGETHER]
            joined = "".join([words[i] for i in at]).encode("utf-32-le")
            yield at, n, np.frombuffer(joined, np.uint32).reshape(len(at), n)


def lattice(words: list[str], pieces: Pieces) -> np.ndarray:
    """Log probability of every word."""
    found = np.zeros(len(words))
    for at, n, points in _by_length(words):
        found[at] = _forward(len(at), n, _arcs(points, pieces), pieces)[n]
    for i, word in enumerate(words):
        if len(word) > _LONG:
            found[i] = forward_one(word, pieces)
    return found


def expected(words: list[str], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """How often each piece is expected in the words, by their counts."""
    total = np.zeros(len(pieces.log))
    mark = pieces.names[0][""]
    for at, n, points in _by_length(words):
        arcs, weight = _arcs(points, pieces), counts[at].astype(float)
        alpha = _forward(len(at), n, arcs, pieces)
        beta = np.full((n + 1, len(at)), _TINY)
        beta[n] = 0
        numbers, shares = [], []
        for i, j, rows, number, score in reversed(arcs):
            ahead = score + beta[j, rows]
            share = np.exp(np.minimum((0 if i < 0 else alpha[i, rows]) + ahead - alpha[n, rows], 0)) * weight[rows]
            if number[0] == len(total) - 1:
                share = share * _n_bytes(points[:, i])
            numbers.append(number)
            shares.append(share)
            if i >= 0:
                beta[i, rows] = np.logaddexp(beta[i, rows], ahead)
        total += np.bincount(np.concatenate(numbers), np.concatenate(shares), len(total))
        total[mark] += (np.exp(np.minimum(alpha[0] + beta[0] - alpha[n], 0)) * weight).sum()
    for i, word in enumerate(words):
        if len(word) > _LONG:
            _add_expected(total, word, float(counts[i]), pieces)
    return total


def _arcs_to(word: str, j: int, pieces: Pieces, log: list[float]) -> Iterator[tuple[int, int, float, int]]:
    """From, piece, log weight and number of pieces of every arc that ends before code point ``j``; see ``_arcs``."""
    begin, inner = pieces.names
    if j <= pieces.longest and (number := begin.get(word[:j])) is not None:
        yield -1, number, log[number], 1
    n_bytes = len(word[j - 1].encode("utf-8", "surrogatepass"))
    yield j - 1, len(log) - 1, log[-1] * n_bytes, n_bytes
    for i in range(max(0, j - pieces.longest), j):
        if (number := inner.get(word[i:j])) is not None:
            yield i, number, log[number], 1


def _log_add(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log1p(math.exp(min(a, b) - top))


def _add_expected(total: np.ndarray, word: str, count: float, pieces: Pieces) -> None:
    """Adds what ``expected`` gives for one word, in time and memory proportional to its length."""
    n, mark, log = len(word), pieces.names[0][""], pieces.logs
    alpha, beta = array("d", [_TINY]) * (n + 1), array("d", [_TINY]) * (n + 1)
    alpha[0], beta[n] = log[mark], 0.0
    for j in range(1, n + 1):
        for i, _, score, _ in _arcs_to(word, j, pieces, log):
            alpha[j] = _log_add(alpha[j], score if i < 0 else alpha[i] + score)
    for j in range(n, 0, -1):
        for i, number, score, times in _arcs_to(word, j, pieces, log):
            ahead = score + beta[j]
            total[number] += math.exp(min((0 if i < 0 else alpha[i]) + ahead - alpha[n], 0)) * count * times
            if i >= 0:
                beta[i] = _log_add(beta[i], ahead)
    total[mark] += math.exp(min(alpha[0] + beta[0] - alpha[n], 0)) * count


def fitted(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """The pieces with weights that ``rounds`` of expectation maximisation over ``words(word, c)`` give them; the
    weights before count like one more piece in a thousand, so none becomes 0."""
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(pieces)

        def read(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value.log))
            for batch in batches:
                total += expected(batch.column(0).to_pylist(), batch.column(1).to_numpy(), shared.value)
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "n"])

        sums = (words.where("c > 0").select("word", "c").mapInArrow(read, "piece int, n double")
                .groupBy("piece").agg(F.sum("n").alias("n")).toArrow())  # one row for each piece
        total = np.zeros(len(pieces.log))
        total[sums["piece"].to_numpy()] = sums["n"].to_numpy()
        if not total.sum():
            return pieces
        before = np.exp(pieces.log)
        before[-1] *= 256
        mass = total / total.sum() * 0.999 + before * 0.001
        mass[-1] /= 256
        pieces = Pieces(pieces.begin, pieces.inner, np.log(mass))
    return pieces


def _words(text: pa.Scalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().lower().split() if text.is_valid else []


def word_counts(docs: DataFrame, learned: Column) -> DataFrame:
    """(word, c, uses): counts of every word in the documents to learn from, and in all."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, rest = Counter(), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            for counted, learn in (trained, 1), (rest, 0):
                uses = np.fromiter(counted.values(), np.int64, len(counted))
                yield pa.record_batch([pa.array(list(counted), pa.binary()).cast(pa.string()),
                                       pa.array(uses * learn), pa.array(uses)], names=["word", "c", "uses"])
                counted.clear()

        for batch in batches:
            for text, learn in zip(batch.column(0), batch.column(1).to_pylist()):
                (trained if learn else rest).update(_words(text))
                if len(trained) + len(rest) > _FLUSH:
                    yield from flush()
        yield from flush()

    return (docs.select("text", learned.alias("learned")).mapInArrow(read, "word string, c bigint, uses bigint")
            .groupBy("word").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses")))


def _with_lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = lattice(batch.column(0).to_pylist(), shared.value)
            yield pa.record_batch([*batch.columns, pa.array(logs)], names=[*batch.schema.names, "lattice"])

    return words.mapInArrow(read, "word string, c bigint, uses bigint, lattice double")


def lm_scores(docs: DataFrame, learned: Column, pieces: Pieces, frequent: int = FREQUENT,
              rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every document."""
    counted = cut(word_counts(docs, learned), "word-counts")
    words = cut(_with_lattice(counted, fitted(counted, pieces, rounds)), "words")
    ends = docs.where(learned).count()
    seen = words.agg(F.sum("c"), *[F.count_if(F.expr(x)) for x in ("c > 0", "c = 1", "c = 2")]).first()
    n, v = (seen[0] or 0) + ends, seen[1] + (ends > 0)
    once, twice = seen[2] + (ends == 1), seen[3] + (ends == 2)
    discount = max(LEAST_DISCOUNT, min(0.95, once / (once + 2 * twice))) if once else LEAST_DISCOUNT
    unknown = 0.5 / (n + 0.5 * (v + 1))
    c = F.col("c")
    base = F.log10((c + 0.5) * (2 * unknown))
    if n:
        whole = F.when(c > 0, F.log((c - discount) / float(n))).otherwise(F.lit(_TINY))
        spelled = F.col("lattice") + float(np.log(discount * v / n))
        end_score = float(np.log10((ends - discount) / n))  # ends > 0, as each document that counts has one
    else:
        whole, spelled, end_score = F.lit(_TINY), F.col("lattice") + float(np.log(0.5)), float(np.log10(0.5))
    # The sum of both ways in log space, as the lattice's part may be far below the smallest double.
    top = F.greatest(whole, spelled)
    score = top + F.log(F.exp(whole - top) + F.exp(spelled - top))
    scored = words.select("word", "uses", (c > 0).cast("bigint").alias("known"), base.alias("base"),
                          (score / F.lit(float(np.log(10)))).alias("score"))
    common = scored.orderBy(F.desc("uses"), "word").limit(frequent).toArrow()
    places = {word.encode(): i for i, word in enumerate(common["word"].to_pylist())}
    shared = docs.sparkSession.sparkContext.broadcast(
        (places, *[common[name].to_numpy() for name in ("known", "base", "score")]))
    end_base = float(np.log10((ends + 0.5) * 2 * unknown))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, known, base, score = shared.value
        key = TaskContext.get().partitionId() << 40
        names = ["key", "doc_id", "n_tokens", "n_known", "base", "score", "rare"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                 pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = [[] for _ in kinds]
                part = batch.slice(first, 256)
                for text in part.column(1):
                    tokens = _words(text)
                    at = np.fromiter(map(places.get, tokens, repeat(-1)), np.int64, len(tokens))
                    rare = Counter([tokens[i] for i in np.flatnonzero(at < 0)])
                    at = at[at >= 0]
                    for column, value in zip(rows, (
                            key, len(tokens) + 1, int(ends > 0) + int(known[at].sum()),
                            end_base + float(base[at].sum()), end_score + float(score[at].sum()),
                            [{"word": word.decode(), "n": times} for word, times in rare.items()])):
                        column.append(value)
                    key += 1
                arrays = [pa.array(column, kind) for column, kind in zip(rows, kinds)]
                yield pa.record_batch([arrays[0], part.column(0), *arrays[1:]], names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.select("doc_id", "text").mapInArrow(
        read, f"key bigint, doc_id {id_type}, n_tokens bigint, n_known bigint, base double, score double, "
              "rare array<struct<word:string,n:bigint>>"), "lm-rows")
    of_word = scored.select("word", "known", F.col("base").alias("word_base"), F.col("score").alias("word_score"))
    rare = rows.select(F.col("key").alias("rare_key"), F.inline("rare")).join(of_word, "word")
    added = rare.groupBy("rare_key").agg(F.sum(F.col("known") * F.col("n")).alias("more_known"),
                                         F.sum(F.col("word_base") * F.col("n")).alias("more_base"),
                                         F.sum(F.col("word_score") * F.col("n")).alias("more_score"))
    both = rows.drop("rare").join(added, F.col("key") == F.col("rare_key"), "left")

    def plus(name: str) -> Column:
        return F.col(name) + F.coalesce(F.col("more_" + name.removeprefix("n_")), F.lit(0))

    return both.select("doc_id", "n_tokens", plus("n_known").alias("n_known"),
                       F.lit(n).cast("bigint").alias("train_tokens"), plus("base").alias("base_score"),
                       plus("score").alias("score"))
