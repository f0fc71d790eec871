"""The class models of operator 7 against plain Python, and how its scores follow labels."""

from __future__ import annotations

from collections import Counter, defaultdict
from math import log

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leakscope.llm import toxicity
from leakscope.llm.common import table
from leakscope.llm.queries import op7_toxicity
from leakscope.llm.wordhash import words

TEXTS = [("you are a fool and a fool", 1), ("What a FOOL", 1), ("a\x00b fool\tyou", 1), ("you are kind", 0),
         ("a kind word and a kind deed", 0), ("words and deeds", 0), ("", 0), (None, 1), ("kind", 0)]
NEW = ["you are a fool", "kind fool deeds", "never seen", "never a word and", "FOOL", "", None, "a\x00b kind"]


def split(text):
    return ("".join(c.lower() if c.isascii() else c for c in text or "")).split()


class Plain:
    """One class's model by its definition, over lists of words."""

    def __init__(self, own, every, discount=toxicity.DISCOUNT):
        self.d = discount
        self.pairs, self.after, self.kinds, self.shared = Counter(), defaultdict(set), defaultdict(set), defaultdict(set)
        for before, word in every:
            self.shared[word].add(before)
        for before, word in own:
            self.pairs[before, word] += 1
            self.after[before].add(word)
            self.kinds[word].add(before)
        self.n_shared = sum(map(len, self.shared.values()))
        self.n_kinds = sum(map(len, self.kinds.values()))
        of = Counter(map(len, self.kinds.values()))
        once = (of[1] + 0.5) / (of[1] + 0.5 + 2 * (of[2] + 0.5))
        self.taken = {0: 0}
        for i in (1, 2, 3):
            estimate = i - (i + 1) * once * (of[i + 1] + 0.5) / (of[i] + 0.5)
            self.taken[i] = min(max(estimate, i / 10), 0.98 * i)

    def shared_word(self, word):
        n = len(self.shared.get(word, ()))
        return max(n - self.d, 0) / self.n_shared + self.d * len(self.shared) / self.n_shared / (len(self.shared) + 1)

    def word(self, word):
        n = len(self.kinds.get(word, ()))
        freed = sum(self.taken[min(len(b), 3)] for b in self.kinds.values()) / self.n_kinds
        return (n - self.taken[min(n, 3)]) / self.n_kinds + freed * self.shared_word(word)

    def follows(self, before, word):
        seen = sum(n for (b, _), n in self.pairs.items() if b == before)
        if not seen:
            return self.word(word)
        rest = self.d * len(self.after[before]) / seen
        return max(self.pairs[before, word] - self.d, 0) / seen + rest * self.word(word)


def pairs_of(text):
    own = split(text)
    return list(zip(["\n", *own], own))


@pytest.fixture(scope="module")
def plain():
    every = [p for text, _ in TEXTS for p in pairs_of(text)]
    return [Plain([p for text, c in TEXTS if c == own for p in pairs_of(text)], every) for own in (0, 1)]


def test_probabilities_add_up(plain):
    known = sorted(plain[0].shared)
    for model in plain:
        for before in ["\n", "never", *known]:
            assert sum(model.follows(before, w) for w in [*known, "never"]) == pytest.approx(1)


def test_model_equals_plain_python(spark, plain):
    rows = [(text, c, i % toxicity.PARTS) for i, (text, c) in enumerate(TEXTS * 2) if i < len(TEXTS)]
    counted = toxicity._pair_counts(spark.createDataFrame(rows, "text string, toxic int, part int"))
    found = counted.toArrow()
    counts = [sum(found[f"{name}_{p}"].to_numpy() for p in range(toxicity.PARTS)) for name in ("ordinary", "toxic")]
    model = toxicity.kneser_ney(found["before"].to_numpy().view(np.uint64), found["word"].to_numpy().view(np.uint64),
                                tuple(counts))
    given = [text for text, _ in TEXTS] + NEW
    got = [model.ratios(w) for w in words(pa.array(given), toxicity._TABLE, limit=20)]
    mean, best = (np.concatenate([g[i] for g in got]) for i in (0, 1))
    for i, text in enumerate(given):
        own = pairs_of(text)
        ratios = [log(plain[1].follows(*p) / plain[0].follows(*p)) for p in own]
        assert mean[i] == pytest.approx(sum(ratios) / max(len(own), 1), abs=1e-6)
        assert best[i] == pytest.approx(
            max((log(plain[1].word(w) / plain[0].word(w)) for _, w in own), default=0), abs=1e-9)


def test_one_class_or_no_words_in_a_part(spark):
    docs = spark.createDataFrame([(1, "fool", "x"), (2, "kind", "y"), (3, "", None), (None, None, None)],
                                 "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    found = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert set(found) == {1, 2, 3, None} and all(0 <= s <= 1 for s in found.values()) and found[3] == found[None]
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0
    empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    assert len({r.score for r in toxicity.toxicity(empty, labels).collect()}) == 1


def test_held_out_accuracy(spark, small):
    small = small.replace("sf0.001", "sf0.01")  # sf0.001 has five toxic documents to judge by
    labels = table(spark, small, "labels").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = op7_toxicity(spark, small).where("held_out").join(labels, "doc_id").select("score", "toxic").collect()
    toxic, ordinary = ([r.score for r in rows if r.toxic == c] for c in (1, 0))
    wins = sum((t > o) + (t == o) / 2 for t in toxic for o in ordinary)
    assert wins / (len(toxic) * len(ordinary)) > 0.8
    assert max(toxic) >= 0.7 > max(ordinary)
