"""What the lattice has to carry."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.llm import lattice_lm


def test_freed_mass_is_the_lattices(spark):
    docs = spark.createDataFrame([(0, "the cat the"), (1, "the dog cat"), (2, "unseen words"), (3, "the")],
                                 "doc_id bigint, text string")
    pieces = lattice_lm.load_pieces()
    found = {r.doc_id: r.score for r in lattice_lm.lm_scores(docs, F.col("doc_id") < 2, pieces, rounds=0).collect()}
    counts, ends = {"the": 3, "cat": 2, "dog": 1}, 2
    n, v = 8, 4
    d = max(lattice_lm.LEAST_DISCOUNT, min(0.95, 1 / (1 + 2 * 2)))

    def p(word):
        return max(counts.get(word, 0) - d, 0) / n + d * v / n * math.exp(lattice_lm.lattice([word], pieces)[0])

    end = (ends - d) / n
    assert sum(max(c - d, 0) / n for c in counts.values()) + end + d * v / n == pytest.approx(1)
    assert found[2] == pytest.approx(math.log10(p("unseen") * p("words") * end))
    assert found[3] == pytest.approx(math.log10(p("the") * end))


def test_long_words_take_part_in_the_fit(monkeypatch):
    pieces = lattice_lm.load_pieces()
    words, counts = ["日本語の文章" * 20, "thinking" * 9 + "é", "x" * 49, "the"], np.array([3, 2, 1, 5])
    found = lattice_lm.expected(words, counts, pieces)
    assert np.count_nonzero(found) > np.count_nonzero(lattice_lm.expected(words[3:], counts[3:], pieces))
    begun = found[:len(pieces.begin)].sum()
    assert begun == pytest.approx(counts.sum())
    monkeypatch.setattr(lattice_lm, "_LONG", 1000)
    assert found == pytest.approx(lattice_lm.expected(words, counts, pieces))
    monkeypatch.setattr(lattice_lm, "_LONG", 0)
    assert found == pytest.approx(lattice_lm.expected(words, counts, pieces))


def test_long_words_move_the_weights(spark):
    pieces = lattice_lm.load_pieces()
    words = spark.createDataFrame([("日本語の文章" * 20, 3), ("the", 1)], "word string, c bigint")
    fit = lattice_lm.fitted(words, pieces, rounds=1)
    assert fit.arc("日", False) is None or fit.arc("日", False) > pieces.arc("日", False)
    assert fit.arc("the", True) < math.log(0.5)
