"""The join's families: which documents are compared, whole results after several rounds, and what stays on disk."""

from __future__ import annotations

import os
import random

import pytest

from leakscope.llm import jaccard_join, line_dedup
from leakscope.sources.storage import shared_folder

SCHEMA = "doc_id bigint, text string"


def brute(texts: list[str], k: int, percent: int) -> dict[int, tuple[int, int]]:
    """Least id reached and number of links of each text."""
    def shingles(text: str) -> frozenset:
        words = text.split()
        return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))

    sets = [shingles(t) for t in texts]
    near = [[j for j in range(len(sets)) if j != i and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
            for i in range(len(sets))]
    least = list(range(len(sets)))
    while any(least[j] < least[i] for i in range(len(sets)) for j in near[i]):
        least = [min([least[i], *(least[j] for j in near[i])]) for i in range(len(sets))]
    return {i: (least[i], len(near[i])) for i in range(len(sets))}


def folders(spark) -> set[str]:
    return set(os.listdir(f"{shared_folder(spark).removeprefix('file:')}/llm"))


def test_chance_shares_connect_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", 0, raising=False)

    def phrase(i: int, j: int) -> str:
        return " ".join(f"w{min(i, j)}x{max(i, j)}y{n}" for n in range(5))

    texts = [" ".join(phrase(i, i + d) for d in (-4, -3, -2, -1, 1, 2, 3, 4)) for i in range(60)]
    compared, products = [], jaccard_join._products
    monkeypatch.setattr(jaccard_join, "_products",
                        lambda units, k, percent: compared.append(units.count()) or products(units, k, percent))
    found = jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(texts)), SCHEMA), 4, 85).collect()
    assert sum(compared) == 0
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in found) == [(i, i, 0) for i in range(60)]


@pytest.mark.parametrize(("k", "percent"), [(1, 60), (2, 85)])
def test_rounds_and_waves_lose_no_link(spark, monkeypatch, k, percent):
    monkeypatch.setattr(jaccard_join, "FEW", 0)
    rng = random.Random(k)
    texts = []
    for _ in range(30):  # few words, so that most shingles are shared by chance as well
        words = [rng.choice("abcdefghijklmnopqrst") * rng.choice((1, 2)) for _ in range(rng.choice((9, 25, 30, 60)))]
        texts.append(" ".join(words))
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            words = list(words)
            words[rng.randrange(len(words))] = f"new{rng.randrange(4)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    found = jaccard_join.jaccard_components(docs, k, percent, block_rows=12).collect()
    assert {r.doc_id: (r.component_id, r.n_links) for r in found} == brute(texts, k, percent)


def test_intermediate_tables_go(spark):
    docs = spark.createDataFrame([(i, f"a b c d e f {i % 7}\nthe second line\nthe third {i % 5}") for i in range(40)], SCHEMA)
    before = folders(spark) if os.path.isdir(f"{shared_folder(spark).removeprefix('file:')}/llm") else set()
    assert jaccard_join.jaccard_components(docs, 2, 60).count() == 40
    left = {name.rsplit("-", 1)[0] for name in folders(spark) - before}
    assert left <= {"join-classes", "join-reps", "join-links", "edges"}
    before = folders(spark)
    assert line_dedup.line_dedup(docs, with_passages=True).count() == 40
    assert {name.rsplit("-", 1)[0] for name in folders(spark) - before} == {"line-ranges"}
