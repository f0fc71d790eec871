"""The whole pipeline against plain Python, with the accepted languages as given."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pyarrow as pa

import corpus_pipeline
from leakscope.llm.oracles import SQL
from tests.llm.test_operators import SPACE, low
from tests.llm.test_passages import brute_passages


def brute_near(rows):
    """Documents with the least id of their group."""
    shingles = {}
    for i, text, _ in rows:
        words = SPACE.findall(low(text))
        shingles[i] = {tuple(words[a:a + 5]) for a in range(max(1, len(words) - 4))} if words else set()
    leader = {i: i for i in shingles}

    def find(i):
        while leader[i] != i:
            i = leader[i]
        return i

    ids = sorted(shingles)
    for at, i in enumerate(ids):
        for j in ids[:at]:
            both = len(shingles[i] & shingles[j])
            if both and 100 * both >= 80 * (len(shingles[i]) + len(shingles[j]) - both):
                a, b = sorted((find(i), find(j)))
                leader[b] = a
    return [r for r in rows if find(r[0]) == r[0]]


def brute_clean(rows, items):
    """Documents without ten words in a row, or a whole shorter item, of the benchmark."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))

    windows = set()
    for item in map(words, items):
        n = min(len(item), 10)
        windows |= {tuple(item[a:a + n]) for a in range(len(item) - n + 1)} if n else set()
    sizes = {len(w) for w in windows}
    return [r for r in rows for w in [words(r[1])]
            if not any(tuple(w[a:a + n]) in windows for n in sizes for a in range(len(w) - n + 1))]


def test_run(spark, small, monkeypatch):
    first = corpus_pipeline.cut(
        corpus_pipeline.known_language(spark, spark.read.parquet(f"{small}/documents.parquet"), small), "given")
    monkeypatch.setattr(corpus_pipeline, "STAGES",
                        [(corpus_pipeline.STAGES[0][0], lambda *_: first), *corpus_pipeline.STAGES[1:]])
    given = [(r.doc_id, r.text, r.source) for r in first.collect()]
    source = {i: s for i, _, s in given}
    assert len(source) == len(given)
    lines = [(i, text, source[i]) for i, text, _ in brute_passages([r[:2] for r in given])]
    near = brute_near(lines)
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = brute_clean(near, items)
    assert len(given) > len(near) > len(clean) > 0
    documents = pa.table({name: pa.array(column, kind) for name, column, kind in zip(
        ("doc_id", "text", "source"), zip(*clean), (pa.int64(), pa.string(), pa.string()))})
    duck = duckdb.connect()
    duck.register("documents", documents)
    want = duck.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({SQL['op5_source_mix']})").fetchall()
    found = corpus_pipeline.run(spark, small).select("doc_id", "size", "source_size", "target", "taken")
    assert Counter(map(tuple, found.collect())) == Counter(want)
