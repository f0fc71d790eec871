"""Repeated passages that no chunk boundary cuts out."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from leakscope.llm import line_dedup
from leakscope.llm.queries import QUERIES


def brute_passages(rows):
    """Texts without two successive lines with text that came before, nor the chunks that did; lines removed."""
    seen, made = {}, {}
    for i, text in sorted({(i, t) for i, t in rows if t}):
        lines = text.split("\n")
        at = [k for k, line in enumerate(lines) if line.strip()]
        ranges = [(a, b + 1) for a, b in zip(at, at[1:])]
        ranges += [(a, b) for a, b, c in line_dedup.chunks(text.encode()) if sum(a <= k < b for k in at) > 1]
        gone = set()
        for a, b in sorted(ranges):
            first = seen.setdefault("\n".join(lines[a:b]), (i, text, a, b))
            if first != (i, text, a, b) and not (first[:2] == (i, text) and a < first[3]):
                gone.update(range(a, b))
        made[i, text] = "\n".join(line for k, line in enumerate(lines) if k not in gone), len(gone)
    return Counter((i, *made[i, t]) if t else (i, t, 0) for i, t in rows)


def test_passages_of_two_to_six_lines_go_whole(spark):
    rows, wanted = [], {}
    for n in range(2, 7):
        for copy in range(6):
            passage = [f"passage of {n} lines, number {k}" for k in range(n)]
            own = [[f"own {n} {copy} {side} {k * k % 7} {k}" for k in range(3)] for side in "ab"]
            rows.append((10 * n + copy, "\n".join([*own[0], *passage, *own[1]])))
            wanted[10 * n + copy] = "\n".join([*own[0], *(passage if copy == 0 else []), *own[1]])
    rows += [(100, "x\nx\nx\nx\nx"), (101, "a\n\n b\nown\na\n\n b\nend"), (102, None), (103, ""), (104, "one line")]
    wanted |= {100: "x\nx", 101: "a\n\n b\nown\nend", 102: None, 103: "", 104: "one line"}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in line_dedup.line_dedup(docs, with_passages=True).collect()}
    assert {i: r.text for i, r in found.items()} == wanted
    assert sum(r["__n_removed"] for r in found.values()) == 5 * (2 + 3 + 4 + 5 + 6) + 3 + 3


@pytest.mark.parametrize("query", ["op9_line_dedup", "pipeline"])
def test_given_documents(spark, small, query):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute_passages([(r.doc_id, r.text) for r in docs.collect()])
    if query == "pipeline":
        stage = dict(corpus_pipeline.STAGES)["lines"]
        assert Counter((r.doc_id, r.text) for r in stage(spark, docs, small).collect()) == Counter(
            {k[:2]: n for k, n in want.items()})
    else:
        found = Counter((r.doc_id, r.n_removed) for r in QUERIES[query](spark, small).collect())
        assert found == Counter({(k[0], k[2]): n for k, n in want.items()})
