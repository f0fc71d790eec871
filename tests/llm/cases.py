"""Small documents with nulls, empty and long texts, ties, repeated rows and columns of clashing names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_hit int, component_id string, "
          "cls string, key string, ahead double")
WORDS = "the of and to in is was for on that by this with from or are an be not have".split()


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)

    def line(length: int) -> str:
        return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "er", "ing"]) for _ in range(length))

    base = ["\n".join(line(rng.randint(3, 14)) for _ in range(rng.randint(1, 9))) for _ in range(n)]
    shared = "\n".join(line(8) for _ in range(9))
    out: list[str | None] = [None, "", "   \n\t ", "one", "One two", "ünïcode Ünïcode 日本語 文字", "a" * 300, "123 | 456"]
    for text in base:
        out.append(text)
        if rng.random() < 0.4:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            out.append(" ".join(words))
        if rng.random() < 0.2:
            out.append(text)
        if rng.random() < 0.3:
            out.append(line(6) + "\n" + shared + "\n" + line(5))
    out.append(" ".join(base))
    return out


def documents(spark, seed: int = 1, n: int = 60):
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s0"][i % 4], len(t or ""), 1, "x", "y", "z", 0.5)
            for i, t in enumerate(texts(seed, n))]
    rows += [rows[12], rows[12]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def without_rows(docs):
    return docs.where("doc_id < -5")


def with_null_id(spark, docs):
    row = (None, "a text without an id but with words", "en", "s1", 5, 1, "x", "y", "z", 0.5)
    return docs.unionByName(spark.createDataFrame([row], docs.schema))
