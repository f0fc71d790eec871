"""Operators against brute force, round trips and held-out accuracy, with awkward rows in every table."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import difference
from leakscope.llm import (
    chat_format, decontamination, jaccard_join, language_id, lattice_lm, line_dedup, mixing, order_minhash, pseudonyms,
    toxicity,
)
from leakscope.llm.common import fold
from leakscope.llm.components import components
from leakscope.llm.queries import ORACLES, QUERIES
from tests.llm.cases import documents, with_null_id, without_rows

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, small, name):
    assert difference(spark, duck, small, name) is None


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))


# Words shared by several operators.

def test_a_nul_is_part_of_a_word(spark):
    texts = ["a\0b c d e f", "a b c d e f", "a\0b c d e f"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, 4, 30).collect()}
    assert found == {0: (2, 0), 1: (3, 1), 2: (2, 0)} or found == {0: (2, 0), 1: (3, 0), 2: (2, 0)}
    assert found[0][0] == 2 and jaccard_join.jaccard_components(docs, 4, 85).where("doc_id = 1").first()[2] == 1


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    from leakscope.llm.wordhash import NOT_ALNUM, SPACE as BLANK, byte_table, words

    texts = ["The the  THE", None, "", " a\tb\n", "x" * 5000, "x" * 5001, "é-é", "tail"]
    for separators, pattern in ((BLANK, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        expected = [re.findall(pattern, low(t)) for t in texts]
        for limit in (1, 1 << 20):
            names = {}
            for w in words(pa.array(texts), byte_table(separators), limit):
                for i in range(w.n_rows):
                    own = w.hash[w.bounds[i]:w.bounds[i + 1]].tolist()
                    assert len(own) == len(expected[w.first + i])
                    for h, word in zip(own, expected[w.first + i]):
                        assert names.setdefault(h, word) == word
            assert len(names) == len({x for e in expected for x in e})


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 1 language ID

def test_language_id(spark, small):
    found = QUERIES["op1_language_id"](spark, small).join(
        spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() > 0.95 * held.count()
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_id_edges(spark, docs):
    model = language_id.train(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = {r.doc_id: r for r in language_id.languages(with_null_id(spark, docs), model).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and found[7].lang_pred == "und"
    assert found[3].lang_pred in ("en", "fr") and None in found
    assert language_id.train(without_rows(docs)) is None
    assert {r.lang_pred for r in language_id.languages(docs, None).collect()} == {"und"}
    kept = language_id.accepted(docs, model)
    assert kept.schema == docs.schema and kept.where("doc_id < 3").count() == 0
    assert language_id.accepted(without_rows(docs), model).count() == 0


# 2 order MinHash

def test_order_minhash(spark, docs):
    found = order_minhash.edit_likeness(with_null_id(spark, docs)).collect()
    texts = sorted([(-1 if r.doc_id is None else r.doc_id, r.text or "")
                    for r in with_null_id(spark, docs).select("doc_id", "text").collect()])
    ids = sorted({i for i, _ in texts})
    least = {i: min(t for j, t in texts if j == i) for i in ids}
    after = dict(zip(ids, ids[1:] + ids[:1]))
    seen, by_text = Counter(), {}
    for r in found:
        own = -1 if r.doc_id is None else r.doc_id
        text = least[own]
        q = len(text) // 4
        edited = text[:len(text) - q] + least[after[own]][:q]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        seen[own] += 1
    assert seen == Counter(i for i, _ in texts)
    assert order_minhash.edit_likeness(without_rows(docs)).count() == 0


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    near = words[:390] + [f"x{i}" for i in range(10)]
    frame = spark.createDataFrame([(" ".join(words), " ".join(words), 0), (" ".join(words), " ".join(moved), 1),
                                   (" ".join(words), " ".join(near), 2)], "a string, b string, i int")
    like = {r.i: r.x for r in frame.select("i", order_minhash.likeness(
        order_minhash.fingerprint(F.col("a")), order_minhash.fingerprint(F.col("b"))).alias("x")).collect()}
    assert like[0] == 1 and like[1] < 0.75 < like[2]


# 3 n-gram Jaccard join

@pytest.mark.parametrize("k, percent, rows_in_block", [(4, 85, 256), (5, 80, 2), (2, 60, 3)])
def test_jaccard_join(spark, docs, rows, k, percent, rows_in_block):
    sets = []
    for i, t in rows:
        w = SPACE.findall(low(t))
        sets.append((i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())))
    near = [[b for b in range(len(sets)) if b != a and sets[a][1] and sets[b][1]
             and 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1])]
            for a in range(len(sets))]
    expected = []
    for a in range(len(sets)):
        reached, todo = {a}, [a]
        while todo:
            todo += (new := [b for b in near[todo.pop()] if b not in reached])
            reached.update(new)
        expected.append((sets[a][0], len(sets[a][1]), min(sets[b][0] for b in reached), len(near[a])))
    found = jaccard_join.jaccard_components(docs, k, percent, block_rows=rows_in_block)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_jaccard_join_edges(spark, docs):
    assert jaccard_join.jaccard_components(without_rows(docs), 4, 85).count() == 0
    found = jaccard_join.jaccard_components(with_null_id(spark, docs).where("doc_id IS NULL OR doc_id < 4"), 4, 85)
    assert {r.doc_id: tuple(r[1:]) for r in found.collect()} == {
        None: (5, None, 0), 0: (0, 0, 0), 1: (0, 1, 0), 2: (0, 2, 0), 3: (1, 3, 0)}


# 4 pseudonyms

def test_pseudonyms_round_trip_and_keep_formats():
    given = ("cards 4111 1111 1111 1111, 4111111111111111 not 4111111111111112; +1 (444) 555-3382 444.555.3382 "
             "1.2.3.4 256.1.1.1 jo.9@ex.org 2020-02-29 2020-02-30 31/12/1999 12/31/1999 01.02.2003 078-05-1120 "
             "000-05-1120 GB82 WEST 1234 5698 7654 32 GB82 WEST 1234 5698 7654 33")
    made, found = pseudonyms.replaced(given)
    assert found == {"card": 2, "phone": 2, "ip": 1, "email": 1, "date": 4, "ssn": 1, "iban": 1}
    assert pseudonyms.reveal(made) == given and pseudonyms.replaced(given)[0] == made
    assert len(made.split()) == len(given.split())
    for left in ("4111111111111112", "256.1.1.1", "2020-02-30", "000-05-1120"):
        assert left in made
    for gone in ("4111111111111111", "4111 1111 1111 1111", "555-3382", "jo.9@", "2020-02-29", "078-05-1120"):
        assert gone not in made
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", made.split(" not ")[0])
    assert cards[0].replace(" ", "") == cards[1] and pseudonyms.luhn(cards[1]) % 10 == 0
    assert pseudonyms.replaced(given, b"other")[0] != made


@pytest.mark.parametrize("size", [1, 2, 10, 97, 1000])
def test_permutations(size):
    assert sorted(pseudonyms.permute(i, size, b"k", b"t") for i in range(size)) == list(range(size))


def test_pseudonymise_rows(spark, docs):
    found = pseudonyms.pseudonymise(docs)
    assert found.columns == [*docs.columns, "__found"]
    assert found.drop("__found", "text").exceptAll(docs.drop("text")).count() == 0
    assert found.where("doc_id = 0").first().text is None and found.where("doc_id = 1").first().text == ""
    assert pseudonyms.pseudonymise(without_rows(docs)).count() == 0


# 5 mixing

def test_mix_shares(spark, docs):
    frame = with_null_id(spark, docs)
    found = mixing.mix(frame).collect()
    assert len(found) == frame.count()
    size_of = Counter()
    for r in frame.collect():
        size_of[r.source] += len(SPACE.findall(r.text or ""))
    total = sum(size_of.values())
    by_target = {r.source_size: r.target for r in found}
    assert math.isclose(sum(by_target[s] for s in size_of.values()), 1.5 * total, rel_tol=1e-9)
    assert all(r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size for r in found)
    longest = max(r.size for r in found)
    for source, size in size_of.items():
        taken = sum(r.taken for r in found if r.source_size == size)
        assert abs(taken - by_target[size]) <= 2 * longest
    assert sorted(found, key=str) == sorted(mixing.mix(frame.repartition(5)).collect(), key=str)
    assert mixing.mix(without_rows(docs)).count() == 0


# 6 decontamination

@pytest.mark.parametrize("block", [1 << 20, 7])
def test_decontamination(spark, docs, rows, block):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    long_text = max((t for _, t in rows if t), key=len)
    items = [("a", " ".join(long_text.split()[5:31])), ("b", "One-TWO"), ("b", "ünïcode"), ("c", None), ("d", "..."),
             (None, "one two"), ("e", " ".join(long_text.split()[40:50])), ("e", " ".join(long_text.split()[40:50])),
             ("f", "never seen words of any kind in these texts at all anywhere")]
    windows = set()
    for i, t in items:
        w = word.findall(low(t))
        if i is not None:
            windows |= {(tuple(w[j:j + min(10, len(w))]), i) for j in range(len(w) - min(10, len(w)) + 1) if w}
    expected = []
    for i, t in rows:
        w, hit, ids = word.findall(low(t)), set(), set()
        for g, item in windows:
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j:j + len(g)]) == g:
                    hit.update(range(j, j + len(g)))
                    ids.add(item)
        expected.append((i, len(w), len(hit), sorted(ids)))
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.contamination(docs, bench, block_windows=block)
    key = lambda r: (r[0], str(r))
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()], key=key) == sorted(
        expected, key=key)
    assert any(e[2] for e in expected)


def test_decontamination_without_rows(spark, docs):
    bench = spark.createDataFrame([("a", "one")], "item_id string, text string")
    assert decontamination.contamination(without_rows(docs), bench).count() == 0
    assert decontamination.contamination(docs, bench.where("false")).where("n_hit > 0").count() == 0


# 7 toxicity

def test_toxicity(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 5 == 0)
        text = list(rng.choice(words, 40))
        if toxic:
            text[int(rng.integers(0, 40))] = ["slur", "insult"][i % 2]
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    rows += [(1000, None), (1001, ""), (1002, "slur"), (1003, "w1 w2"), (None, "slur")]
    labels += [(0, None), (None, 1), (3, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = fold(F.col("doc_id"), 3) == 1
    found = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int").where(~held))
    score = {r.doc_id: r.score for r in found.collect()}
    held_out = [(score[i], t) for i, t in labels[:600] if i in {r.doc_id for r in docs.where(held).collect()}]
    assert min(s for s, t in held_out if t) > 0.7 > max(s for s, t in held_out if not t)
    assert all(0 <= s <= 1 for s in score.values()) and score[1000] == score[1001] < 0.5 < score[1002]
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}


# 8 chat formatting

def test_chat_round_trip(spark):
    turns = [(1, 0, "system", "be nice <|end|>\n"), (1, 1, "user", "50% <|user|>\nhi"), (1, 2, "assistant", "%3C| ok"),
             (1, 3, "user", None), (1, 4, "assistant", "word " * 700), (1, 5, "assistant", ""),
             (1, 6, "user", "q " * 300), (1, 7, "assistant", "a " * 300), (1, 8, "user", "z"),
             (2, 0, "system", "alone"), (3, None, None, "x\ny"), (3, 1, "ro|>le\n%", "t"), (3, 1, "ro|>le\n%", "t"),
             (None, 0, "assistant", "</s>[INST] ok [/INST]")]
    turns += [(4, i, "system" if i == 0 else ["user", "assistant"][i % 2], f"{i} " * 20) for i in range(60)]
    frame = spark.createDataFrame([(*t, 9) for t in turns],
                                  "conv_id bigint, turn bigint, role string, text string, before int")
    made = chat_format.windows(frame, budget=400, history=50).cache()
    found = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    for conv in (1, 2, 3, 4, None):
        own = [(r or "", t or "") for c, _, r, t in turns if c == conv]
        assert [(t.role, t.text) for t in found[conv].turns] == own
        assert found[conv].learned == [t for r, t in own if r == "assistant"]
    windows = {r.window: r for r in made.where("conv_id = 4").collect()}
    assert all(w.n_tokens <= 400 for w in windows.values())
    assert len(windows) > 2 and all(w.formatted.startswith("<|system|>\n") for w in windows.values())
    assert any(w.n_repeated > 1 for w in windows.values())
    assert chat_format.windows(frame.where("false")).count() == 0


# 9 line dedup

def brute_dedup(rows):
    """Removed line ranges by the definition, documents in order of id."""
    seen, out = {}, Counter()
    order = sorted({(i, t) for i, t in rows if t}, key=lambda r: r[0])
    removed = {}
    for i, t in order:
        lines = t.split("\n")
        kept, gone = [], 0
        for a, b, chunk in line_dedup.chunks(t.encode()):
            if sum(1 for x in lines[a:b] if x.strip(" \t\r\x0b\x0c")) > 1 and chunk in seen:
                gone += b - a
                continue
            seen.setdefault(chunk, i)
            kept += lines[a:b]
        removed[i, t] = "\n".join(kept), gone
    for i, t in rows:
        out[(i, *removed[i, t]) if t else (i, t, 0)] += 1
    return out


def test_line_dedup(spark, docs, rows):
    found = line_dedup.line_dedup(docs)
    assert Counter((r.doc_id, r.text, r["__n_removed"]) for r in found.collect()) == brute_dedup(rows)
    assert found.where("__n_removed > 0").count() > 3
    assert found.columns == [*docs.columns, "__n_lines", "__n_removed"]
    assert line_dedup.line_dedup(without_rows(docs)).count() == 0
    assert line_dedup.line_dedup(with_null_id(spark, docs)).count() == docs.count() + 1


def test_chunks_come_back_into_step():
    lines = [f"line {i} {i * i % 97}" for i in range(200)]
    a = {c for *_, c in line_dedup.chunks("\n".join(lines).encode())}
    b = {c for *_, c in line_dedup.chunks("\n".join(["new", *lines[:90], "other", *lines[91:]]).encode())}
    assert len(a & b) > 0.85 * len(a)


# 10 lattice language model

def brute_lattice(word, pieces):
    """Sum over all segmentations, spelled out."""
    def inner(rest):
        if not rest:
            return 1.0
        n = len(rest[0].encode())
        total = math.exp(pieces.log[-1] * n) * inner(rest[1:])
        for j in range(1, len(rest) + 1):
            if (score := pieces.arc(rest[:j], False)) is not None:
                total += math.exp(score) * inner(rest[j:])
        return total
    return sum(math.exp(pieces.arc(word[:j], True)) * inner(word[j:]) for j in range(len(word) + 1)
               if pieces.arc(word[:j], True) is not None)


def test_lattice_sums_all_segmentations():
    pieces = lattice_lm.load_pieces()
    for word in ("the", "thinking", "zürich", "日本", "a▁b"):
        want = math.log(brute_lattice(word, pieces))
        assert lattice_lm.lattice([word], pieces)[0] == pytest.approx(want)
        assert lattice_lm.forward_one(word, pieces) == pytest.approx(want)
    assert np.exp(pieces.log[:-1]).sum() + 256 * np.exp(pieces.log[-1]) == pytest.approx(1)
    counts = lattice_lm.expected(["the", "thinking"], np.array([1, 1]), pieces)
    assert counts[:-1].sum() >= 2


def test_lm_scores(spark, docs, rows):
    learn = fold(F.col("doc_id"), 5) != 1
    pieces = lattice_lm.load_pieces()
    found = lattice_lm.lm_scores(docs, learn, pieces, frequent=20).collect()
    learned = {r.doc_id for r in docs.where(learn).collect()}
    counts = Counter()
    for i, t in rows:
        if i in learned:
            counts.update(SPACE.findall(low(t)))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i, len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), n,
                       sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None]))
                      for i, t in rows for w in [SPACE.findall(low(t))])
    assert [r[:4] for r in expected] == [tuple(r[:4]) for r in sorted(found)]
    assert [r[4] for r in expected] == pytest.approx([r.base_score for r in sorted(found)])
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    again = lattice_lm.lm_scores(docs, learn, pieces, frequent=10 ** 6).collect()
    assert [r.score for r in sorted(again)] == pytest.approx([r.score for r in sorted(found)])
    assert lattice_lm.lm_scores(without_rows(docs), learn, pieces).count() == 0
    none = lattice_lm.lm_scores(docs, F.lit(False), pieces).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


# Pipeline

def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    given = docs.collect()
    first = p.known_language(spark, docs, small)
    assert first.columns == docs.columns and first.count() >= 0.97 * len(given)
    second = p.fresh_lines(spark, docs, small)
    assert second.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in second.collect()) == Counter(
        {k[:2]: n for k, n in brute_dedup([(r.doc_id, r.text) for r in given]).items()})
    assert all(r.n_chars == len(r.text) for r in second.collect())
    third = {r.doc_id for r in p.one_of_near_duplicates(spark, docs, small).collect()}
    groups = jaccard_join.jaccard_components(docs, 5, 80).collect()
    assert third == {r.component_id for r in groups}
    fourth = {r.doc_id for r in p.outside_benchmarks(spark, docs, small).collect()}
    hits = {r.doc_id for r in QUERIES["op6_decontamination"](spark, small).where("contaminated").collect()}
    assert hits and fourth == {r.doc_id for r in given} - hits
    assert [n for n, _ in p.STAGES] == ["language", "lines", "near duplicates", "benchmarks", "mix"]
    awkward = with_null_id(spark, documents(spark))
    for _, stage in p.STAGES[:4]:
        assert stage(spark, awkward, small).columns == awkward.columns
        assert stage(spark, without_rows(awkward), small).count() == 0
