"""Hard negatives and whitening against brute force, with awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leakscope.llm import hard_negatives as hard
from leakscope.llm import whitening
from leakscope.llm.vectors import floored, inner_products, is_finite, matrix

SCHEMA = "vec_id bigint, embedding array<float>, label int, place string, block string, n int, `a.b` int"
NAN, INF = float("nan"), float("inf")


def rows_of(n=400, width=6, seed=1, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(5)]
    out = []
    for i in range(n):
        centre = rng.choice(centres)
        out.append((i, [c + rng.gauss(0, 0.1) for c in centre], rng.randrange(labels)))
    hot = [0.5] * width
    out += [(n + i, hot, i % labels) for i in range(120)]  # equal vectors
    out += [out[0], out[0], out[20]]  # repeated rows
    return out


AWKWARD = [(1000, None, 1), (1001, [0.1, None], 1), (1002, [0.1, NAN], 2), (1003, [INF, 0.2], 2), (1004, [0.2] * 6, None),
           (None, [0.2] * 6, 1), (1005, [0.3, -0.2], 1), (1006, [], 2)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", "b", 7, 8) for r in rows], SCHEMA).repartition(3)


def mined(spark, rows, anchor="vec_id % 20 = 0", **sizes):
    given = table(spark, rows).where(is_finite("embedding"))
    given = given.withColumn("vector", floored("embedding", 256))
    return [tuple(r) for r in hard.hard_negatives(given, F.expr(anchor), **sizes).collect()]


def brute(rows, few=5, step=20):
    own = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
        own[i] = (x, label)

    def score(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = []
    for a, (x, label) in own.items():
        if a % step:
            continue
        ranked = sorted((-score(x, y), i) for i, (y, _) in own.items() if i != a)
        positives = [(-s, i) for s, i in ranked if own[i][1] == label][:few]
        for p, j in positives:
            negatives = [(-s, i) for s, i in ranked if own[i][1] != label and 80 * p <= -100 * s <= 100 * p][:few]
            out += [(a, j, r, i, p, s) for r, (s, i) in enumerate(negatives, 1)]
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 16, "chunk_rows": 3}, {"block_rows": 1, "chunk_rows": 1}])
def test_hard_negatives_are_those_of_brute_force(spark, monkeypatch, sizes):
    rows = rows_of(120 if sizes.get("block_rows") == 1 else 400) + AWKWARD
    monkeypatch.setattr(hard, "PAGE_BLOCKS", 4)
    found = mined(spark, rows, **sizes)
    assert sorted(found) == sorted(brute(rows)) and found


def test_bounds_leave_blocks_unread(spark):
    rng = random.Random(2)
    rows = [(i, [(2.0 if i % 4 == j else 0.0) + rng.gauss(0, 0.05) for j in range(4)], i % 3) for i in range(640)]
    given = table(spark, rows).withColumn("vector", floored("embedding", 256))
    part = given.select(F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("label"), "vector",
                        F.expr("vec_id % 20 = 0").alias("anchor"))
    blocks = hard._blocks(part, 4, 32)
    pages = blocks.groupBy(F.lit(0).alias("page")).agg(F.collect_list(
        F.struct("block", "least", "most", F.array_distinct("labels").alias("labels"))).alias("zones"))
    chunks = hard._chunks(blocks, 4, 32, 5, 1)
    read = hard._reading(chunks, pages, 1, 4, None).count()
    assert 0 < read < 0.5 * chunks.count() * blocks.count()
    assert sorted(mined(spark, rows, block_rows=32)) == sorted(brute(rows))


def test_no_anchor_no_other_label_no_rows(spark):
    rows = rows_of(60)
    assert mined(spark, rows, "vec_id < 0") == []
    assert mined(spark, [(i, v, 1) for i, v, _ in rows]) == []
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_rows_that_share_an_id_but_differ_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0], 1), (20, [0.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.9], 2)]
    found = mined(spark, rows)
    assert {(r[0], r[1], r[3]) for r in found} >= {(20, 1, 2)} and len([r for r in found if r[1] == 1]) == 2


def test_curve_visits_every_cell_by_single_steps():
    for bits, axes in ((1, 3), (2, 2), (3, 2), (2, 3)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * axes)).reshape(axes, -1).T
        order = np.argsort(np.array([p.ljust(8, b"\0") for p in hard.curve_places(cells, bits)], "S8"), kind="stable")
        places = hard.curve_places(cells, bits)
        walk = cells[sorted(range(len(cells)), key=lambda i: places[i])]
        assert len(set(places)) == len(cells) == len(order)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_inner_products_are_exact_beyond_doubles():
    a = np.array([[2**28 + 1, 3, -5]], np.int64)
    b = np.array([[2**27 + 3, 7, 2**29 + 1], [1, 0, 0]], np.int64)
    assert inner_products(a, b).tolist() == [[(2**28 + 1) * (2**27 + 3) + 21 - 5 * (2**29 + 1), 2**28 + 1]]


def test_matrix_fills_short_rows():
    import pyarrow as pa

    lists = pa.array([[9], [1, 2], [], [3]], pa.list_(pa.int64()))
    assert matrix(lists, 2, 7).tolist() == [[9, 7], [1, 2], [7, 7], [3, 7]]
    assert matrix(lists.slice(1), 2).tolist() == [[1, 2], [0, 0], [3, 0]]


def white(spark, rows, wanted=8, **how):
    given = table(spark, rows).where(is_finite("embedding")).withColumn("vector", floored("embedding", 1024, 100_000))
    blocks = whitening.read_blocks(given, 100_000, **how)
    model = whitening.fit(blocks, wanted)
    return blocks, model, whitening.whitened(blocks, model).toPandas()


def whole(rows, width):
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.full((len(kept), width), 100_000, np.int64)
    for at, (_, v) in enumerate(kept):
        x[at, :len(v)] = [int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v]
    return [i for i, _ in kept], x


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_whitening_equals_an_eigendecomposition(spark, block_rows):
    rows = rows_of(300, 6) + AWKWARD
    ids, x = whole(rows, 6)
    blocks, model, found = white(spark, rows, block_rows=block_rows)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert blocks.n == n and len(found) == n * 6
    np.testing.assert_allclose(model.variances, values, rtol=1e-10)
    np.testing.assert_allclose(np.abs(model.components @ vectors), np.eye(6), atol=1e-8)
    expected = centred @ vectors / np.sqrt(values) * np.sign(np.diag(model.components @ vectors))
    by_component = found.groupby("component")
    for k, part in by_component:
        np.testing.assert_allclose(np.sort(part["whitened"]), np.sort(expected[:, k - 1]), atol=1e-9)
        assert np.allclose(part["explained"], values[k - 1] / values.sum(), rtol=1e-10)
        assert sorted(part["deviation"]) == sorted(((n * x - sums) ** 2).sum(axis=1).tolist())
    assert found["vec_id"].isna().sum() == 6  # the row without an id
    assert sorted(found["vec_id"].dropna().astype(int).unique()) == sorted({i for i in ids if i is not None})
    assert whitening.identity_error(blocks, model) < 1e-9


def test_equal_and_missing_deviations(spark):
    corners = [(i, [float(i >> j & 1) for j in range(3)] + [0.25, float(i & 1)], 0) for i in range(8)]
    blocks, model, found = white(spark, corners)
    # The last axis repeats the first; two others have equal variances; one has none.
    np.testing.assert_allclose(model.variances, np.array([2, 1, 1]) * 512.0 ** 2, rtol=1e-12)
    assert len(found) == 24 and whitening.identity_error(blocks, model) < 1e-12


def test_many_dimensions_stop_when_settled(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((150, 40)) * (0.9 ** np.arange(40))
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    monkeypatch.setattr(whitening, "WHOLE", 10)
    blocks, model, _ = white(spark, rows, 3)
    _, whole_x = whole(rows, 40)
    values = np.linalg.eigvalsh(np.cov(whole_x.T, bias=True))[::-1]
    np.testing.assert_allclose(model.variances, values[:3], rtol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5], 0)], [(i, [0.5], 0) for i in range(4)], [(1, [], 0)]])
def test_nothing_to_whiten(spark, rows):
    blocks, model, found = white(spark, rows)
    assert len(found) == 0 and whitening.identity_error(blocks, model) == 0.0


def test_deviation_beyond_64_bits_is_null():
    vectors = np.array([[2**40, 0], [0, 0]], np.int64)
    assert whitening._deviations(vectors, 2, vectors.sum(axis=0)) == [None, None]
