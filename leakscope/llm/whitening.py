"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

X is the matrix of all rows less their mean. Starting from a direction v, the steps alternate the products u = Xv and
v' = Xᵀu, which are summed by Spark over written blocks of rows; u and v' are made orthogonal to all before them and
scaled, and their lengths are the two diagonals of a small matrix B with X = U B Vᵀ. The singular values of B over the
square root of the number of rows are the deviations along the components, V times its right vectors the components.

Row i of u is a product of row i of X with a vector of as many entries as a row has, which the driver keeps. So the
entries of all u are made anew in each scan where they are needed for orthogonality, none is stored, and one scan serves
both products of a step. The driver holds vectors of the rows' width only, as many as steps. If a direction has nothing
left to go to, a new one orthogonal to all others is taken, so equal and zero deviations are found as well. Up to
``WHOLE`` dimensions all of them are walked; beyond, the walk ends when the wanted values have settled to rounding, and
components of exactly equal deviation are then told apart by rounding alone.

Rows whose vector is null or holds a null or a value that isn't finite are left out. A null id is kept, repeated rows
count as often as they are there, equal values and rows get equal results, and columns other than vec_id and vector are
not read. A shorter vector is read as if entries of 0.0 followed. Directions without deviation have no component: an
empty table, one row or equal rows give an empty result. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut
from leakscope.llm.vectors import matrix, packed, unpacked

BLOCK_ROWS = 1024
WHOLE = 256
# Of the largest length: what is shorter is rounding, and half of the digits are left by a difference of squares.
_ZERO = 1e-13
_NOTHING = 1e-7


@dataclass
class Blocks:
    """Written blocks of rows (ids, vectors), with the number of rows and the sums of their entries."""

    table: DataFrame
    width: int
    n: int
    sums: np.ndarray

    def centring(self) -> Callable[[bytes], np.ndarray]:
        """For tasks: rows of a block less the mean. n * x - sum is a whole number, so only one division rounds."""
        n, width, sums = self.n, self.width, self.sums
        return lambda vectors: (n * unpacked(vectors, width) - sums) / n


def read_blocks(rows: DataFrame, fill: int, block_rows: int = BLOCK_ROWS) -> Blocks:
    """``rows`` has vec_id and vector (whole numbers); ``fill`` follows shorter vectors."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, block_rows):
                part = batch.slice(first, block_rows)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.record_batch([ids, pa.array([packed(matrix(part.column(1), width, fill))], pa.binary())],
                                      names=["ids", "vectors"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    table = cut(rows.select("vec_id", "vector").mapInArrow(pack, f"ids array<{kind}>, vectors binary"), "white-blocks")
    blocks = Blocks(table, width, 0, np.zeros(width, np.int64))
    n = table.agg(F.sum(F.size("ids"))).first()[0] or 0
    sums = _summed(blocks, lambda block: unpacked(block, width).sum(axis=0), "bigint") if n and width else []
    return Blocks(table, width, n, np.array(sums, np.int64))


def _summed(blocks: Blocks, of_block: Callable[[bytes], np.ndarray], kind: str = "double") -> list:
    """Entry by entry the sum of what ``of_block`` gives for each block: added up in each task, then by Spark."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column(0):
                part = of_block(block.as_py())
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], names=["at", "part"])

    parts = blocks.table.select("vectors").mapInArrow(read, f"at bigint, part {kind}")
    return [row["total"] for row in parts.groupBy("at").agg(F.sum("part").alias("total")).orderBy("at").collect()]


def _orthogonal(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``vector`` less its parts along the rows of ``others``, taken twice for rounding."""
    for _ in range(2):
        vector = vector - others.T @ (others @ vector)
    return vector


def _unit(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    vector = _orthogonal(vector, others)
    return _orthogonal(vector / np.linalg.norm(vector), others)


def bidiagonalise(blocks: Blocks, wanted: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The diagonal and the one above it of B, and the rows of Vᵀ."""
    width, rng, centred = blocks.width, np.random.default_rng(20011), blocks.centring()
    right = np.zeros((0, width))
    left = np.zeros((0, width))  # u of each step is X times its row; all zeros where X v had nothing new
    back = np.zeros((0, width))  # Xᵀu of each step
    diagonal, above, largest = [], [], 0.0
    v = _unit(rng.standard_normal(width), right)
    for step in range(min(steps or width, width)):
        right = np.vstack((right, v))

        def products(block: bytes, v: np.ndarray = v, left: np.ndarray = left) -> np.ndarray:
            x = centred(block)
            u = x @ v
            return np.concatenate((x.T @ u, [u @ u], (x @ left.T).T @ u))

        total = np.array(_summed(blocks, products))
        to_left, square, along = total[:width], total[width], total[width + 1:]
        largest = max(largest, float(np.sqrt(square)))
        # u less its parts along the ones before, and what the second product makes of that.
        square -= along @ along
        alpha = float(np.sqrt(max(square, 0.0)))
        if alpha <= _NOTHING * largest:
            alpha = 0.0
        u = (v - left.T @ along) / alpha if alpha else np.zeros(width)
        z = (to_left - back.T @ along) / alpha if alpha else np.zeros(width)
        left, back = np.vstack((left, u)), np.vstack((back, z))
        diagonal.append(alpha)
        if step + 1 == width:
            break
        after = _orthogonal(z, right)
        beta = float(np.linalg.norm(after))
        if beta <= _ZERO * largest:
            beta, after = 0.0, rng.standard_normal(width)
        above.append(beta)
        v = _unit(after, right)
        if width > WHOLE and len(diagonal) > wanted and beta:
            x, values, _ = np.linalg.svd(np.diag(diagonal) + np.diag(above[:-1], 1))
            if (np.abs(beta * x[-1, :wanted]) <= _ZERO * values[0]).all():
                break
    return np.array(diagonal), np.array(above[:len(diagonal) - 1]), right


@dataclass
class Whitening:
    """Components (unit rows), their variances and the trace of the covariance."""

    components: np.ndarray
    variances: np.ndarray
    trace: float


def fit(blocks: Blocks, wanted: int = 8, steps: int | None = None) -> Whitening:
    """The first ``wanted`` components of the covariance (divisor n) by falling variance, fewer if others have none."""
    none = Whitening(np.zeros((0, blocks.width)), np.zeros(0), 0.0)
    if not blocks.n or not blocks.width:
        return none
    centred = blocks.centring()
    trace = _summed(blocks, lambda block: np.array([(centred(block) ** 2).sum()]))[0] / blocks.n
    if trace == 0.0:
        return none
    diagonal, above, right = bidiagonalise(blocks, wanted, steps)
    _, values, rows = np.linalg.svd(np.diag(diagonal) + np.diag(above, 1))
    kept = int((values[:wanted] > _NOTHING * values[0]).sum())
    components = rows[:kept] @ right
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    largest = np.abs(components).argmax(axis=1)
    components *= np.sign(components[np.arange(kept), largest])[:, None]  # one sign, whatever the walk gave
    return Whitening(components, values[:kept] ** 2 / blocks.n, trace)


def identity_error(blocks: Blocks, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, over all rows."""
    if not len(model.components):
        return 0.0
    to_white = model.components.T / np.sqrt(model.variances)
    k, centred = len(model.variances), blocks.centring()

    def products(block: bytes) -> np.ndarray:
        white = centred(block) @ to_white
        return np.concatenate((white.sum(axis=0), (white.T @ white).ravel()))

    total = np.array(_summed(blocks, products)) / blocks.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(vectors: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - sum)² of each row, exact; None beyond 64 bits."""
    far = n * vectors - sums
    if not far.size or float(np.abs(far).max()) ** 2 * far.shape[1] < 2.0 ** 62:
        return (far * far).sum(axis=1).tolist()
    whole = [sum(int(x) ** 2 for x in row) for row in far.tolist()]
    return [x if x < 2**63 else None for x in whole]


def whitened(blocks: Blocks, model: Whitening) -> DataFrame:
    """vec_id, component, deviation, whitened and explained (share of all variance) of every row and component."""
    to_white = model.components.T / np.sqrt(model.variances)
    n, width, sums, k, centred = blocks.n, blocks.width, blocks.sums, len(model.variances), blocks.centring()
    explained = model.variances / model.trace if k else model.variances

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows if k else 0):
                ids, block = batch.column(0)[i].values, batch.column(1)[i].as_py()
                row = np.repeat(np.arange(len(ids)), k)
                far = pa.array(_deviations(unpacked(block, width), n, sums), pa.int64())
                white = centred(block) @ to_white
                yield pa.record_batch(
                    [ids.take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                     far.take(pa.array(row)), pa.array(white.ravel()), pa.array(np.tile(explained, len(ids)))],
                    names=["vec_id", "component", "deviation", "whitened", "explained"])

    kind = blocks.table.schema["ids"].dataType.elementType.simpleString()
    return blocks.table.mapInArrow(
        read, f"vec_id {kind}, component int, deviation bigint, whitened double, explained double")
