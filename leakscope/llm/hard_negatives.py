"""Hard negatives from candidate blocks in the order of a Hilbert curve, with zone maps and interval bounds.

Rows are cut into cells along every dimension and sorted by the place of their cell on a Hilbert curve, so that rows of
a block lie near each other. Blocks are Parquet rows of up to ``BLOCK_ROWS`` vectors with a zone map: the least and most
value of every dimension and the labels in the block. For an anchor a, the sum over the dimensions of the larger (the
smaller) of a * least and a * most bounds all its inner products with a block. These bounds tell which blocks an anchor
has to read: first those that may hold one of its best positives, better than what its own block already has, then
those that may reach into the score window of one of its positives.

Anchors travel in chunks of up to ``CHUNK_ROWS`` neighbours on the curve, zone maps in pages of about ``PAGE_BLOCKS``, so
no task holds more than a block, a page and a chunk, and nothing is broadcast. Every task keeps the best few rows of each
anchor and window in its block, and those are ranked together. Block sizes and the curve decide on cost, never on results.

Rows without an id, a label or a vector and vectors with a null or not finite component take no part; an empty table
gives an empty result. Rows equal in id, label and vector count once; rows that share an id but differ are rows of their
own, and each of them may be an anchor, a positive or a negative. Equal scores are ranked by id, and between such rows
by their place. A shorter vector is read as if zeros followed. Inner products have to fit in 56 bits. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import cut
from leakscope.llm.vectors import inner_products, is_finite, matrix, packed, unpacked

BLOCK_ROWS = 1024
CHUNK_ROWS = 256
PAGE_BLOCKS = 256
SLICES = 32  # into which the anchors of a page are dealt
CURVE_BITS = 2
_NONE = np.iinfo(np.int64).min
_MEMBERS = ("array<struct<number bigint, id bigint, label bigint, vector binary, least bigint, "
            "positives array<struct<id bigint, score bigint>>>>")
_MEMBER = pa.struct([("number", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()),
                     ("least", pa.int64()),
                     ("positives", pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))])


def curve_places(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of cells (whole numbers below 2**bits) on a Hilbert curve, as bytes that sort like it."""
    x = np.ascontiguousarray(cells.T.astype(np.int64))
    if not len(x):
        return [b""] * cells.shape[0]
    for low in range(bits - 1, 0, -1):  # turn and mirror the sub-cubes, the largest first
        mask = (1 << low) - 1
        for i, axis in enumerate(x):
            mirrored = (axis >> low & 1).astype(bool)
            swapped = np.where(mirrored, 0, (x[0] ^ axis) & mask)
            x[0] ^= np.where(mirrored, mask, swapped)
            if i:
                axis ^= swapped
    for i in range(1, len(x)):  # reflected binary code across the axes
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for low in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> low & 1, (1 << low) - 1, 0)
    x ^= turn
    planes = np.concatenate([(x >> low & 1).astype(np.uint8) for low in range(bits - 1, -1, -1)])
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


def _blocks(rows: DataFrame, width: int, block_rows: int) -> DataFrame:
    """The candidate blocks with their zone maps, written; block numbers differ, but have gaps."""
    values = rows.select(F.explode("vector").alias("v")).agg(F.avg("v"), F.stddev_pop("v")).first()
    centre, spread = values[0] or 0.0, values[1] or 1.0
    # Quarters of a normal distribution, as far as the values of all dimensions together have one.
    edges = centre + spread * np.array([-0.6745, 0.0, 0.6745])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(2), width)
            places = curve_places(np.searchsorted(edges, values), CURVE_BITS)
            yield pa.record_batch([pa.array(places, pa.binary()), *batch.columns[:2], batch.column(3),
                                   pa.array([packed(v) for v in values], pa.binary())],
                                  names=["place", "id", "label", "anchor", "vector"])

    order = ["place", "id", "label", "vector"]
    sorted_rows = (rows.mapInArrow(place, "place binary, id bigint, label bigint, anchor boolean, vector binary")
                   .repartitionByRange(*order).sortWithinPartitions(*order))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId() << 32, None
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            ids, labels, anchors, vectors = zip(*held)
            values = unpacked(b"".join(vectors), width, len(held))
            return pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([labels], pa.list_(pa.int64())), pa.array([anchors], pa.list_(pa.bool_())),
                 pa.array([b"".join(vectors)], pa.binary()), pa.array([packed(values.min(axis=0))], pa.binary()),
                 pa.array([packed(values.max(axis=0))], pa.binary())],
                names=["block", "ids", "labels", "anchors", "vectors", "least", "most"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                if row == last:
                    continue  # a repeated row
                last = row
                held.append(row)
                if len(held) == block_rows:
                    yield block()
                    number, held = number + 1, []
        if held:
            yield block()

    return cut(sorted_rows.mapInArrow(
        pack, "block bigint, ids array<bigint>, labels array<bigint>, anchors array<boolean>, vectors binary, "
              "least binary, most binary"), "negatives-blocks")


def _first_few(scores: np.ndarray, ids: np.ndarray, able: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``few`` best able scores of each row, by falling score, then by id."""
    scores = np.where(able, scores, _NONE)
    if scores.shape[1] > few:
        bound = np.partition(scores, scores.shape[1] - few, axis=1)[:, [scores.shape[1] - few]]
        able = able & (scores >= bound)
    row, column = np.nonzero(able)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < few], column[nth < few]


def _chunks(blocks: DataFrame, width: int, block_rows: int, few: int, chunk_rows: int) -> DataFrame:
    """The anchors in chunks, each with the score of its last positive if only its own block counted."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = TaskContext.get().partitionId() << 32, []

        def out(members: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([chunk], pa.int64()), pa.array([members], pa.list_(_MEMBER))],
                                   names=["chunk", "members"])

        for batch in batches:
            for block, ids, labels, anchors, vectors in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = np.flatnonzero(anchors)
                if not len(own):
                    continue
                ids, labels, values = np.array(ids), np.array(labels), unpacked(vectors, width, len(ids))
                able = labels[own][:, None] == labels[None, :]
                able[np.arange(len(own)), own] = False
                scores = inner_products(values[own], values)
                row, column = _first_few(scores, ids, able, few)
                least = np.full(len(own), _NONE)
                full = np.flatnonzero(np.bincount(row, minlength=len(own)) == few)
                least[full] = [scores[i, column[row == i]].min() for i in full]
                for i, at in enumerate(own.tolist()):
                    held.append({"number": block * block_rows + at, "id": int(ids[at]), "label": int(labels[at]),
                                 "vector": packed(values[at]), "least": int(least[i]), "positives": []})
                    if len(held) == chunk_rows:
                        yield out(held)
                        chunk, held = chunk + 1, []
        if held:
            yield out(held)

    return blocks.select("block", "ids", "labels", "anchors", "vectors").mapInArrow(
        read, f"chunk bigint, members {_MEMBERS}")


def _windows(members: list[dict], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score in the window of each positive; an anchor with fewer has empty windows in their place."""
    most = max([1, *(len(m["positives"]) for m in members)])
    least, top = np.full((len(members), most), 1, np.int64), np.zeros((len(members), most), np.int64)
    for i, member in enumerate(members):
        for j, positive in enumerate(member["positives"]):
            least[i, j], top[i, j] = -(-low * positive["score"] // 100), high * positive["score"] // 100
    return least, top


def _reading(chunks: DataFrame, pages: DataFrame, n_pages: int, width: int, share: tuple[int, int] | None) -> DataFrame:
    """(block, members): who has to read which block, by the bounds of its zone map.

    Without ``share`` members look for positives above their ``least``, else for negatives in their windows.
    """
    dealt = (chunks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
             .withColumn("slice", F.pmod(F.xxhash64("chunk"), F.lit(SLICES)).cast("int")))
    copied = pages.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                given = batch.column(0)[r].values
                members = given.to_pylist()
                zones = batch.column(1)[r].as_py()
                anchors = unpacked(b"".join(m["vector"] for m in members), width, len(members))
                least = unpacked(b"".join(z["least"] for z in zones), width, len(zones))
                most = unpacked(b"".join(z["most"] for z in zones), width, len(zones))
                up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
                at_most = inner_products(up, most) + inner_products(down, least)
                at_least = inner_products(up, least) + inner_products(down, most)
                labels, which = np.unique([m["label"] for m in members], return_inverse=True)
                held = [set(z["labels"]) for z in zones]
                if share is None:
                    has = np.array([[x in h for h in held] for x in labels.tolist()])[which]
                    read = has & (at_most >= np.array([m["least"] for m in members])[:, None])
                else:
                    has = np.array([[len(h) > (x in h) for h in held] for x in labels.tolist()])[which]
                    low, high = _windows(members, *share)
                    read = np.zeros_like(has)
                    for j in range(low.shape[1]):
                        inside = (at_most >= low[:, [j]]) & (at_least <= high[:, [j]])
                        read |= has & inside & (low[:, [j]] <= high[:, [j]])
                for z in np.flatnonzero(read.any(axis=0)).tolist():
                    wanted = given.take(pa.array(np.flatnonzero(read[:, z])))
                    yield pa.record_batch(
                        [pa.array([zones[z]["block"]], pa.int64()),
                         pa.ListArray.from_arrays(pa.array([0, len(wanted)], pa.int32()), wanted)],
                        names=["block", "members"])

    return (dealt.join(copied, ["page", "slice"]).select("members", "zones")
            .mapInArrow(choose, f"block bigint, members {_MEMBERS}"))


_FOUND = "number bigint, anchor_id bigint, nth int, positive_id bigint, positive_score bigint, id bigint, score bigint"


def _products(reading: DataFrame, blocks: DataFrame, width: int, block_rows: int, few: int,
              share: tuple[int, int] | None) -> DataFrame:
    """The best ``few`` rows of each block for each of its readers, or for each of their windows."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                members = batch.column(0)[r].as_py()
                block, ids, labels = (batch.column(i)[r].as_py() for i in range(1, 4))
                ids, labels = np.array(ids), np.array(labels)
                values = unpacked(batch.column(4)[r].as_py(), width, len(ids))
                anchors = unpacked(b"".join(m["vector"] for m in members), width, len(members))
                scores = inner_products(anchors, values)
                same = np.array([m["label"] for m in members])[:, None] == labels[None, :]
                if share is None:
                    numbers = block * block_rows + np.arange(len(ids))
                    other = np.array([m["number"] for m in members])[:, None] != numbers[None, :]
                    able = same & other & (scores >= np.array([m["least"] for m in members])[:, None])
                    found = [(0, *_first_few(scores, ids, able, few))]
                else:
                    low, high = _windows(members, *share)
                    found = [(j, *_first_few(scores, ids, ~same & (scores >= low[:, [j]]) & (scores <= high[:, [j]]),
                                             few)) for j in range(low.shape[1])]
                for j, row, column in found:
                    positive = [members[i]["positives"][j] if share else {"id": None, "score": None}
                                for i in row.tolist()]
                    yield pa.record_batch(
                        [pa.array([members[i]["number"] for i in row.tolist()], pa.int64()),
                         pa.array([members[i]["id"] for i in row.tolist()], pa.int64()),
                         pa.array(np.full(len(row), j + 1), pa.int32()),
                         pa.array([p["id"] for p in positive], pa.int64()),
                         pa.array([p["score"] for p in positive], pa.int64()),
                         pa.array(ids[column], pa.int64()), pa.array(scores[row, column], pa.int64())],
                        names=["number", "anchor_id", "nth", "positive_id", "positive_score", "id", "score"])

    joined = reading.join(blocks.select("block", "ids", "labels", "vectors"), "block")
    return joined.select("members", "block", "ids", "labels", "vectors").mapInArrow(read, _FOUND)


def _ranked(found: DataFrame, keys: list[str], few: int) -> DataFrame:
    """The ``few`` best rows of each key; each task keeps no more of a key before the shuffle either."""
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= few)


def hard_negatives(rows: DataFrame, anchor: Column, few: int = 5, low: int = 80, high: int = 100,
                   block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and ``vector`` (whole numbers); ``anchor`` tells anchors. The positives of an anchor are
    its ``few`` best other rows of its label; for each, the ``few`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score are its negatives.
    """
    part = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite("vector")).select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "vector",
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    width = part.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = _blocks(part, width, block_rows)
    n_pages = -(-blocks.count() // PAGE_BLOCKS) or 1
    pages = cut(blocks.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int")).groupBy("page").agg(
        F.collect_list(F.struct("block", "least", "most", F.array_distinct("labels").alias("labels"))).alias("zones")),
        "negatives-pages")
    chunks = cut(_chunks(blocks, width, block_rows, few, chunk_rows), "negatives-chunks")

    near = _products(_reading(chunks, pages, n_pages, width, None), blocks, width, block_rows, few, None)
    positives = cut(_ranked(near, ["number"], few).select("number", "rank", "id", "score"), "negatives-positives")
    of_anchor = positives.groupBy("number").agg(  # at most ``few`` rows each
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))),
                    lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))).alias("positives"))
    looking = (chunks.select("chunk", F.inline("members")).drop("positives").join(of_anchor, "number").groupBy("chunk")
               .agg(F.collect_list(F.struct("number", "id", "label", "vector", "least", "positives")).alias("members")))
    share = (low, high)
    hard = _products(_reading(looking, pages, n_pages, width, share), blocks, width, block_rows, few, share)
    return _ranked(hard, ["number", "nth"], few).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
