"""Line dedup over content-defined chunks.

Lines are what stands between line feeds, empty lines included. A chunk ends after a line where the rolling hash of
the last ``ROLL`` line hashes is divisible by ``DIVISOR``, once it has ``LEAST`` lines, and at the end of the text: so
the boundaries depend on the lines nearby and come back into step after an inserted or removed line. A chunk of
several lines (two with text at least) that occurs more than once among all documents stays where it comes first, by
doc_id, content and place; every other occurrence goes if its bytes equal those of the first one. Chunks are matched by
128 bits and only those that repeat are sent with their text for the comparison.

The first and the last chunk of a passage take in lines around it and so differ. ``with_passages`` therefore matches
every two successive lines with text as well: whatever run of two lines or more came before goes whole, wherever its
chunks end. A repeat that overlaps the first occurrence in its own document stays. Each line stays where it comes first.

A null text stays null, an empty one empty; both have no chunk to lose. Rows that are equal in doc_id and text are one
document and get equal results. A null doc_id sorts first. Extra columns of any name are kept as they are. A text may
become empty; its row stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut, drop, split

ROLL = 2
DIVISOR = 3
LEAST = 2
BITS = 1 << 24  # of the map that keeps documents without repeats out of shuffles; a full map costs time, no results
_PRIME, _MASK = 0x9E3779B185EBCA87, (1 << 64) - 1


def chunks(text: bytes, roll: int = ROLL, divisor: int = DIVISOR, least: int = LEAST) -> list[tuple[int, int, bytes]]:
    """First line, line after the last and bytes of each chunk."""
    lines = text.split(b"\n")
    drop = pow(_PRIME, roll, 1 << 64)
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    found, begin, rolling = [], 0, 0
    for i, value in enumerate(hashes):
        rolling = (rolling * _PRIME + value - (hashes[i - roll] * drop if i >= roll else 0)) & _MASK
        if i + 1 - begin >= least and (rolling >> 32) % divisor == 0:
            found.append((begin, i + 1))
            begin = i + 1
    if begin < len(lines):
        found.append((begin, len(lines)))
    return [(a, b, b"\n".join(lines[a:b])) for a, b in found]


def _several(chunk: bytes) -> bool:
    return sum(1 for line in chunk.split(b"\n") if line.strip()) > 1


def passages(text: bytes) -> list[tuple[int, int, bytes]]:
    """Like ``chunks``, every line with text and the next one, with the lines without text between them."""
    lines = text.split(b"\n")
    at = [i for i, line in enumerate(lines) if line.strip()]
    return [(a, b + 1, b"\n".join(lines[a:b + 1])) for a, b in zip(at, at[1:])]


def _chunk_rows(docs: DataFrame, with_passages: bool) -> DataFrame:
    """(doc_id, content, from, to, high, low) of the chunks with several lines."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [], [], [], [], []
            for row, text in enumerate(batch.column(2)):
                text = text.as_buffer().to_pybytes() if text.is_valid else b""
                found = {(a, b): chunk for a, b, chunk in chunks(text) if _several(chunk)}
                if with_passages:
                    found.update(((a, b), chunk) for a, b, chunk in passages(text))
                for (begin, end), chunk in found.items():
                    digest = xxhash.xxh3_128_digest(chunk)
                    for column, value in zip(rows, (row, begin, end, int.from_bytes(digest[:8], "big", signed=True),
                                                    int.from_bytes(digest[8:], "big", signed=True))):
                        column.append(value)
                if len(rows[0]) > 1 << 16:
                    yield _batch(batch, rows)
                    rows = [], [], [], [], []
            yield _batch(batch, rows)

    return (_with_lines(docs).mapInArrow(read, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                               "content bigint, `from` int, `to` int, high bigint, low bigint"))


def _with_lines(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", F.xxhash64("text").alias("content"), "text").where(F.col("text").contains("\n")))


def _batch(batch: pa.RecordBatch, rows: tuple[list, ...]) -> pa.RecordBatch:
    at = pa.array(rows[0], pa.int64())
    columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(rows[1], pa.int32()),
               pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())]
    return pa.record_batch(columns, names=["doc_id", "content", "from", "to", "high", "low"])


def _chunk_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, content, from, to, high, low, is_first, chunk) of the chunks in ``wanted``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, size = ([], [], [], [], []), ([], []), 0
            for row, (text, chunks_of) in enumerate(zip(batch.column(2), batch.column(3).to_pylist())):
                lines = text.as_buffer().to_pybytes().split(b"\n")
                for c in chunks_of:
                    chunk = b"\n".join(lines[c["from"]:c["to"]])
                    size += len(chunk)
                    for column, value in zip((*rows, *texts), (row, c["from"], c["to"], c["high"], c["low"],
                                                               c["is_first"], chunk)):
                        column.append(value)
                if size > 1 << 22:
                    yield _with_text(batch, rows, texts)
                    rows, texts, size = ([], [], [], [], []), ([], []), 0
            yield _with_text(batch, rows, texts)

    given, _ = split(_with_lines(docs), F.col("content"), wanted, BITS)
    wanted = wanted.select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"), "chunks")
    return (given.join(wanted, given["doc_id"].eqNullSafe(wanted["__id"]) & (given["content"] == wanted["__content"]))
            .select("doc_id", "content", "text", "chunks")
            .mapInArrow(read, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, content bigint, `from` int, "
                              "`to` int, high bigint, low bigint, is_first boolean, chunk binary"))


def _with_text(batch: pa.RecordBatch, rows: tuple[list, ...], texts: tuple[list, list]) -> pa.RecordBatch:
    made = _batch(batch, rows)
    return pa.record_batch([*made.columns, pa.array(texts[0], pa.bool_()), pa.array(texts[1], pa.binary())],
                           names=[*made.schema.names, "is_first", "chunk"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges that meet or overlap as one."""
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
    for batch in batches:
        column = []
        for ranges in batch.column(2).to_pylist():
            made = []
            for begin, end in sorted((r["from"], r["to"]) for r in ranges):
                if made and begin <= made[-1]["to"]:
                    made[-1]["to"] = max(end, made[-1]["to"])
                else:
                    made.append({"from": begin, "to": end})
            column.append(made)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(column, kind)], names=batch.schema.names)


def removed_chunks(docs: DataFrame, with_passages: bool = False) -> DataFrame:
    """(doc_id, content, ranges): the line ranges that go, of every document that loses any, written."""
    place = F.struct("doc_id", "content", "from", "to")
    rows = cut(_chunk_rows(docs, with_passages), "line-places")
    several = rows.groupBy("high", "low").count().where("count > 1").drop("count")
    again = cut(rows.join(several, ["high", "low"]), "line-repeats")
    drop(rows)
    repeated = (again.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .where("first <> last").select("high", "low", "first"))
    is_first = place.eqNullSafe(F.col("first"))
    overlaps = F.expr("doc_id <=> first.doc_id AND content = first.content AND `from` < first.`to`")
    wanted = cut(again.join(repeated, ["high", "low"]).withColumn("is_first", is_first).where(is_first | ~overlaps)
                 .groupBy("doc_id", "content")
                 .agg(F.collect_set(F.struct("from", "to", "high", "low", "is_first")).alias("chunks")), "line-wanted")
    drop(again)
    texts = cut(_chunk_texts(docs, wanted), "line-chunks")
    drop(wanted)
    firsts = (texts.where("is_first").groupBy("high", "low").agg(F.first("chunk").alias("first_chunk")))
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, content bigint, "
              "ranges array<struct<`from`:int,`to`:int>>")
    gone = cut(texts.where("NOT is_first").join(firsts, ["high", "low"]).where("chunk = first_chunk")
               .select("doc_id", "content", F.struct("from", "to").alias("range"))
               .groupBy("doc_id", "content").agg(F.collect_set("range").alias("ranges")).mapInArrow(_merged, schema),
               "line-ranges")
    drop(texts)
    return gone


def line_dedup(docs: DataFrame, with_passages: bool = False) -> DataFrame:
    """``docs`` with the repeated chunks, and passages if asked for, removed from ``text``; adds __n_lines and
    __n_removed (lines)."""
    gone = removed_chunks(docs, with_passages)
    may_lose, whole = split(docs, F.xxhash64("text"), gone, BITS)
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"),
                       F.col("ranges").alias("__ranges"))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.exists("__ranges", lambda r: (i >= r["from"]) & (i < r["to"])))
    removed = F.aggregate("__ranges", F.lit(0), lambda n, r: n + r["to"] - r["from"])
    columns = [F.when(F.col("__ranges").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
               if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    n_lines = F.coalesce(F.size(lines), F.lit(0)).alias("__n_lines")
    own = may_lose.join(gone, may_lose["doc_id"].eqNullSafe(gone["__id"])
                        & (F.xxhash64(may_lose["text"]) == gone["__content"]), "left")
    return (own.select(*columns, n_lines, F.coalesce(removed, F.lit(0)).alias("__n_removed"))
            .unionAll(whole.select("*", n_lines, F.lit(0).alias("__n_removed"))))
