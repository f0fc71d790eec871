"""Benchmark decontamination by winnowing.

Of a text's k-gram hashes, the smallest of every ``t - k + 1`` consecutive ones are its fingerprints. Two texts that
share ``t`` words in a row share a fingerprint there, so fingerprints of documents that also occur in the benchmark
are found first and every hit is extended: each ``t``-word window around it is looked up among the benchmark's
windows by its 64-bit hash. Windows have ``WINDOW`` words; a shorter item is a window of its own length, and
documents are fingerprinted once for every such length.

Words are lower-cased (A-Z only) runs of letters, digits and non-ASCII characters. A null or empty text has no words
and no hits, an item without words matches nothing. Repeated items and item ids are found under each of their ids,
null ids are left out. Repeated documents get equal rows; a null doc_id stays null. Empty tables give no rows
(documents) or no hits (benchmark).

The benchmark is a query set: it goes to the tasks in blocks of about ``BLOCK_WINDOWS`` windows (some 50 MB), each of
which is held against all documents, so documents are neither shuffled nor joined with themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.llm.common import cut
from leakscope.llm.wordhash import NOT_ALNUM, Words, byte_table, grams, mix, words

WINDOW = 10
GRAM = 5
BLOCK_WINDOWS = 1 << 21
_TABLE = byte_table(NOT_ALNUM)


def fingerprints(w: Words, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, int]:
    """Word index and hash of the k-grams that are smallest in some window of ``length`` words of one row, and k."""
    k = min(gram, length)
    span = length - k + 1
    at, hashes = grams(w, k)
    n = len(w.hash) - k + 1
    if n < span or not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), k
    value = np.full(n, np.iinfo(np.uint64).max)
    value[at] = hashes
    windows = n - span + 1
    least = value[:windows].copy()
    for j in range(1, span):
        np.minimum(least, value[j:windows + j], out=least)
    whole = w.row[:windows] == w.row[length - 1:]
    chosen = np.zeros(n, bool)
    for j in range(span):
        chosen[j:windows + j] |= whole & (value[j:windows + j] == least)
    found = np.flatnonzero(chosen)
    return found, value[found], k


def _window_hashes(w: Words, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` words from each start."""
    total = np.zeros(len(starts), np.uint64)
    for j in range(length):
        total = mix(total ^ w.hash[starts + j]) + np.uint64(j)
    return mix(total ^ np.uint64(length))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, length, window hash, fingerprint): a row for each window and fingerprint in it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for w in words(batch.column(1), _TABLE):
                for length in np.unique(np.minimum(w.counts[w.counts > 0], window)):
                    at, value, k = fingerprints(w, int(length))
                    of_length = np.minimum(w.counts, window) == length
                    n = len(w.hash) - length + 1
                    starts = np.flatnonzero((w.row[:n] == w.row[length - 1:]) & of_length[w.row[:n]])
                    window_hash = _window_hashes(w, starts, int(length))
                    for shift in range(length - k + 1):
                        place = np.searchsorted(at, starts + shift)
                        ok = (place < len(at)) & (at[np.minimum(place, len(at) - 1)] == starts + shift)
                        rows = w.row[starts[ok]] + w.first
                        yield pa.record_batch([ids.take(pa.array(rows)).cast(pa.string()),
                                               pa.array(np.full(ok.sum(), length, np.int32)),
                                               pa.array(window_hash[ok].view(np.int64)),
                                               pa.array(value[place[ok]].view(np.int64))],
                                              names=["item", "length", "window_hash", "fingerprint"])

    schema = "item string, length int, window_hash bigint, fingerprint bigint"
    return (benchmark.select(F.col("item_id").cast("string"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
            .mapInArrow(read, schema).distinct())


def _hits(w: Words, block: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and hash of every benchmark window that occurs in the words."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for length, (prints, windows) in block.items():
        at, value, k = fingerprints(w, length)
        seen = at[_among(value, prints)]
        if not len(seen):
            continue
        starts = np.unique((seen[:, None] - np.arange(length - k + 1)).ravel())
        starts = starts[(starts >= 0) & (starts + length <= len(w.hash))]
        starts = starts[w.row[starts] == w.row[starts + length - 1]]
        value = _window_hashes(w, starts, length)
        same = _among(value, windows)
        found.append((starts[same], np.full(same.sum(), length), value[same]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def _held_against(docs: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], last: bool) -> DataFrame:
    """``docs(doc_id, text, n_words, spans, windows)`` with the hits of one block added; without text at the end."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1), _TABLE):
                start, length, value = _hits(w, shared.value)
                rows = range(w.first, w.first + w.n_rows)
                before = batch.slice(w.first, w.n_rows)
                spans, hits = [[] for _ in rows], [[] for _ in rows]
                bounds = w.bounds
                for s, n, h in zip(start.tolist(), length.tolist(), value.view(np.int64).tolist()):
                    row = int(w.row[s])
                    s -= int(bounds[row])
                    spans[row].append((s, s + n))
                    hits[row].append(h)
                for row in np.unique(w.row[start]).tolist():
                    spans[row] = _union(spans[row] + [tuple(x.values()) for x in before.column(3)[row].as_py()])
                    hits[row] = sorted({*hits[row], *before.column(4)[row].as_py()})
                untouched = np.setdiff1d(np.flatnonzero(pa.compute.list_value_length(before.column(4))), w.row[start])
                for row in untouched.tolist():
                    spans[row], hits[row] = before.column(3)[row].as_py(), before.column(4)[row].as_py()
                spans = [[x if isinstance(x, dict) else {"from": x[0], "to": x[1]} for x in own] for own in spans]
                columns = [before.column(0), before.column(1), pa.array(w.counts.astype(np.int64)),
                           pa.array(spans, _SPANS), pa.array(hits, pa.list_(pa.int64()))]
                names = ["doc_id", "text", "n_words", "spans", "windows"]
                at = [0, *range(2, 5)] if last else range(5)
                yield pa.record_batch([columns[i] for i in at], names=[names[i] for i in at])

    fields = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "text": "string", "n_words": "bigint",
              "spans": "array<struct<`from`:bigint,`to`:bigint>>", "windows": "array<bigint>"}
    return docs.mapInArrow(read, ", ".join(f"{k} {v}" for k, v in fields.items() if not (last and k == "text")))


_SPANS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted ranges that cover the same places."""
    joined: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if joined and begin <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(joined[-1][1], end))
        else:
            joined.append((begin, end))
    return joined


def _blocks(known: DataFrame, block_windows: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """By length the sorted fingerprints and window hashes of one block after the other."""
    by_window = known.groupBy("length", "window_hash").agg(F.collect_set("fingerprint").alias("prints"))
    n_blocks = max(1, -(-by_window.count() // block_windows))
    for b in range(n_blocks):
        # About block_windows rows come to the driver at a time, whatever the size of the benchmark.
        rows = by_window.where(F.pmod(F.xxhash64("window_hash"), F.lit(n_blocks)) == b).toArrow()
        block = {}
        for length in rows["length"].unique().to_pylist():
            own = rows.filter(pa.compute.equal(rows["length"], length))
            prints = own["prints"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            windows = own["window_hash"].to_numpy()
            block[length] = (np.unique(prints.view(np.uint64)), np.unique(windows.view(np.uint64)))
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Of every document doc_id, n_words, spans (hit ranges of words), n_hit (words in them), items (sorted ids of
    the items with a window in it, as text)."""
    known = cut(benchmark_windows(benchmark, window), "benchmark-windows")
    held = docs.select("doc_id", "text", F.lit(0).cast("bigint").alias("n_words"),
                       F.expr("CAST(array() AS array<struct<`from`:bigint,`to`:bigint>>)").alias("spans"),
                       F.expr("CAST(array() AS array<bigint>)").alias("windows"))
    blocks = list(_blocks(known, block_windows))
    for number, block in enumerate(blocks, 1):
        held = _held_against(held, block, last=number == len(blocks))
    found = cut(held, "benchmark-hits")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["to"] - x["from"])
    found = found.withColumn("n_hit", n_hit)
    # Documents with the same windows have the same items, so these are looked up once for each set of windows.
    hit = found.where("n_hit > 0")
    names = (hit.select("windows").distinct().withColumn("window_hash", F.explode("windows"))
             .join(known.select("window_hash", "item").distinct(), "window_hash")
             .groupBy("windows").agg(F.sort_array(F.collect_set("item")).alias("items")))
    columns = ["doc_id", "n_words", "spans", "n_hit", "items"]
    clean = found.where("n_hit = 0").withColumn("items", F.expr("CAST(array() AS array<string>)"))
    return hit.join(names, "windows").select(columns).unionByName(clean.select(columns))
