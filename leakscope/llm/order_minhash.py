"""Order MinHash fingerprints with DataFrame functions only.

A text's tokens are its runs of non-white-space characters, in pieces of at most ``PIECE`` characters; its k-mers are
``K`` tokens in a row (a text with fewer tokens has one k-mer of them all, an empty one the empty k-mer). Equal k-mers
are numbered by occurrence, so they differ. Each numbered k-mer falls into one of ``BUCKETS`` by its hash; of each
bucket the ``CHOSEN`` minimal ones are selected, put back into text order and hashed as a tuple. The fingerprint is the
list of these hashes with their buckets; two texts are as alike as the share of equal hashes among the buckets that
either text fills. Changed places and changed order both lose tuples, as edits do.

All of it is one expression over a row: sorts of long arrays in which hash and position are packed together, no
shuffle, no Python. Null counts as empty. A text may have 2**26 tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import cut

PIECE = 16
K = 3
CHOSEN = 2
BUCKETS = 32
_BUCKET_BITS = 5
_PLACE_BITS = 26
_PLACE = (1 << _PLACE_BITS) - 1
_HASH = -1 << _PLACE_BITS


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas inside of it use it many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(ordered: Column, part: Callable[[Column], Column]) -> Column:
    """Indexes at which ``part`` of a sorted array's values changes."""
    return F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                    lambda i: (i == 0) | (part(F.get(ordered, i)) != part(F.get(ordered, i - 1))))


def _packed_kmers(tokens: Column) -> Column:
    """Sorted hashes of the k-mers, their places in the lower bits."""
    places = F.sequence(F.lit(0), F.greatest(F.size(tokens) - K, F.lit(0)))
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(K)])
                         .bitwiseAND(F.lit(_HASH)).bitwiseOR(i.cast("bigint")))
    return F.sort_array(hashed)


def _numbered(kmers: Column) -> Column:
    """Sorted hashes of (k-mer, occurrence), places in the lower bits."""
    def number(starts: Column) -> Column:
        runs = F.transform(starts, lambda begin, r: F.sequence(
            F.lit(0), F.coalesce(F.get(starts, r + 1), F.size(kmers)) - begin - 1))
        return _let(F.flatten(runs), lambda occurrence: F.sort_array(F.transform(
            kmers, lambda x, i: F.xxhash64(x.bitwiseAND(F.lit(_HASH)), F.get(occurrence, i))
            .bitwiseAND(F.lit(_HASH)).bitwiseOR(x.bitwiseAND(F.lit(_PLACE))))))
    return _let(_starts(kmers, lambda x: x.bitwiseAND(F.lit(_HASH))), number)


def _bucket(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - _BUCKET_BITS)


def _tuples(numbered: Column) -> Column:
    """For each bucket in use an int: the bucket above, the hash of its tuple below."""
    def one(starts: Column) -> Column:
        def tuple_hash(begin: Column, r: Column) -> Column:
            n = F.least(F.coalesce(F.get(starts, r + 1), F.size(numbered)) - begin, F.lit(CHOSEN))
            in_text_order = F.sort_array(F.transform(
                F.slice(numbered, begin + 1, n),
                lambda x: F.shiftleft(x.bitwiseAND(F.lit(_PLACE)), 64 - _PLACE_BITS - 1)
                .bitwiseOR(F.shiftrightunsigned(x, _PLACE_BITS + 1))))
            value = _let(in_text_order, lambda items: F.xxhash64(*[
                F.get(items, F.lit(j)).bitwiseAND(F.lit((1 << 37) - 1)) for j in range(CHOSEN)]))
            low = F.shiftrightunsigned(value, 32 + _BUCKET_BITS)
            return _bucket(F.get(numbered, begin)) * (1 << (32 - _BUCKET_BITS)) + low
        return F.transform(starts, tuple_hash)
    return F.sort_array(_let(_starts(numbered, _bucket), one))


def fingerprint(text: Column) -> Column:
    """Array of longs below 2**32: the upper bits are the bucket."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,%d}" % PIECE), F.lit(0))
    return _let(_let(_let(tokens, _packed_kmers), _numbered), _tuples)


def as_text(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the buckets that a or b fills."""
    def buckets(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 32 - _BUCKET_BITS))
    either = F.size(F.array_union(buckets(a), buckets(b)))
    return F.size(F.array_intersect(a, b)).cast("double") / either


def following(docs: DataFrame) -> DataFrame:
    """(key, doc_id, next_key, want) of each id, which key names as text: the next greater id, after the last the
    first; want is the largest quarter of a text of that id, in code points. Ids are dealt by range, written once and
    chained within the ranges."""
    ids = docs.groupBy("doc_id").agg(F.max(F.floor(F.coalesce(F.char_length("text"), F.lit(0)) / 4)).alias("want"))
    ranged = cut(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    whole = Window.orderBy("part")
    first = F.min(F.struct("doc_id"))  # null is the least
    parts = ranged.groupBy("part").agg(first.alias("first")).select(
        "part", F.coalesce(F.lead("first").over(whole), F.first("first").over(
            whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = Window.partitionBy("part").orderBy("doc_id")
    chained = ranged.join(F.broadcast(parts), "part")  # as many rows as there are partitions
    return chained.select(
        _key(F.col("doc_id")).alias("key"), "doc_id", "want",
        _key(F.coalesce(F.lead(F.struct("doc_id")).over(inside), F.col("after")).getField("doc_id")).alias("next_key"))


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the start of the next document.

    Rows with the same doc_id have the same next document; of several rows with the next id the least text counts.
    Both joins with the texts take the same columns by the same key, so the texts are shuffled once.
    """
    texts = docs.select(_key(F.col("doc_id")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    chain = following(docs)
    back = chain.select(F.col("next_key").alias("key"), F.col("key").alias("to_key"), "want")
    starts = (texts.join(back, "key")
              .select("to_key", F.expr("substring(text, 1, cast(want as int))").alias("start"))
              .groupBy("to_key").agg(F.min("start").alias("start")))
    n = F.char_length("text")
    kept, taken = (n - F.floor(n / 4)).cast("int"), F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("start", F.lit(1), taken))
    both = (texts.join(starts.withColumnRenamed("to_key", "key"), "key")
            .select("key", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
            .select("key", "n_chars", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
                    fingerprint(F.col("text")).alias("prints"), fingerprint(F.col("edited")).alias("edited_prints")))
    rows = cut(both, "fingerprints")
    nexts = rows.groupBy("key").agg(F.min("prints").alias("next_prints"))
    ahead = (chain.select(F.col("next_key").alias("key"), F.col("key").alias("own"), "doc_id")
             .join(nexts, "key").drop("key").withColumnRenamed("own", "key"))
    return (rows.join(ahead, "key")
            .select("doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"),
                    as_text(F.col("prints")).alias("fingerprint"),
                    as_text(F.col("edited_prints")).alias("edited_fingerprint"),
                    likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
                    likeness(F.col("prints"), F.col("next_prints")).alias("near_next")))
