"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document joins the queue of its source in shuffled order and gets a virtual finish time: the tokens of
its source up to and including it, divided by the source's target weight. All copies are then taken in the order of
their finish times until the total budget is used. A source's second copies queue behind all its first copies.

Null texts and empty texts have size 0 and are never taken. A null source is a source of its own, last in order. Rows
that are equal in id and text are interchangeable: each is a document with a place of its own in the queue. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import WORD, cut, running_total

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes, which the mix takes
COPIES = 2  # of one document at most, and of a source's size
SEED = "mix-1"


def sizes(docs: DataFrame, seed: str) -> DataFrame:
    """Of every document doc_id, source, size (words of the whole text) and draw, its place in a shuffled order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text)))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
                       F.substring(drawn, 1, 16).alias("draw"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            copies: int = COPIES) -> DataFrame:
    """For each source its source_size, its target (tokens that the mix should take), skipped (tokens of the sources
    before it, nulls first) and the whole budget.

    A level is sought with sum(min(copies * size, weight * level)) = share * all sizes: in the order of
    copies * size / weight sources are full up to some point, all later ones get weight * level. The windows run over
    one row for each source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    totals = totals.select("*", F.get(F.array(*map(F.lit, weights)), place).alias("weight"),
                           (F.col("source_size") * copies).alias("cap"))
    by_fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    totals = totals.select(
        "*",
        F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full"),
        F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        F.coalesce(F.sum("source_size").over(
            Window.orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("skipped"),
        (F.sum("source_size").over(whole) * F.lit(float(share))).alias("budget"))
    level = (F.col("budget") - F.col("full")) / F.col("open")
    # The first source that its share does not fill sets the level; for later ones the quotient is lower.
    level = F.max(F.when(F.col("cap") > F.col("weight") * level, level)).over(whole)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return totals.select("source", "source_size", target.alias("target"), "skipped", "budget")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, copies: int = COPIES,
        seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken (tokens, copies counted) of every document."""
    sized = cut(sizes(docs, seed), "mix-sizes")
    goals = targets(sized, weights, share, copies).withColumnRenamed("source", "__source")
    known = sized.join(goals, sized["source"].eqNullSafe(goals["__source"])).drop("__source")
    queued = running_total(known.where("size > 0"), ["source", "draw", "doc_id"], "size", "ahead", "mix-queue")
    queued = queued.withColumn("ahead", F.col("ahead") - F.col("skipped"))
    turns = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    turns = turns.withColumn("finish", (F.col("ahead") + F.col("copy") * F.col("source_size")) / F.col("target"))
    sorted_turns = running_total(turns, ["finish", "source", "copy", "ahead"], "size", "used", "mix-turns")
    # Within a source the running total is a key of its rows, as sizes are positive.
    taken = F.sum(F.when(F.col("used") <= F.col("budget"), F.col("size")).otherwise(F.lit(0)))
    served = (sorted_turns.groupBy("doc_id", "source", "ahead", "size", "source_size", "target")
              .agg(taken.alias("taken")))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return served.select(columns).unionByName(
        known.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")).select(columns))
