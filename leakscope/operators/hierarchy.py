"""Depths and paths in a parent-child table, from the roots down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.sources.storage import cut


def climb(nodes: DataFrame, node: str, parent: str, max_depth: int) -> list[DataFrame]:
    """The states of all nodes after 1, 2, 4, … hops towards their roots: (_node, _top, _hops, _open).

    An open row has made all its hops and stands at ``_top``; a closed one has reached its root after ``_hops``. In a
    round every open row takes over where the row of its ``_top`` stands, so a hierarchy of depth 100 takes seven
    rounds of one join each on three numbers a node, written to the shared folder. Rows in a cycle, or below one, stay
    open and never grow. As depths have no gaps, the walk is over when no closed row is at the limit of its round.
    Raises when there are more than ``max_depth`` levels below the roots.
    """
    state = nodes.select(
        F.col(node).alias("_node"), F.coalesce(parent, node).alias("_top"),
        F.when(F.col(parent).isNull(), 0).otherwise(1).alias("_hops"), F.col(parent).isNotNull().alias("_open"))
    rounds = [cut(state, "tree")]
    reach = 1
    while True:
        reach *= 2
        state = rounds[-1]
        above = state.select(F.col("_node").alias("_at"), F.col("_top").alias("_next"), F.col("_hops").alias("_more"),
                             F.col("_open").alias("_still"))
        # Closed rows pass by: their key is NULL and joins with nothing.
        stepped = state.join(above, F.when(F.col("_open"), F.col("_top")) == F.col("_at"), "left").select(
            "_node", F.coalesce("_next", "_top").alias("_top"), (F.col("_hops") + F.coalesce("_more", F.lit(0)))
            .alias("_hops"), F.coalesce("_still", "_open").alias("_open"),
            (F.col("_open") & F.col("_at").isNull()).alias("_lost"))  # a parent that is no node
        rounds.append(cut(stepped.where("NOT _lost").drop("_lost"), "tree-round"))
        deepest = rounds[-1].where("NOT _open").agg(F.max("_hops")).first()[0]
        if deepest is not None and deepest > max_depth:
            raise ValueError(f"the hierarchy is deeper than {max_depth} levels")
        if deepest is None or deepest < reach - 1:
            return rounds


def depths(rounds: list[DataFrame], node: str) -> DataFrame:
    """(node, depth) of the nodes that reach a root."""
    return rounds[-1].where("NOT _open").select(F.col("_node").alias(node), F.col("_hops").alias("depth"))


def paths(rounds: list[DataFrame], nodes: DataFrame, node: str, label: str, separator: str = "->") -> DataFrame:
    """(node, depth, Path) of the nodes that reach a root: the labels from there, NULL if one of them is.

    Every node is a row for each of its steps; the ancestor so many steps above is found by the hops of 1, 2, 4, … that
    add up to the step. Labels are joined once, at the end.
    """
    steps = depths(rounds, "_node").select(
        "_node", "depth", F.col("_node").alias("_at"), F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("_step"))
    for bit, state in enumerate(rounds[:-1]):
        hop = state.where("_open").select(F.col("_node").alias("_from"), F.col("_top").alias("_to"))
        wanted = F.when(F.col("_step").bitwiseAND(F.lit(1 << bit)) != 0, F.col("_at"))
        steps = steps.join(hop, wanted == F.col("_from"), "left").select(
            "_node", "depth", "_step", F.coalesce("_to", "_at").alias("_at"))
    named = steps.join(nodes.select(F.col(node).alias("_at"), F.col(label).alias("_label")), "_at")
    listed = named.groupBy("_node", "depth").agg(
        F.sort_array(F.collect_list(F.struct("_step", "_label")), asc=False).alias("_steps"))
    labels = F.transform("_steps", lambda step: step["_label"])
    whole = F.when(F.forall(labels, lambda name: name.isNotNull()), F.array_join(labels, separator))
    return listed.select(F.col("_node").alias(node), "depth", whole.alias("Path"))
