"""Exact interpolated quantiles of decimal columns for groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. A group with a third of all rows would be
handled by one task, so the wanted ranks are narrowed down by histograms instead. The first has wide bands of values, a
count for each group and band, added up before the shuffle; running sums over a group's few bands tell which of them
hold a wanted rank. Only rows of those bands are counted again in narrower bands, at last of one value each. What is
shuffled are counts of bands, never the groups' values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.sources.storage import cut

#: The bands' widths in bits of the smallest unit, for amounts in cents; the last ones are single values.
WIDTHS = (14, 0)


def join_null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on columns where NULL keys form a group of their own."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns])
    return left.join(renamed, same).drop(*[f"_right_{c}" for c in columns])


def _position(p: float) -> Column:
    return F.lit(p) * (F.col("_total") - 1)


def _bands(counted: DataFrame, by: list[str], start: Column, total: Column | None) -> DataFrame:
    """Bands of a histogram with the number of values before them in their group, and in the whole group."""
    in_order = Window.partitionBy(*by).orderBy("_band")
    return counted.withColumn("_total", F.sum("_inside").over(Window.partitionBy(*by)) if total is None else total) \
        .withColumn("_before", start + F.sum("_inside").over(in_order) - F.col("_inside"))


def quantiles(
    rows: DataFrame, by: list[str], value: str, scale: int, wanted: dict[str, float], widths: tuple[int, ...] = ()
) -> DataFrame:
    """One row per group with a double column per wanted quantile of ``value``; NULL values don't count.

    ``scale`` is the number of decimals of ``value``. A quantile p lies at position p * (n - 1) and is interpolated
    between the two values around it. ``rows`` is read once for each of ``widths``, so it should be stored.
    """
    units = rows.where(F.col(value).isNotNull()).select(
        *by, (F.col(value) * F.lit(10**scale)).cast("bigint").alias("_units"))
    ranks = {f"{name}_{end}": f(_position(p)) for name, p in wanted.items()
             for end, f in (("low", F.floor), ("high", F.ceil))}

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_inside"))

    needed = reduce(lambda a, b: a | b, [holds(rank) for rank in ranks.values()])
    found, before = None, 0
    for bits in widths or WIDTHS:
        band = F.shiftright("_units", bits).alias("_band")
        if found is None:
            counted = units.groupBy(*by, band).agg(F.count(F.lit(1)).alias("_inside"))
            histogram = _bands(counted, by, F.lit(0), None)
        else:
            # Each wider band that holds a rank is counted anew; ranks go on from what lies before it.
            wide = found.withColumnRenamed("_band", "_wide").select(*by, "_wide", "_before", "_total")
            inside = join_null_safe(units.withColumn("_wide", F.shiftright("_units", before)), wide,
                                    [*by, "_wide"])
            counted = inside.groupBy(*by, "_wide", "_before", "_total", band).agg(
                F.count(F.lit(1)).alias("_inside"))
            histogram = _bands(counted.withColumnRenamed("_before", "_start"), [*by, "_wide"], F.col("_start"),
                               F.col("_total"))
        found = cut(histogram.where(needed).select(*by, "_band", "_inside", "_before", "_total"), "bands")
        before = bits
    picked = found.groupBy(*by).agg(
        F.max("_total").alias("_total"),
        *[F.max(F.when(holds(rank), F.col("_band"))).alias(name) for name, rank in ranks.items()])

    def interpolated(name: str, p: float) -> Column:
        # In smallest units, where quartiles are exact, so that only the division rounds.
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return (low + (high - low) * (_position(p) - F.floor(_position(p)))) / F.lit(float(10**scale))

    return picked.select(*by, *[interpolated(name, p).alias(name) for name, p in wanted.items()])
