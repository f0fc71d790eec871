"""Datasets behind the four report pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leakscope import config
from leakscope.functions.money import truncated_avg
from leakscope.operators.quantiles import quantiles
from leakscope.plans import clues
from leakscope.sources.storage import cut

_RATIO = "decimal(18,4)"


# Page 1: claim risk drivers


def bi_reserve_adequacy(claims: DataFrame, policies: DataFrame, as_of: datetime) -> DataFrame:
    """Reserve against paid by line and state, with the number of flagged claims."""
    flagged = clues.reserve_is_high(as_of, config.RESERVE_AGE_DAYS, config.RESERVE_RATIO)
    sums = clues.with_lob(claims, policies).groupBy("lob", "loss_state").agg(
        F.count(F.lit(1)).alias("claims"),
        F.sum("reserve_total").alias("reserve_total"),
        F.sum("paid_total").alias("paid_total"),
        F.count_if(flagged).alias("flagged_claims"),
    )
    ratio = F.col("reserve_total").cast("double") / F.nullif(F.col("paid_total").cast("double"), F.lit(0.0))
    return sums.select(
        "lob", "loss_state", "claims", "reserve_total", "paid_total",
        ratio.cast(_RATIO).alias("reserve_to_paid"), "flagged_claims",
    ).orderBy("lob", "loss_state")


def bi_rate_trend(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Quarterly severity over all dated claims."""
    dated = claims.where(F.col("loss_date").isNotNull())
    return clues.quarterly_severity(dated, policies).orderBy("lob", "loss_state", "qstart")


def bi_leakage_distribution(claims: DataFrame, payments: DataFrame, as_of: datetime) -> DataFrame:
    """Claims and reserve per leakage score."""
    return (
        clues.leakage_scores(claims, payments, as_of)
        .groupBy("leakage_score")
        .agg(F.count(F.lit(1)).alias("claims"), F.sum("reserve_total").alias("reserve_total"))
        .orderBy("leakage_score")
    )


# Page 2: adjuster performance


def bi_adjuster_performance(adjusters: DataFrame, claims: DataFrame) -> DataFrame:
    """Workload and severity per adjuster; high severity is above the upper
    interquartile fence of all adjusters that have claims.

    The figures per adjuster are written once, as the fence, the total and the
    result all need them.
    """
    measured = cut(
        clues.claims_per_adjuster(claims).select(
            "adjuster_id",
            F.col("_claims").alias("claim_count"),
            truncated_avg(F.col("_total"), F.col("_valued")).alias("avg_severity"),
        ),
        "adjuster-figures",
    )
    averages = measured.select(F.lit(0).alias("_all"), "avg_severity")
    # Bands of some thousand units first, so all adjusters together are a few bands.
    quartiles = quantiles(averages, ["_all"], "avg_severity", 6, {"q1": 0.25, "q3": 0.75}, widths=(32, 16, 0))
    fence = quartiles.select(F.col("q3") + (F.col("q3") - F.col("q1")) * config.IQR_FACTOR).scalar()
    whole = measured.agg(F.sum("claim_count")).scalar()
    return (
        adjusters.join(measured, "adjuster_id", "left")
        .select(
            "adjuster_id", "full_name", "office",
            F.coalesce("claim_count", F.lit(0)).alias("claim_count"),
            "avg_severity",
            (F.coalesce("claim_count", F.lit(0)).cast("double") / whole).cast("decimal(18,6)").alias("workload_share"),
            F.coalesce((F.col("avg_severity").cast("double") > fence).cast("int"), F.lit(0)).alias("high_severity"),
        )
        .orderBy("adjuster_id")
    )


def bi_office_performance(adjusters: DataFrame, claims: DataFrame) -> DataFrame:
    """Adjusters, claims, severity and workload share per office."""
    measured = clues.claims_per_adjuster(claims)
    offices = adjusters.join(measured, "adjuster_id", "left").groupBy("office").agg(
        F.count(F.lit(1)).alias("adjusters"),
        F.coalesce(F.sum("_claims"), F.lit(0)).alias("claim_count"),
        F.sum("_total").alias("_total"),
        F.sum("_valued").alias("_valued"),
    )
    # Every claim has a known adjuster, so the offices add up to all claims; a row per office is summed here.
    whole = F.nullif(F.sum("claim_count").over(Window.partitionBy()), F.lit(0))
    return offices.select(
        "office", "adjusters", "claim_count",
        truncated_avg(F.col("_total"), F.col("_valued")).alias("avg_severity"),
        (F.col("claim_count").cast("double") / whole).cast("decimal(18,6)").alias("workload_share"),
    ).orderBy("office")


# Page 3: leakage flags


def bi_leakage_flags(notes: DataFrame, claims: DataFrame) -> DataFrame:
    """Claims and incurred per kind of flag; a claim counts under each of its flags."""
    flags = [rule.flag for rule in config.DEFAULT_KEYWORDS]
    return (
        clues.flagged_claims(notes, claims)
        .unpivot(["incurred"], flags, "flag", "raised")
        .where("raised = 1")
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("claims"), F.sum("incurred").cast("decimal(38,2)").alias("incurred"))
        .orderBy("flag")
    )


# Page 4: executive roll-ups


def bi_executive_kpis(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Incurred by line and state with line and grand totals."""
    lob, state = F.col("lob"), F.col("loss_state")
    sums = clues.with_lob(claims, policies).groupBy("lob", "loss_state").agg(
        F.count(F.lit(1)).alias("_claims"), F.sum(clues.severity()).alias("_incurred")
    )
    totals = sums.groupingSets([[lob, state], [lob], []], lob, state).agg(
        F.sum("_claims").alias("claims"),
        F.sum("_incurred").cast("decimal(38,2)").alias("incurred"),
        F.grouping_id().cast("int").alias("grouping_id"),
    )
    return totals.select(
        F.coalesce("lob", F.lit("ALL LOBs")).alias("lob"),
        F.coalesce("loss_state", F.lit("ALL States")).alias("loss_state"),
        "claims", "incurred", "grouping_id",
    ).orderBy("grouping_id", "lob", "loss_state")
