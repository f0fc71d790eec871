"""The seven analyses.

``payments`` and ``notes`` may be the core tables or the conformed rows they are
made of. Unreadable payments are left out while counting and, where the analysis
joins with the claims, so are the rows of unknown claims.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope import config
from leakscope.config import KeywordRule, first_day_not_before, years_before
from leakscope.functions.dates import quarter_start
from leakscope.functions.money import from_micro, micro_avg, relative_change, truncated_avg
from leakscope.functions.text import canon_key, has_phrases
from leakscope.operators.hierarchy import climb, depths, paths
from leakscope.operators.quantiles import join_null_safe, quantiles
from leakscope.plans.core import claim_column, claims_for, is_readable
from leakscope.sources.storage import cut, from_day

DUPLICATE_KEY = ["payment_date", "_cost_type", "amount", "_check_number"]


def severity() -> Column:
    """Paid plus reserve; NULL when either is."""
    return F.col("paid_total") + F.col("reserve_total")


def age_days(as_of: datetime) -> Column:
    return F.datediff(F.lit(as_of.date()), F.col("loss_date"))


def reserve_is_high(as_of: datetime, age: int, ratio: int) -> Column:
    """Old claim whose reserve is far above what was paid; unknown counts as no."""
    return F.coalesce(
        (age_days(as_of) > age) & (F.col("reserve_total") > F.col("paid_total") * ratio), F.lit(False)
    )


def with_lob(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with their line of business, unless it was carried along already."""
    if "lob" in claims.columns:
        return claims
    return claims.join(policies.select("policy_id", "lob"), "policy_id")


def quarterly_severity(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Average severity per line, state and quarter with the change on the quarter before.

    The quarter before is the previous one that has claims. The window runs on
    one row per line, state and quarter.
    """
    quarters = (
        with_lob(claims, policies)
        .groupBy("lob", "loss_state", F.expr(quarter_start("loss_date")).alias("qstart"))
        .agg(F.sum(severity()).alias("_total"), F.count(severity()).alias("_claims"))
        .withColumn("_avg", micro_avg(F.col("_total"), F.col("_claims")))
    )
    before = Window.partitionBy("lob", "loss_state").orderBy(F.col("qstart").asc_nulls_first())
    return quarters.withColumn("_prev", F.lag("_avg").over(before)).select(
        "lob",
        "loss_state",
        "qstart",
        from_micro(F.col("_avg")).alias("avg_severity"),
        from_micro(F.col("_prev")).alias("prev_q"),
        relative_change(F.col("_avg"), F.col("_prev")).alias("qoq_change"),
    )


def clue1_severity_qoq(
    claims: DataFrame, policies: DataFrame, as_of: datetime, years: int = config.SEVERITY_YEARS
) -> DataFrame:
    """Where average severity rose most from one quarter to the next."""
    since = first_day_not_before(years_before(as_of, years))
    recent = from_day(claims, "loss_date", since)
    return quarterly_severity(recent, policies).orderBy(
        F.col("qoq_change").desc_nulls_last(), "lob", "loss_state", "qstart"
    )


def leakage_scores(
    claims: DataFrame, payments: DataFrame, as_of: datetime, age: int = config.RESERVE_AGE_DAYS,
    ratio: int = config.RESERVE_RATIO, quiet_days: int = config.QUIET_DAYS,
) -> DataFrame:
    """Every claim with its payments of the last ``quiet_days`` and its score.

    Older payments add nothing to the sum, so they are filtered out before the
    payments are added up per claim, and the sums before the join.
    """
    since = first_day_not_before(as_of - timedelta(days=quiet_days))
    by = claim_column(payments)
    recent = (
        from_day(payments, "payment_date", since)
        .groupBy(by)
        .agg(F.sum("amount").alias("_recent"))
    )
    paid = F.coalesce(F.col("_recent"), F.lit(0)).cast("decimal(28,2)")
    one, half, zero = (F.lit(score).cast("decimal(2,1)") for score in ("1.0", "0.5", "0.0"))
    quiet = F.coalesce((F.col("total_paid_90") == 0) & (F.col("reserve_total") > 0), F.lit(False))
    high = reserve_is_high(as_of, age, ratio)
    return (
        claims_for(payments, claims).join(recent, by, "left")
        .withColumn("total_paid_90", paid)
        .select(
            *[c for c in ("claim_id",) if c in claims.columns], "claim_number", "loss_date", "status",
            age_days(as_of).alias("loss_age_days"),
            "paid_total", "reserve_total", "total_paid_90",
            (F.when(high, one).otherwise(zero) + F.when(quiet, half).otherwise(zero))
            .cast("decimal(2,1)").alias("leakage_score"),
        )
    )


def clue2_reserve_flags(
    claims: DataFrame, payments: DataFrame, as_of: datetime, age: int = config.RESERVE_AGE_DAYS,
    ratio: int = config.RESERVE_RATIO, quiet_days: int = config.QUIET_DAYS, n: int = 100,
) -> DataFrame:
    """The ``n`` claims with the highest leakage score, then the highest reserve."""
    return (
        leakage_scores(claims, payments, as_of, age, ratio, quiet_days)
        .orderBy(F.col("leakage_score").desc(), F.col("reserve_total").desc_nulls_last(), "claim_number")
        .limit(n)
    )


def duplicate_groups(payments: DataFrame) -> DataFrame:
    """Payments equal in claim, date, cost type, amount and check, where there are several.

    NULLs count as equal, and so do letter cases and trailing blanks; a group
    shows its least spelling. Counted before the shuffle as well, and only
    groups of two or more go on.
    """
    spelled = payments.withColumns({f"_{c}": F.expr(canon_key(c)) for c in ("cost_type", "check_number")})
    groups = spelled.groupBy(claim_column(payments), *DUPLICATE_KEY).agg(
        F.count_if(is_readable()).alias("dup_count"),
        # Rows that are not counted don't lend the group their spelling either.
        *[F.min(F.when(is_readable(), F.col(c))).alias(c) for c in ("cost_type", "check_number")])
    return groups.where("dup_count > 1").drop("_cost_type", "_check_number")


def clue3_duplicate_payments(claims: DataFrame, payments: DataFrame) -> DataFrame:
    by = claim_column(payments)
    return (
        duplicate_groups(payments)
        .join(claims_for(payments, claims).select(by, "claim_number"), by)
        .select("claim_number", "payment_date", "cost_type", "amount", "check_number", "dup_count")
        .orderBy(F.col("dup_count").desc(), F.col("amount").desc_nulls_last(), "claim_number", "check_number")
    )


def clue4_vendor_outliers(payments: DataFrame, k: float = config.IQR_FACTOR, side: str = "both") -> DataFrame:
    """Payments outside the interquartile fences of their vendor, repeats included.

    Spellings that differ in letter case are one vendor, and each payment shows its own. Conformed payments are written
    once, so that they are cleaned only once; stored ones are read as they are, and only their two columns.
    """
    rows = payments.select(
        "vendor_id", "amount", F.expr(canon_key("vendor_id")).alias("_vendor"), is_readable().alias("_readable"))
    if claim_column(payments) == "claim_key":
        rows = cut(rows, "vendor-amounts")
    rows = rows.where("_readable").drop("_readable")
    quartiles = quantiles(rows, ["_vendor"], "amount", 2, {"q1": 0.25, "q3": 0.75})
    amount, spread = F.col("amount").cast("double"), F.col("q3") - F.col("q1")
    outside = {
        "high": amount > F.col("q3") + spread * k,
        "low": amount < F.col("q1") - spread * k,
    }
    wanted = outside["high"] | outside["low"] if side == "both" else outside[side]
    return (
        join_null_safe(rows, quartiles, ["_vendor"])
        .where(wanted)
        .orderBy(F.col("amount").desc(), "vendor_id")
        .select("vendor_id", "amount", "q1", "q3")
    )


def claims_per_adjuster(claims: DataFrame) -> DataFrame:
    """Number of claims and severity sum per adjuster, combined before the shuffle."""
    return claims.groupBy("adjuster_id").agg(
        F.count(F.lit(1)).alias("_claims"),
        F.sum(severity()).alias("_total"),
        F.count(severity()).alias("_valued"),
    )


def adjuster_depths(adjusters: DataFrame, max_depth: int = config.MAX_HIERARCHY_DEPTH) -> DataFrame:
    """(adjuster_id, depth) of the adjusters below those without a supervisor."""
    return depths(climb(adjusters, "adjuster_id", "supervisor_id", max_depth), "adjuster_id")


def adjuster_tree(adjusters: DataFrame, max_depth: int = config.MAX_HIERARCHY_DEPTH) -> DataFrame:
    """The adjusters of :func:`adjuster_depths` with depth and Path."""
    rounds = climb(adjusters, "adjuster_id", "supervisor_id", max_depth)
    found = paths(rounds, adjusters, "adjuster_id", "full_name")
    return adjusters.join(found, "adjuster_id")


def clue5_adjuster_hierarchy(
    adjusters: DataFrame, claims: DataFrame, max_depth: int = config.MAX_HIERARCHY_DEPTH
) -> DataFrame:
    """Adjusters below the ones without a supervisor, with their claims.

    Adjusters in a cycle, or below one, are not reached; see
    :func:`clue5_unreachable_adjusters`.
    """
    no_claims = F.lit(0).cast("decimal(38,6)")
    return (
        adjuster_tree(adjusters, max_depth)
        .join(claims_per_adjuster(claims), "adjuster_id", "left")
        .select(
            "adjuster_id", "full_name", "supervisor_id", "Path",
            F.coalesce("_claims", F.lit(0)).alias("claim_count"),
            F.coalesce(truncated_avg(F.col("_total"), F.col("_valued")), no_claims).alias("avg_severity"),
        )
        .orderBy(F.col("avg_severity").desc(), "adjuster_id")
    )


def clue5_severity_by_tier(
    adjusters: DataFrame, claims: DataFrame, max_depth: int = config.MAX_HIERARCHY_DEPTH
) -> DataFrame:
    """Average severity of all claims of each depth of the hierarchy."""
    return (
        adjuster_depths(adjusters, max_depth)
        .join(claims_per_adjuster(claims), "adjuster_id", "left")
        .groupBy("depth")
        .agg(
            F.count(F.lit(1)).alias("adjusters"),
            F.coalesce(F.sum("_claims"), F.lit(0)).alias("claim_count"),
            F.sum("_total").alias("_total"),
            F.sum("_valued").alias("_valued"),
        )
        .select(
            "depth", "adjusters", "claim_count",
            F.coalesce(truncated_avg(F.col("_total"), F.col("_valued")), F.lit(0).cast("decimal(38,6)"))
            .alias("avg_severity"),
        )
        .orderBy("depth")
    )


def clue5_unreachable_adjusters(
    adjusters: DataFrame, max_depth: int = config.MAX_HIERARCHY_DEPTH
) -> DataFrame:
    """Adjusters the hierarchy never reaches, because of a cycle above them."""
    reached = adjuster_depths(adjusters, max_depth).select("adjuster_id")
    return (
        adjusters.join(reached, "adjuster_id", "left_anti")
        .select("adjuster_id", "full_name", "supervisor_id")
        .orderBy("adjuster_id")
    )


def flagged_claims(
    notes: DataFrame, claims: DataFrame, rules: tuple[KeywordRule, ...] = config.DEFAULT_KEYWORDS
) -> DataFrame:
    """Claims with a note that raises a flag. Phrases of a rule must share a note.

    Notes without any flag cannot matter and stop at the scan.
    """
    flags, by = [rule.flag for rule in rules], claim_column(notes)
    marked = notes.selectExpr(by, *[f"{has_phrases('note_text', rule)} AS {rule.flag}" for rule in rules])
    per_claim = (
        marked.where(" OR ".join(flags))
        .groupBy(by)
        .agg(*[F.max(F.col(flag).cast("int")).alias(flag) for flag in flags])
    )
    # The number of a claim is shown where the claims have it; sums over flagged claims do without.
    shown = [c for c in ("claim_id",) if c in claims.columns]
    known = claims_for(notes, claims).select(*{by: None, **dict.fromkeys(shown)}, severity().alias("incurred"))
    return per_claim.join(known, by).select(*shown, *flags, "incurred")


def clue6_notes_flags(
    notes: DataFrame, claims: DataFrame, rules: tuple[KeywordRule, ...] = config.DEFAULT_KEYWORDS
) -> DataFrame:
    """Claims with red flags in their notes, the costliest first."""
    return flagged_claims(notes, claims, rules).orderBy(F.col("incurred").desc_nulls_last(), "claim_id")


def clue7_executive_rollup(policies: DataFrame, claims: DataFrame, with_grouping_id: bool = False) -> DataFrame:
    """Incurred by line, state and day with state, line and grand totals.

    Claims are added up per line, state and day once; only these rows are
    repeated for the four grouping sets. A missing date has the label of a total;
    the grouping id tells them apart.
    """
    daily = (
        with_lob(claims, policies)
        .groupBy("lob", "loss_state", "loss_date")
        .agg(F.sum(severity()).alias("_incurred"))
    )
    lob, state, day = F.col("lob"), F.col("loss_state"), F.col("loss_date")
    totals = daily.groupingSets(
        [[lob, state, day], [lob, state], [lob], []], lob, state, day
    ).agg(F.sum("_incurred").cast("decimal(38,2)").alias("incurred"), F.grouping_id().cast("int").alias("_gid"))
    ordered = totals.select(
        F.col("lob").alias("_lob"), F.col("loss_state").alias("_state"), F.col("loss_date").alias("_day"),
        "incurred", "_gid",
    ).orderBy(
        F.col("_lob").asc_nulls_first(), F.col("_state").asc_nulls_first(), F.col("_day").asc_nulls_first(),
        F.col("_gid").desc(),
    )
    gid = [F.col("_gid").alias("grouping_id")] if with_grouping_id else []
    return ordered.select(
        F.coalesce("_lob", F.lit("ALL LOBs")).alias("lob"),
        F.coalesce("_state", F.lit("ALL States")).alias("loss_state"),
        F.coalesce(F.date_format("_day", "yyyy-MM-dd"), F.lit("ALL DATES")).alias("loss_date"),
        "incurred",
        *gid,
    )
