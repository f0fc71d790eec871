"""The reporting view: one risk row per claim and duplicate group."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope import config
from leakscope.functions.text import canon_key
from leakscope.operators.copies import expand_copies
from leakscope.plans.clues import duplicate_groups, reserve_is_high, with_lob
from leakscope.plans.core import claim_column, claims_for
from leakscope.sources.storage import write_layer


def mart_claim_risk_signals(
    claims: DataFrame, policies: DataFrame, payments: DataFrame, as_of: datetime, collapse: bool = False
) -> DataFrame:
    """Duplicate hits, reserve flag and risk score.

    As in the reference a claim with several duplicate groups has a row for
    each; ``collapse=True`` adds the hits up to one row per claim. Groups of one
    claim with the same size give equal rows, so they are counted first: even a
    claim with a third of all payments joins with a handful of rows, which are
    expanded after the join.
    """
    groups, by = duplicate_groups(payments), claim_column(payments)
    if collapse:
        hits = groups.groupBy(by).agg(F.sum("dup_count").alias("dup_hits"), F.lit(1).alias("_rows"))
    else:
        hits = groups.groupBy(by, F.col("dup_count").alias("dup_hits")).agg(F.count(F.lit(1)).alias("_rows"))
    flagged = reserve_is_high(as_of, config.RESERVE_AGE_DAYS, config.RESERVE_RATIO)
    scored = (
        claims_for(payments, with_lob(claims, policies))
        .join(hits, by, "left")
        .select(
            "claim_number", "lob", "loss_state", "paid_total", "reserve_total",
            F.coalesce("dup_hits", F.lit(0)).alias("dup_hits"),
            flagged.cast("int").alias("reserve_flag"),
            F.coalesce("_rows", F.lit(1)).cast("bigint").alias("_rows"),
        )
        .withColumn("risk_score", (F.col("dup_hits") + F.col("reserve_flag")).cast("decimal(14,1)"))
    )
    return scored.drop("_rows") if collapse else expand_copies(scored, "_rows").drop("_copy")


def create_risk_view(spark: SparkSession, as_of: datetime | None = None) -> None:
    """Creates the catalog view ``mart.claim_risk_signals_live`` over the tables of ``core``, for any session.

    Each read evaluates it anew on what ``core`` is then, as ``storage.register_layer`` names it after each load, at
    the moment ``as_of`` or, without one, at the time of the read. Views of a catalog that outlives the application
    last as it does.
    """
    moment = "current_timestamp()" if as_of is None else f"TIMESTAMP_NTZ '{as_of}'"
    high = (f"datediff({moment}, c.loss_date) > {config.RESERVE_AGE_DAYS} "
            f"AND c.reserve_total > c.paid_total * {config.RESERVE_RATIO}")
    same = ["p.claim_id", "p.payment_date", canon_key("p.cost_type"), "p.amount", canon_key("p.check_number")]
    spark.sql("CREATE DATABASE IF NOT EXISTS mart")
    spark.sql(f"""
CREATE OR REPLACE VIEW mart.claim_risk_signals_live AS
WITH repeated AS (
  SELECT p.claim_id, count(*) AS dup_hits FROM core.core_payments p GROUP BY {", ".join(same)} HAVING count(*) > 1)
SELECT c.claim_number, o.lob, c.loss_state, c.paid_total, c.reserve_total, coalesce(r.dup_hits, 0) AS dup_hits,
  CAST(coalesce({high}, false) AS int) AS reserve_flag,
  CAST(coalesce(r.dup_hits, 0) + CAST(coalesce({high}, false) AS int) AS decimal(14,1)) AS risk_score
FROM core.core_claims c JOIN core.core_policies o ON o.policy_id = c.policy_id
LEFT JOIN repeated r ON r.claim_id = c.claim_id""")


def load_mart(tables: Mapping[str, DataFrame], base: str, as_of: datetime) -> dict[str, DataFrame]:
    """A new version of the stored mart under ``base``, which any session can read, from
    the stored core tables. It stays readable while core is loaded anew."""
    signals = mart_claim_risk_signals(tables["core_claims"], tables["core_policies"], tables["core_payments"], as_of)
    return write_layer(signals.sparkSession, {"claim_risk_signals": signals}, base, "mart")
