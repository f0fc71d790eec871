"""Counts, previews and data-quality checks of the layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions.text import canon_key
from leakscope.plans.core import conform_payments, is_readable, unique_claims
from leakscope.sources import schemas


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _labelled_counts(tables: dict[str, DataFrame], label: str, count: str) -> DataFrame:
    return _union(
        [
            table.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
            for name, table in tables.items()
        ]
    )


def staged_counts(staged: Mapping[str, DataFrame]) -> DataFrame:
    order = ("policies", "claims", "payments", "adjuster", "notes")
    return _labelled_counts({name: staged[f"staged_{name}"] for name in order}, "Src", "Counts")


def core_counts(core: dict[str, DataFrame]) -> DataFrame:
    order = ("core_policies", "core_claims", "core_payments", "core_adjuster", "core_notes")
    return _labelled_counts({name: core[name] for name in order}, "t", "cnt")


def _issues(df: DataFrame, conditions: dict[str, Column], label: str = "issue") -> DataFrame:
    """One row per condition with the number of rows that meet it, in one pass."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])
    return counted.unpivot([], list(conditions), label, "cnt")


def qc_missing_fk(claims: DataFrame) -> DataFrame:
    """Claims without policy or adjuster. The load drops such rows, so both are 0;
    :func:`qc_rejected_rows` counts what was dropped."""
    return _issues(
        claims,
        {
            "claims_missing_policy": F.col("policy_id").isNull(),
            "claims_missing_adjuster": F.col("adjuster_id").isNull(),
        },
    )


def qc_money_nulls(claims: DataFrame, n: int | None = 20) -> DataFrame:
    """Claims without incurred or paid amount; ``n=None`` gives all of them."""
    missing = claims.where(F.col("incurred_total").isNull() | F.col("paid_total").isNull()).select(
        "claim_number", "incurred_total", "paid_total", "reserve_total"
    )
    return missing if n is None else missing.orderBy("claim_number").limit(n)


def qc_rejected_rows(staged: Mapping[str, DataFrame], core: Mapping[str, DataFrame]) -> DataFrame:
    """How many staged rows each load left out, by reason, in one pass per table.

    A claim without policy and adjuster counts under both reasons.
    """
    def known(keys: DataFrame, flag: str) -> DataFrame:
        return keys.distinct().withColumn(flag, F.lit(True))

    policy_keys = core["core_policies"].selectExpr(f"{canon_key('policy_number')} AS policy_key")
    adjuster_keys = core["core_adjuster"].selectExpr(f"{canon_key('adjuster_ext_id')} AS adjuster_key")
    claim_keys = known(core["core_claims"].selectExpr(f"{canon_key('claim_number')} AS claim_key"), "_claim")
    unknown_claim = F.col("_claim").isNull()

    claims = (
        unique_claims(staged["staged_claims"])
        .join(known(policy_keys, "_policy"), "policy_key", "left")
        .join(known(adjuster_keys, "_adjuster"), "adjuster_key", "left")
    )
    repeated = (
        staged["staged_claims"].select(F.lit(1).alias("_sign"))
        .unionByName(unique_claims(staged["staged_claims"]).select(F.lit(-1).alias("_sign")))
        .agg(F.coalesce(F.sum("_sign"), F.lit(0)).alias("cnt"))
        .select(F.lit("claims_repeated").alias("issue"), "cnt")
    )
    payments = conform_payments(staged["staged_payments"]).join(claim_keys, "claim_key", "left")
    notes = staged["staged_notes"].selectExpr(
        f"{canon_key('claim_number')} AS claim_key", "note_text IS NULL AS _empty"
    ).join(claim_keys, "claim_key", "left")
    return _union(
        [
            repeated,
            _issues(claims, {
                "claims_unknown_policy": F.col("_policy").isNull(),
                "claims_unknown_adjuster": F.col("_adjuster").isNull(),
            }),
            _issues(payments, {"payments_unknown_claim": unknown_claim, "payments_unreadable": ~is_readable()}),
            _issues(notes, {"notes_unknown_claim": unknown_claim, "notes_without_text": F.col("_empty")}),
        ]
    )


def _count_as(df: DataFrame, name: str, label: str = "issue") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias(label), "cnt")


def _repeated_keys(df: DataFrame, key: Column, name: str) -> DataFrame:
    repeated = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    return _count_as(repeated, name, "check")


#: Columns that :func:`qc_constraints` reads of the tables it reads more than once.
CHECKED = {
    "core_policies": ["policy_id", "policy_number"],
    "core_adjuster": ["adjuster_id", "adjuster_ext_id", "supervisor_id"],
    "core_claims": ["claim_id", "claim_number", "policy_id", "adjuster_id", "injury_cause", "body_part"],
    "core_notes": ["claim_id", "author"],
}


def qc_constraints(core: dict[str, DataFrame]) -> DataFrame:
    """Violations of the declared keys, references and lengths. Out: check, cnt.

    Seven checks read the claims, so ``core`` should be stored tables or have ``CHECKED`` written. References are counted
    by value before they are matched, so few rows are shuffled for the match however many refer to a parent.
    """
    claims, policies, adjusters = core["core_claims"], core["core_policies"], core["core_adjuster"]

    def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
        keys = parent.select(F.col(parent_key).alias(column)).distinct()
        named = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
        missing = named.join(keys, column, "left_anti").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("cnt"))
        return missing.select(F.lit(name).alias("check"), "cnt")

    checks = [
        _repeated_keys(policies, F.expr(canon_key("policy_number")), "unique_policy_number"),
        _repeated_keys(policies, F.col("policy_id"), "unique_policy_id"),
        _repeated_keys(adjusters, F.expr(canon_key("adjuster_ext_id")), "unique_adjuster_ext_id"),
        _repeated_keys(adjusters, F.col("adjuster_id"), "unique_adjuster_id"),
        _repeated_keys(claims, F.expr(canon_key("claim_number")), "unique_claim_number"),
        _repeated_keys(claims, F.col("claim_id"), "unique_claim_id"),
        orphans(claims, "policy_id", policies, "policy_id", "claim_policy_reference"),
        orphans(claims, "adjuster_id", adjusters, "adjuster_id", "claim_adjuster_reference"),
        orphans(adjusters, "supervisor_id", adjusters, "adjuster_id", "adjuster_supervisor_reference"),
        orphans(core["core_payments"], "claim_id", claims, "claim_id", "payment_claim_reference"),
        orphans(core["core_notes"], "claim_id", claims, "claim_id", "note_claim_reference"),
    ]
    limits: dict[str, dict[str, Column]] = {}
    for table, column, limit in schemas.LENGTH_LIMITS:
        limits.setdefault(table, {})[f"length_{column}"] = F.length(column) > limit
    checks += [_issues(core[table], conditions, "check") for table, conditions in limits.items()]
    return _union(checks)


def preview(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows in key order."""
    return df.orderBy(*[F.col(column).asc_nulls_first() for column in order]).limit(n)
