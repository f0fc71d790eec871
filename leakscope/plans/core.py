"""Cleaning and conforming: messy staging to typed core tables.

Rows refer to each other by business keys. ``conform_*`` and ``resolved_claims`` keep the canonical keys (``policy_key``,
``adjuster_key``, ``claim_key``), which analyses of raw tables join on; core tables have dense numbers in their place,
which a stored dictionary gives to keys. Nothing is parsed from a key and nothing is hashed, so keys may have any form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions.dates import parse_date, parse_datetime
from leakscope.functions.money import parse_money
from leakscope.functions.text import (
    canon_key, clean_text, clean_upper, norm_cost_type, norm_lob, norm_loss_state, norm_policy_state, norm_status,
    row_digest,
)
from leakscope.operators.dedup import keep_one
from leakscope.operators.keys import number_keys, number_rows
from leakscope.operators.project import project
from leakscope.sources import schemas
from leakscope.sources.storage import Version, cut, temporary_cuts

NO_CLAIM_NUMBER = -1  # the claim_id of the one claim without a number


def _columns(table: str) -> list[str]:
    return schemas.CORE[table].fieldNames()


def _key_of(kind: str, given: str) -> str:
    return f"{canon_key(f'trim({given})')} AS {kind}"


#: Staging table and column of each kind of business key.
KEYS = {
    "policy": ("staged_policies", "policy_number"),
    "adjuster": ("staged_adjuster", "adjuster_ext_id"),
    "claim": ("staged_claims", "claim_number"),
}


def staged_keys(staged: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """The canonical keys of one kind, one row for each staged row."""
    table, column = KEYS[kind]
    return staged[table].selectExpr(_key_of("key", column))


def _numbered(frame: DataFrame, kind: str, numbers: DataFrame) -> DataFrame:
    return frame.join(numbers.selectExpr(f"key AS {kind}_key", f"number AS {kind}_id"), f"{kind}_key", "left")


def conform_policies(staged: DataFrame) -> DataFrame:
    return project(
        staged.where("policy_number IS NOT NULL"),
        policy_key=canon_key("trim(policy_number)"),
        policy_number="trim(policy_number)",
        insured_name=clean_text("insured_name"),
        lob=norm_lob("lob"),
        effective_date=parse_date("effective_date"),
        expiration_date=parse_date("expiration_date"),
        state=norm_policy_state("state"),
        broker_code=clean_text("broker_code"),
    )


def core_policies(staged: DataFrame, numbers: DataFrame) -> DataFrame:
    return _numbered(conform_policies(staged), "policy", numbers).select(*_columns("core_policies"))


def conform_adjusters(staged: DataFrame) -> DataFrame:
    """Adjusters before their supervisor is resolved, enough to resolve claims with."""
    return project(
        staged.where("adjuster_ext_id IS NOT NULL"),
        adjuster_key=canon_key("trim(adjuster_ext_id)"),
        adjuster_ext_id="trim(adjuster_ext_id)",
        full_name=clean_text("full_name"),
        hire_date=parse_date("hire_date"),
        office=clean_text("office"),
        # Only a staged id without leading blanks finds its own loaded row again.
        _supervisor_key=f"if(startswith(adjuster_ext_id, ' '), NULL, {canon_key('supervisor_ext_id')})",
    )


def core_adjuster(staged: DataFrame, numbers: DataFrame) -> DataFrame:
    """Adjusters with their supervisor resolved; an unknown supervisor is NULL."""
    adjusters = _numbered(conform_adjusters(staged), "adjuster", numbers)
    supervisors = project(adjusters, supervisor_id="adjuster_id", _supervisor_key="adjuster_key")
    return adjusters.join(supervisors, "_supervisor_key", "left").select(*_columns("core_adjuster"))


def unique_claims(staged: DataFrame) -> DataFrame:
    """Cleaned staged claims, one per claim number, with the keys to resolve."""
    claims = project(
        staged,
        claim_key=canon_key("trim(claim_number)"),
        claim_number="trim(claim_number)",
        loss_date=parse_date("loss_date"),
        report_date=parse_date("report_date"),
        injury_cause=clean_text("injury_cause"),
        body_part=clean_text("body_part"),
        claimant_id=clean_text("claimant_id"),
        loss_state=norm_loss_state("loss_state"),
        incurred_total=parse_money("incurred_total"),
        paid_total=parse_money("paid_total"),
        reserve_total=parse_money("reserve_total"),
        status=norm_status("status"),
        policy_key=canon_key("trim(policy_number)"),
        adjuster_key=canon_key("trim(adjuster_ext_id)"),
        # The reference keeps any of the copies; the digest makes it the same one every time.
        _order=row_digest(schemas.STAGED["staged_claims"].fieldNames()),
    )
    return keep_one(claims, ["claim_key"], F.col("_order")).drop("_order")


def resolved_claims(
    staged: DataFrame, policies: DataFrame, adjusters: DataFrame, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Typed claims with known policy and adjuster; unmatched claims are dropped.

    The parents are conformed rows or core tables; their numbers are taken along where they have them. ``carry`` names
    policy columns to take along, which saves an analysis that needs them a second join with the policies.
    """
    with_policy = [c for c in ("policy_id", *carry) if c in policies.columns]
    with_adjuster = [c for c in ("adjuster_id",) if c in adjusters.columns]
    policy_keys = policies.selectExpr(f"{canon_key('policy_number')} AS policy_key", *with_policy)
    adjuster_keys = adjusters.selectExpr(f"{canon_key('adjuster_ext_id')} AS adjuster_key", *with_adjuster)
    return unique_claims(staged).join(policy_keys, "policy_key").join(adjuster_keys, "adjuster_key")


def with_claim_ids(claims: DataFrame, numbers: DataFrame) -> DataFrame:
    """Resolved claims with their ``claim_id``."""
    no_key = F.col("claim_key").isNull()
    return _numbered(claims, "claim", numbers).withColumn(
        "claim_id", F.when(no_key, F.lit(NO_CLAIM_NUMBER)).otherwise(F.col("claim_id")).cast("bigint"))


def core_claims(staged: DataFrame, policies: DataFrame, adjusters: DataFrame, numbers: DataFrame) -> DataFrame:
    """``policies`` and ``adjusters`` are core tables."""
    resolved = resolved_claims(staged, policies, adjusters)
    return with_claim_ids(resolved, numbers).select(*_columns("core_claims"))


def conform_payments(staged: DataFrame) -> DataFrame:
    """Cleaned payments, neither checked for a readable amount and date nor for their claim.

    Analyses take these where they drop the unreadable rows while counting and
    join with the claims anyway. That saves a second shuffle of all payments.
    The count of rows is there as Spark moves no filter below an observed metric: neither one on parsed values nor the
    one on keys that a join brings along is worked out a second time, from the text and before the rows are dealt out.
    """
    cleaned = project(
        staged,
        claim_key=canon_key("claim_number"),  # with leading blanks it equals no claim's key
        payment_date=parse_date("payment_date"),
        payee_type=clean_upper("payee_type"),
        vendor_id=clean_text("vendor_id"),
        cost_type=norm_cost_type("cost_type"),
        cost_category=clean_upper("cost_category"),
        amount=parse_money("amount"),
        check_number=clean_text("check_number"),
    )
    return cleaned.observe("cleaned_payments", F.count(F.lit(1)).alias("rows"))


def is_readable() -> Column:
    """Core payments have an amount and a date."""
    return F.col("amount").isNotNull() & F.col("payment_date").isNotNull()


def claim_column(children: DataFrame) -> str:
    """How these payments or notes name their claim: core tables by its number, conformed rows by its key."""
    return "claim_key" if "claim_key" in children.columns else "claim_id"


def claims_for(children: DataFrame, claims: DataFrame) -> DataFrame:
    """``claims`` with the column that ``children`` name them by."""
    if claim_column(children) in claims.columns:
        return claims
    return claims.withColumn("claim_key", F.expr(canon_key("claim_number")))


def known_claims_only(children: DataFrame, claims: DataFrame) -> DataFrame:
    """Rows whose claim exists."""
    column = claim_column(children)
    return children.join(claims_for(children, claims).select(column), column, "left_semi")


def with_claim(children: DataFrame, claims: DataFrame) -> DataFrame:
    """Conformed rows of known claims with the claim's number. Claims are unique, so no row comes twice."""
    return children.join(claims_for(children, claims).select("claim_key", "claim_id"), "claim_key")


def core_payments(staged: DataFrame, claims: DataFrame) -> DataFrame:
    """Payments numbered 1, 2, 3, … in the order of all their columns; ``claims`` have claim_id."""
    readable = conform_payments(staged).where(is_readable())
    payments = with_claim(readable, claims).select(*_columns("core_payments")[1:])
    return number_rows(payments, payments.columns, "payment_id")


def conform_notes(staged: DataFrame) -> DataFrame:
    """Cleaned notes that have a text, claims not yet checked."""
    return project(
        staged.where("note_text IS NOT NULL"),
        claim_key=canon_key("claim_number"),
        note_time=parse_datetime("note_time"),
        author=clean_text("author"),
        note_text="note_text",
    )


def core_notes(staged: DataFrame, claims: DataFrame) -> DataFrame:
    """Notes numbered 1, 2, 3, … in the order of all their columns; ``claims`` have claim_id."""
    notes = with_claim(conform_notes(staged), claims).select(*_columns("core_notes")[1:])
    return number_rows(notes, notes.columns, "note_id")


def build_core(
    staged: Mapping[str, DataFrame], numbered: bool = True, written: Mapping[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """The five core tables from the five staging tables, keys numbered as by a first load.

    With ``numbered=False`` payments and notes come without their row numbers. Tables named by ``written`` are written
    with these columns, for whoever reads them more than once; the tables that refer to them go on from what is written.
    """
    def kept(name: str, frame: DataFrame) -> DataFrame:
        return cut(frame.select(*written[name]), name) if written and name in written else frame

    numbers = {kind: number_keys(staged_keys(staged, kind))[0] for kind in KEYS}
    policies = kept("core_policies", core_policies(staged["staged_policies"], numbers["policy"]))
    adjusters = kept("core_adjuster", core_adjuster(staged["staged_adjuster"], numbers["adjuster"]))
    claims = kept("core_claims", core_claims(staged["staged_claims"], policies, adjusters, numbers["claim"]))
    if numbered:
        payments = core_payments(staged["staged_payments"], claims)
        notes = core_notes(staged["staged_notes"], claims)
    else:
        payments = with_claim(conform_payments(staged["staged_payments"]).where(is_readable()), claims)
        notes = with_claim(conform_notes(staged["staged_notes"]), claims)
    return {
        "core_policies": policies, "core_adjuster": adjusters, "core_claims": claims,
        "core_payments": kept("core_payments", payments), "core_notes": kept("core_notes", notes),
    }


def _placed(children: DataFrame, name: str) -> DataFrame:
    """Rows with a number from the place where their task has them, until the writing task gives the final one.

    Spark doesn't move a filter below these numbers, so one on parsed values doesn't parse them a second time.
    """
    return children.withColumn(name, F.monotonically_increasing_id() + 1)


def load_core(staged: Mapping[str, DataFrame], base: str) -> dict[str, DataFrame]:
    """Full refresh of the stored core tables under ``base``; returns the stored tables.

    Everything is written into a new version, which readers see as a whole once it is complete; a load that dies leaves
    the one before as it is. Business keys keep the numbers of earlier loads. A policy or adjuster number that is there
    twice would multiply claims, so it stops the load with a ValueError. Payments and notes are joined with the stored
    claims and written once, each with a number of its place.
    """
    spark = staged["staged_policies"].sparkSession
    with temporary_cuts(spark):
        version = Version(spark, base, "core")
        numbers, repeated = {}, []
        for kind, (table, column) in KEYS.items():
            known = version.previous(f"{kind}_numbers", schemas.NUMBERS)
            found, twice = number_keys(staged_keys(staged, kind), known)
            if twice is not None and kind != "claim":
                repeated.append(f"{table}.{column} {twice}")
            numbers[kind] = version.write(f"{kind}_numbers", found)
        if repeated:
            raise ValueError("keys are not unique, nothing was loaded: " + "; ".join(repeated))
        policies = version.write("core_policies", core_policies(staged["staged_policies"], numbers["policy"]))
        adjusters = version.write("core_adjuster", core_adjuster(staged["staged_adjuster"], numbers["adjuster"]))
        claims = version.write(
            "core_claims", core_claims(staged["staged_claims"], policies, adjusters, numbers["claim"]))
        payments = _placed(with_claim(conform_payments(staged["staged_payments"]), claims), "payment_id")
        version.write("core_payments", payments.where(is_readable()).select(*_columns("core_payments")), "payment_id")
        notes = _placed(with_claim(conform_notes(staged["staged_notes"]), claims), "note_id")
        version.write("core_notes", notes.select(*_columns("core_notes")), "note_id")
        return version.publish()
