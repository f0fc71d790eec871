"""Row counts and sums that the staging rules must lead to (sf0.001)."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def tables(spark, small):
    return entry.Tables(spark, small)


@pytest.fixture(scope="module")
def run(spark, small):
    return lambda name: entry.queries()[name](spark, small)


def test_layer_counts(run):
    assert {r.Src: r.Counts for r in run("staged_counts").collect()} == {
        "policies": 150, "claims": 1542, "payments": 6087, "adjuster": 10, "notes": 1000}
    assert {r.t: r.cnt for r in run("core_counts").collect()} == {
        "core_policies": 150, "core_claims": 1441, "core_payments": 4829, "core_adjuster": 10, "core_notes": 933}
    assert {r.issue: r.cnt for r in run("qc_rejected_rows").collect()} == {
        "claims_repeated": 42, "claims_unknown_policy": 36, "claims_unknown_adjuster": 23, "payments_unknown_claim": 417,
        "payments_unreadable": 898, "notes_unknown_claim": 54, "notes_without_text": 16}


def test_cleaned_values(tables):
    nulls = tables.claims.agg(*[
        F.count_if(F.col(c).isNull()).alias(c)
        for c in ("loss_date", "report_date", "incurred_total", "paid_total", "reserve_total")
    ], F.count_if(F.col("paid_total") == 0).alias("unpaid")).first()
    assert tuple(nulls) == (136, 225, 172, 168, 163, 78)
    assert {r.lob: r["count"] for r in tables.policies.groupBy("lob").count().collect()} == {
        "AUTO": 16, "GL": 70, "WC": 64}
    assert tables.policies.where("expiration_date IS NULL").count() == 34


def test_keys_have_several_forms(tables):
    keys = tables.claim_numbers.selectExpr("key", "rlike(key, '^CLM[0-9]{9}$') AS nine", "rlike(key, '^CLM[0-9]{6}$') AS six")
    found = keys.agg(F.count_if("nine"), F.count_if("six"), F.count_if(F.col("key").contains("/"))).first()
    assert sum(found) == keys.count() and min(found) > 100


def test_clue_counts(run):
    trend = run("clue1_severity_qoq")
    assert (trend.count(), trend.where("prev_q IS NOT NULL").count()) == (96, 80)
    scores = run("clue2_leakage_scores").groupBy("leakage_score").count().collect()
    assert {str(r.leakage_score): r["count"] for r in scores} == {"0.0": 454, "0.5": 939, "1.0": 9, "1.5": 39}
    groups = run("clue3_duplicate_payments")
    assert (groups.count(), groups.agg(F.max("dup_count")).first()[0]) == (68, 2)
    assert run("clue4_vendor_outliers").count() == run("clue4_vendor_outliers_high").count() == 74
    assert [(r.depth, r.adjusters) for r in run("clue5_severity_by_tier").collect()] == [(0, 1), (1, 3), (2, 6)]
    flags = run("clue6_notes_flags")
    assert flags.count() == 490
    assert tuple(flags.agg(F.sum("missed_subrogation"), F.sum("missed_FNOL"), F.sum("dup_billing")).first()) == (
        141, 155, 194)
    rollup = run("clue7_executive_rollup")
    assert rollup.count() == 1294
    grand = rollup.where("lob = 'ALL LOBs'").first().incurred
    assert grand == Decimal("16190417.66")
    detail_without_date = run("clue7_executive_rollup_ids").where("grouping_id = 0 AND loss_date = 'ALL DATES'")
    assert detail_without_date.count() == 11
    assert run("mart_claim_risk_signals").count() == 1442


def test_totals_lead_the_rollup(run):
    first = run("clue7_executive_rollup").first()
    assert (first.lob, first.loss_state, first.loss_date) == ("ALL LOBs", "ALL States", "ALL DATES")


def test_properties(run, spark):
    assert run("mart_claim_risk_signals").where("risk_score <> dup_hits + reserve_flag").count() == 0
    assert run("clue6_notes_flags").where("missed_subrogation + missed_FNOL + dup_billing = 0").count() == 0
    high = run("clue4_vendor_outliers_high")
    assert high.where("NOT cast(amount AS double) > q3 + 1.5 * (q3 - q1)").count() == 0
    top = run("clue2_reserve_flags")
    assert top.count() == 100
    assert top.where("date_add(loss_date, loss_age_days) <> DATE '2001-08-01'").count() == 0
    assert top.where(
        "leakage_score = 1.5 AND NOT (loss_age_days > 365 AND reserve_total > 3 * paid_total AND total_paid_90 = 0)"
    ).count() == 0
    scores = [r.leakage_score for r in top.collect()]
    assert scores == sorted(scores, reverse=True)
