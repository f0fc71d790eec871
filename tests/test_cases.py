"""Cases the test tables do not contain."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from leakscope.plans import bi, clues, core, mart, quality
from tests import frames

AS_OF = datetime(2001, 8, 1, 10, 0)
D = Decimal


def test_severity_change(spark):
    """A missing quarter is skipped, a previous average of 0 gives no change, and the
    midnight of the first day is before the cut two years ago at ten o'clock."""
    claims = frames.claims(
        spark,
        {"claim_id": 1, "loss_date": date(2000, 1, 5), "paid_total": D(10), "reserve_total": D(0)},
        {"claim_id": 2, "loss_date": date(2000, 8, 5), "paid_total": D(15), "reserve_total": D(0)},
        {"claim_id": 3, "loss_date": date(1999, 8, 1), "paid_total": D(999)},
        {"claim_id": 4, "loss_date": date(1999, 8, 2), "paid_total": D(0), "reserve_total": D(0)},
        {"claim_id": 5, "loss_date": date(2000, 8, 6), "paid_total": None},
        {"claim_id": 6, "loss_date": None},
    )
    rows = clues.clue1_severity_qoq(claims, frames.policies(spark), AS_OF).collect()
    found = {r.qstart: (r.avg_severity, r.prev_q, r.qoq_change) for r in rows}
    assert found == {
        date(1999, 7, 1): (D(0), None, None),
        date(2000, 1, 1): (D(10), D(0), None),
        date(2000, 7, 1): (D(15), D(10), D("0.5")),
    }
    assert rows[0].qstart == date(2000, 7, 1)


def test_payment_exactly_ninety_days_ago_is_old(spark):
    claims = frames.claims(spark, {"claim_id": 1}, {"claim_id": 2}, {"claim_id": 3}, {"claim_id": 4})
    payments = frames.payments(
        spark,
        {"claim_id": 1, "payment_date": date(2001, 5, 3)},
        {"claim_id": 2, "payment_date": date(2001, 5, 4)},
        {"claim_id": 3, "payment_date": date(2001, 7, 1), "amount": D(5)},
        {"claim_id": 3, "payment_date": date(2001, 7, 1), "amount": D(-5)},
    )
    rows = clues.leakage_scores(claims, payments, AS_OF).collect()
    assert {r.claim_id: (r.total_paid_90, r.leakage_score) for r in rows} == {
        1: (D(0), D("0.5")), 2: (D(10), D("0.0")), 3: (D(0), D("0.5")), 4: (D(0), D("0.5"))}


def test_unknown_inputs_only_void_their_own_term(spark):
    claims = frames.claims(
        spark,
        {"claim_id": 1, "loss_date": None, "reserve_total": D(900)},
        {"claim_id": 2, "paid_total": None, "reserve_total": D(900)},
        {"claim_id": 3, "reserve_total": None},
        {"claim_id": 4, "reserve_total": D(900), "status": "Closed"},
    )
    rows = clues.leakage_scores(claims, frames.payments(spark), AS_OF).collect()
    assert {r.claim_id: r.leakage_score for r in rows} == {1: D("0.5"), 2: D("0.5"), 3: D("0.0"), 4: D("1.5")}


def test_duplicates_group_missing_values_together(spark):
    claims = frames.claims(spark, {"claim_id": 1}, {"claim_id": 2})
    payments = frames.payments(
        spark,
        *[{"claim_id": 1, "check_number": None, "cost_type": None}] * 3,
        *[{"claim_id": 1, "amount": D(20)}] * 2,
        {"claim_id": 2}, {"claim_id": 2, "check_number": "CHK2"},
        *[{"claim_id": 2, "amount": None}] * 2,
        *[{"claim_id": 9}] * 2,
    )
    rows = clues.clue3_duplicate_payments(claims, payments).collect()
    assert [(r.claim_number, r.amount, r.dup_count) for r in rows] == [
        ("CLM000000001", D(10), 3), ("CLM000000001", D(20), 2)]


def test_letter_case_does_not_split_groups(spark):
    claims = frames.claims(spark, {"claim_id": 1})
    payments = frames.payments(
        spark, {"claim_id": 1, "cost_type": "Medical", "check_number": "CHK1"},
        {"claim_id": 1, "cost_type": "medical", "check_number": "chk1"})
    rows = clues.clue3_duplicate_payments(claims, payments).collect()
    assert [(r.cost_type, r.check_number, r.dup_count) for r in rows] == [("Medical", "CHK1", 2)]
    payments = frames.payments(
        spark, *[{"claim_id": 1, "vendor_id": "V1", "amount": D(100 + n)} for n in range(9)],
        {"claim_id": 1, "vendor_id": "v1", "amount": D(104)}, {"claim_id": 1, "vendor_id": "v1", "amount": D(9999)})
    assert [(r.vendor_id, r.amount) for r in clues.clue4_vendor_outliers(payments).collect()] == [("v1", D(9999))]


def test_claim_with_two_duplicate_groups_has_two_rows(spark):
    claims = frames.claims(spark, {"claim_id": 1}, {"claim_id": 2, "reserve_total": D(301)})
    payments = frames.payments(
        spark, *[{"claim_id": 1}] * 2, *[{"claim_id": 1, "amount": D(3)}] * 2, *[{"claim_id": 1, "amount": D(7)}] * 4)
    policies = frames.policies(spark)
    rows = mart.mart_claim_risk_signals(claims, policies, payments, AS_OF).collect()
    assert sorted((r.claim_number[-1], r.dup_hits, r.reserve_flag, r.risk_score) for r in rows) == [
        ("1", 2, 0, D(2)), ("1", 2, 0, D(2)), ("1", 4, 0, D(4)), ("2", 0, 1, D(1))]
    collapsed = mart.mart_claim_risk_signals(claims, policies, payments, AS_OF, collapse=True).collect()
    assert sorted((r.claim_number[-1], r.dup_hits) for r in collapsed) == [("1", 8), ("2", 0)]


def test_outliers_on_both_sides(spark):
    usual = [{"claim_id": 1, "amount": D(100 + n)} for n in range(9)]
    payments = frames.payments(
        spark, *usual, {"claim_id": 1, "amount": D(1)}, *[{"claim_id": 1, "amount": D(500)}] * 2,
        {"claim_id": 1, "vendor_id": None, "amount": D(7)}, {"claim_id": 1, "vendor_id": "V2", "amount": D(9)})
    both = clues.clue4_vendor_outliers(payments).collect()
    assert [(r.vendor_id, r.amount, r.q1, r.q3) for r in both] == [
        ("V1", D(500), 101.75, 107.25), ("V1", D(500), 101.75, 107.25), ("V1", D(1), 101.75, 107.25)]
    assert [r.amount for r in clues.clue4_vendor_outliers(payments, side="low").collect()] == [D(1)]
    assert clues.clue4_vendor_outliers(payments, side="high").count() == 2


def test_vendors_without_a_name_are_one_group(spark):
    payments = frames.payments(
        spark, *[{"claim_id": 1, "vendor_id": None, "amount": D(100 + n)} for n in range(9)],
        {"claim_id": 1, "vendor_id": None, "amount": D(999)})
    assert [(r.vendor_id, r.amount) for r in clues.clue4_vendor_outliers(payments).collect()] == [(None, D(999))]


def test_hierarchy_with_cycle_and_unknown_name(spark):
    adjusters = frames.adjusters(
        spark,
        {"adjuster_id": 1}, {"adjuster_id": 2, "supervisor_id": 1}, {"adjuster_id": 3, "supervisor_id": 2},
        {"adjuster_id": 4, "supervisor_id": 5}, {"adjuster_id": 5, "supervisor_id": 4},
        {"adjuster_id": 6, "supervisor_id": 6}, {"adjuster_id": 7, "supervisor_id": 6},
        {"adjuster_id": 8, "full_name": None}, {"adjuster_id": 9, "supervisor_id": 8},
    )
    claims = frames.claims(
        spark, {"claim_id": 1, "adjuster_id": 3}, {"claim_id": 2, "adjuster_id": 3, "paid_total": None},
        {"claim_id": 3, "adjuster_id": 2, "paid_total": None}, {"claim_id": 4, "adjuster_id": 6})
    rows = clues.clue5_adjuster_hierarchy(adjusters, claims).collect()
    assert {r.adjuster_id: (r.Path, r.claim_count, r.avg_severity) for r in rows} == {
        1: ("N1", 0, D(0)), 2: ("N1->N2", 1, D(0)), 3: ("N1->N2->N3", 2, D(200)), 8: (None, 0, D(0)),
        9: (None, 0, D(0))}
    missing = clues.clue5_unreachable_adjusters(adjusters).collect()
    assert [r.adjuster_id for r in missing] == [4, 5, 6, 7]
    tiers = clues.clue5_severity_by_tier(adjusters, claims).collect()
    assert [(r.depth, r.adjusters, r.claim_count, r.avg_severity) for r in tiers] == [
        (0, 2, 0, D(0)), (1, 2, 1, D(0)), (2, 1, 2, D(200))]


def test_hierarchy_that_is_too_deep(spark):
    chain = frames.adjusters(
        spark, {"adjuster_id": 0}, *[{"adjuster_id": n, "supervisor_id": n - 1} for n in range(1, 5)])
    assert clues.adjuster_tree(chain, max_depth=4).count() == 5
    with pytest.raises(ValueError):
        clues.adjuster_tree(chain, max_depth=3)


def test_phrases_must_share_a_note(spark):
    claims = frames.claims(
        spark, {"claim_id": 1}, {"claim_id": 2}, {"claim_id": 3, "paid_total": None}, {"claim_id": 4})
    notes = frames.notes(
        spark,
        {"claim_id": 1, "note_text": "SUBROGATION"}, {"claim_id": 1, "note_text": "not pursued"},
        {"claim_id": 2, "note_text": "late fnol"}, {"claim_id": 2, "note_text": "Late FNOL, reported after 9 days"},
        {"claim_id": 3, "note_text": "x" * 50_000 + " duplicate BILLING"}, {"claim_id": 9, "note_text": "Duplicate billing"},
    )
    rows = clues.clue6_notes_flags(notes, claims).collect()
    assert [tuple(r) for r in rows] == [(2, 0, 1, 0, D(200)), (3, 0, 0, 1, None)]


def test_rollup_tells_missing_dates_from_totals(spark):
    claims = frames.claims(spark, {"claim_id": 1}, {"claim_id": 2, "loss_date": None}, {"claim_id": 3, "paid_total": None})
    rows = clues.clue7_executive_rollup(frames.policies(spark), claims, with_grouping_id=True).collect()
    assert [tuple(r) for r in rows] == [
        ("ALL LOBs", "ALL States", "ALL DATES", D(400), 7), ("GL", "ALL States", "ALL DATES", D(400), 3),
        ("GL", "IL", "ALL DATES", D(400), 1), ("GL", "IL", "ALL DATES", D(200), 0), ("GL", "IL", "2000-01-01", D(200), 0)]


CLAIM = {"policy_number": "POL000000001", "adjuster_ext_id": "A000000001", "loss_date": "2000-01-01",
         "paid_total": "1", "reserve_total": "2", "loss_state": "IL"}


@pytest.fixture(scope="module")
def staged(spark):
    """Trailing and leading blanks, other case, unknown parents, differing copies, missing status."""
    return {
        "staged_policies": frames.staged(
            spark, "staged_policies", {"policy_number": "pol000000001 ", "lob": "wc"}, {"policy_number": None}),
        "staged_adjuster": frames.staged(
            spark, "staged_adjuster", {"adjuster_ext_id": "A000000001", "supervisor_ext_id": "A000000099"},
            {"adjuster_ext_id": "A000000002 ", "supervisor_ext_id": "a000000001  "},
            {"adjuster_ext_id": " A000000003", "supervisor_ext_id": "A000000001"}),
        "staged_claims": frames.staged(
            spark, "staged_claims",
            {**CLAIM, "claim_number": "CLM000000001 ", "status": "open"},
            {**CLAIM, "claim_number": " clm000000001", "status": "closed"},
            {**CLAIM, "claim_number": "CLM000000002", "policy_number": "POL000000077"},
            {**CLAIM, "claim_number": "CLM000000003", "adjuster_ext_id": "A000000077"},
            {**CLAIM, "claim_number": "CLM000000004", "status": None, "injury_cause": "x" * 31},
            {**CLAIM, "claim_number": "CLM000000005", "policy_number": None}),
        "staged_payments": frames.staged(
            spark, "staged_payments",
            {"claim_number": "clm000000001  ", "payment_date": "1/5/2001", "amount": "10", "cost_type": "INDEMNTY"},
            {"claim_number": " CLM000000001", "payment_date": "2001-01-05", "amount": "10"},
            {"claim_number": "CLM000000002", "payment_date": "2001-01-05", "amount": "10"},
            {"claim_number": "CLM000000004", "payment_date": "never", "amount": "10"},
            {"claim_number": "CLM000000004", "payment_date": "2001-01-05", "amount": "N/A"},
            {"claim_number": "CLM000000004", "payment_date": "2001-01-05", "amount": ""}),
        "staged_notes": frames.staged(
            spark, "staged_notes", {"claim_number": "CLM000000001", "note_time": "soon", "author": "y" * 21, "note_text": "a"},
            {"claim_number": "CLM000000001", "note_text": None}, {"claim_number": "CLM000000002", "note_text": "b"}),
    }


def test_keys_match_without_case_and_trailing_blanks(staged):
    built = core.build_core(staged)
    claims = built["core_claims"].orderBy("claim_id").collect()
    assert [(r.claim_id, r.policy_id, r.adjuster_id) for r in claims] == [(1, 1, 1), (4, 1, 1)]
    assert claims[0].status in ("Open", "Closed") and claims[1].status == "Litigation"
    adjusters = built["core_adjuster"].orderBy("adjuster_id").collect()
    assert [(r.adjuster_id, r.supervisor_id) for r in adjusters] == [(1, None), (2, 1), (3, None)]
    payments = built["core_payments"].orderBy("payment_id").collect()
    assert [(r.payment_id, r.claim_id, r.amount, r.cost_type) for r in payments] == [
        (1, 1, D("10.00"), "Indemnity"), (2, 4, D("0.00"), None)]
    assert [tuple(r) for r in built["core_notes"].collect()] == [(1, 1, None, "y" * 21, "a")]


def test_rejected_rows_and_constraints(staged):
    built = core.build_core(staged, numbered=False)
    rejected = {r.issue: r.cnt for r in quality.qc_rejected_rows(staged, built).collect()}
    assert rejected == {
        "claims_repeated": 1, "claims_unknown_policy": 2, "claims_unknown_adjuster": 1, "payments_unknown_claim": 2,
        "payments_unreadable": 2, "notes_unknown_claim": 1, "notes_without_text": 1}
    violations = {r["check"]: r.cnt for r in quality.qc_constraints(built).collect()}
    assert {name: n for name, n in violations.items() if n} == {"length_injury_cause": 1, "length_author": 1}


def test_constraints_report_repeated_keys_and_orphans(spark):
    built = {
        "core_policies": frames.policies(spark, {"policy_id": 1, "policy_number": "P"}, {"policy_id": 2, "policy_number": "p "}),
        "core_adjuster": frames.adjusters(
            spark, {"adjuster_id": 1, "adjuster_ext_id": "A1", "supervisor_id": 7}, {"adjuster_id": 1}),
        "core_claims": frames.claims(spark, {"claim_id": 1, "policy_id": 5}, {"claim_id": 1, "adjuster_id": None}),
        "core_payments": frames.payments(spark, {"claim_id": 8}, {"claim_id": 1}),
        "core_notes": frames.notes(spark, {"claim_id": 9, "note_text": "a"}),
    }
    violations = {r["check"]: r.cnt for r in quality.qc_constraints(built).collect()}
    assert {name: n for name, n in violations.items() if n} == {
        "unique_policy_number": 1, "unique_adjuster_id": 1, "unique_claim_number": 1, "unique_claim_id": 1,
        "claim_policy_reference": 1, "adjuster_supervisor_reference": 1, "payment_claim_reference": 1,
        "note_claim_reference": 1}


def test_high_severity_adjusters(spark):
    adjusters = frames.adjusters(spark, *[{"adjuster_id": n, "office": "Madison"} for n in range(1, 8)])
    claims = frames.claims(spark, *[
        {"claim_id": n, "adjuster_id": n, "paid_total": D(100 * n if n < 6 else 9000)} for n in range(1, 7)])
    rows = bi.bi_adjuster_performance(adjusters, claims).collect()
    assert [(r.adjuster_id, r.claim_count, r.high_severity) for r in rows] == [
        (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, 0), (6, 1, 1), (7, 0, 0)]
    assert rows[0].workload_share == D("0.166667")
