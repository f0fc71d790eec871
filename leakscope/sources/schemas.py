"""Declared schemas: text-only staging, typed core. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


STAGED = {
    "staged_policies": _text(
        "policy_number", "insured_name", "lob", "effective_date", "expiration_date", "state", "broker_code"
    ),
    "staged_claims": _text(
        "claim_number", "policy_number", "loss_date", "report_date", "injury_cause", "body_part", "claimant_id",
        "loss_state", "incurred_total", "paid_total", "reserve_total", "status", "adjuster_ext_id",
    ),
    "staged_payments": _text(
        "payment_ext_id", "claim_number", "payment_date", "payee_type", "vendor_id", "cost_type", "cost_category",
        "amount", "check_number",
    ),
    "staged_adjuster": _text("adjuster_ext_id", "full_name", "hire_date", "office", "supervisor_ext_id"),
    "staged_notes": _text("claim_number", "note_time", "author", "note_text"),
}

_MONEY = T.DecimalType(18, 2)
_KINDS = {
    "id": T.LongType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "time": T.TimestampNTZType(),
    "money": _MONEY,
}


def _typed(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in kinds.items()])


CORE = {
    "core_policies": _typed(
        policy_id="id", policy_number="text", insured_name="text", lob="text", effective_date="date",
        expiration_date="date", state="text", broker_code="text",
    ),
    "core_adjuster": _typed(
        adjuster_id="id", adjuster_ext_id="text", full_name="text", hire_date="date", office="text",
        supervisor_id="id",
    ),
    "core_claims": _typed(
        claim_id="id", claim_number="text", policy_id="id", loss_date="date", report_date="date",
        injury_cause="text", body_part="text", claimant_id="text", loss_state="text", incurred_total="money",
        paid_total="money", reserve_total="money", status="text", adjuster_id="id",
    ),
    "core_payments": _typed(
        payment_id="id", claim_id="id", payment_date="date", payee_type="text", vendor_id="text",
        cost_type="text", cost_category="text", amount="money", check_number="text",
    ),
    "core_notes": _typed(note_id="id", claim_id="id", note_time="time", author="text", note_text="text"),
}

# Stored tables that are laid out by the month of a date: the column of the month's first day, and the date.
MONTHS = {"core_claims": ("loss_month", "loss_date"), "core_payments": ("payment_month", "payment_date")}

# The dictionary of each kind of business key, stored beside the core tables.
NUMBERS = _typed(key="text", number="id")

MART = {
    "claim_risk_signals": T.StructType([
        *_typed(claim_number="text", lob="text", loss_state="text", paid_total="money", reserve_total="money",
                dup_hits="id"),
        T.StructField("reserve_flag", T.IntegerType()), T.StructField("risk_score", T.DecimalType(14, 1)),
    ]),
}

# Lengths the typed tables declare below the staged lengths (table, column, limit).
LENGTH_LIMITS = (
    ("core_claims", "injury_cause", 30),
    ("core_claims", "body_part", 30),
    ("core_notes", "author", 20),
)

# Test tables the staging rules read, with the columns they use.
TEST_TABLES = {
    "customer": "c_custkey bigint, c_name string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}
