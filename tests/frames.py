"""Small staged and core frames with defaults for the columns a test does not care about."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from leakscope.sources import schemas


def staged(spark, table, *rows):
    schema = schemas.STAGED[table]
    return spark.createDataFrame([tuple(row.get(c) for c in schema.fieldNames()) for row in rows], schema)


def _core(spark, table, defaults, rows):
    schema = schemas.CORE[table]
    return spark.createDataFrame([tuple({**defaults, **row}.get(c) for c in schema.fieldNames()) for row in rows], schema)


def claims(spark, *rows):
    defaults = {"policy_id": 1, "loss_date": date(2000, 1, 1), "loss_state": "IL", "paid_total": Decimal("100"),
                "reserve_total": Decimal("100"), "status": "Open", "adjuster_id": 1}
    filled = [{"claim_number": f"CLM{row['claim_id']:09d}", **row} for row in rows]
    return _core(spark, "core_claims", defaults, filled)


def policies(spark, *rows):
    return _core(spark, "core_policies", {"lob": "GL"}, rows or [{"policy_id": 1}])


def payments(spark, *rows):
    defaults = {"payment_date": date(2001, 1, 1), "vendor_id": "V1", "cost_type": "Medical",
                "amount": Decimal("10"), "check_number": "CHK1"}
    return _core(spark, "core_payments", defaults, rows)


def adjusters(spark, *rows):
    filled = [{"full_name": f"N{row['adjuster_id']}", **row} for row in rows]
    return _core(spark, "core_adjuster", {}, filled)


def notes(spark, *rows):
    return _core(spark, "core_notes", {}, rows)
