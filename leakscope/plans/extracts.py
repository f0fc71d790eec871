"""The published CSV extracts: UTF-8 with byte-order mark, CRLF, header line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.plans import clues
from leakscope.plans.mart import mart_claim_risk_signals

_BYTE_ORDER_MARK = "\ufeff"


def extract_clue1(claims: DataFrame, policies: DataFrame, as_of: datetime, n: int = 5) -> DataFrame:
    return clues.clue1_severity_qoq(claims, policies, as_of).limit(n)


def extract_clue2(claims: DataFrame, payments: DataFrame, as_of: datetime, n: int = 100) -> DataFrame:
    return clues.clue2_reserve_flags(claims, payments, as_of, n=n)


def extract_clue4_high(payments: DataFrame, n: int = 50) -> DataFrame:
    return clues.clue4_vendor_outliers(payments, side="high").limit(n)


def extract_clue6(notes: DataFrame, claims: DataFrame, n: int = 50) -> DataFrame:
    return clues.clue6_notes_flags(notes, claims).limit(n)


def extract_risk(
    claims: DataFrame, policies: DataFrame, payments: DataFrame, as_of: datetime, n: int = 50
) -> DataFrame:
    return (
        mart_claim_risk_signals(claims, policies, payments, as_of)
        .orderBy(F.col("risk_score").desc(), F.col("reserve_total").desc_nulls_last(), "claim_number")
        .limit(n)
    )


def _plain(number: Column) -> Column:
    """A double without exponent and trailing zeros, such as 1370.5 or 2724."""
    text = number.cast("decimal(38,6)").cast("string")
    return F.regexp_replace(text, r"[.]?0+$", "")


def write_csv(df: DataFrame, path: str) -> None:
    """One small result as a folder with one CSV file. The rows keep their order."""
    shown = df.select(
        *[_plain(F.col(name)).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]
    )
    first, *rest = shown.columns
    marked = shown.toDF(_BYTE_ORDER_MARK + first, *rest)
    marked.coalesce(1).write.mode("overwrite").options(header=True, lineSep="\r\n", encoding="UTF-8").csv(path)


def export_extracts(core: dict[str, DataFrame], as_of: datetime, path: str) -> None:
    """Writes the five published extracts, each of at most 100 rows."""
    claims, policies = core["core_claims"], core["core_policies"]
    payments, notes = core["core_payments"], core["core_notes"]
    extracts = {
        "clue1_severity_hotspots_top5.csv": extract_clue1(claims, policies, as_of),
        "clue2_reserve_flags_top100.csv": extract_clue2(claims, payments, as_of),
        "clue4_vendor_outliers_high_top50.csv": extract_clue4_high(payments),
        "clue6_notes_flags_top50.csv": extract_clue6(notes, claims),
        "claim_risk_signals_top50.csv": extract_risk(claims, policies, payments, as_of),
    }
    for name, extract in extracts.items():
        write_csv(extract, f"{path}/{name}")
