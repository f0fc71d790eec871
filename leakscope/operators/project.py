"""Projection by name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def project(df: DataFrame, **columns: str) -> DataFrame:
    """One column per keyword, computed by its SQL text."""
    return df.selectExpr(*[f"{sql} AS `{name}`" for name, sql in columns.items()])
