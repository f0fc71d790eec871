"""Money from free text and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_money(text: str) -> str:
    """Amount of a text column as decimal(18,2).

    An empty text is 0.00, the word NULL and anything unreadable is NULL. A
    dollar sign and thousands commas are accepted, an exponent is not. Words
    never reach the cast, as each failed one costs a caught error.
    """
    first = ", ".join(str(ord(mark)) for mark in "0123456789+-.$,")
    plain = f"translate(trim({text}), 'Ee$,', 'xx')"
    amount = f"CASE WHEN ascii(trim({text})) IN ({first}) THEN try_cast({plain} AS decimal(19,4))"
    return f"cast({amount} WHEN trim({text}) = '' THEN 0 END AS decimal(18,2))"


def whole_div(dividend: Column, divisor: Column) -> Column:
    """Whole-number quotient, truncated toward zero; NULL for a zero divisor."""
    return F.call_function("div", dividend, F.nullif(divisor, F.lit(0).cast("bigint")))


def micro_avg(total: Column, count: Column) -> Column:
    """Average of a decimal sum in millionths, truncated (not rounded), as bigint."""
    return whole_div(total.cast("decimal(31,2)") * F.lit(1000000), count)


def from_micro(units: Column) -> Column:
    """Millionths as decimal(38,6), exact."""
    return (units.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(38,6)")


def truncated_avg(total: Column, count: Column) -> Column:
    """Average with six decimals, truncated; NULL when nothing was counted."""
    return from_micro(micro_avg(total, count))


def relative_change(current: Column, previous: Column) -> Column:
    """(current - previous) / previous of two whole-number columns, four decimals.

    The quotient is truncated at six decimals and then rounded half up to four,
    which equals rounding the exact quotient.
    """
    change = (current - previous).cast("decimal(20,0)") * F.lit(1000000)
    return from_micro(whole_div(change, previous)).cast("decimal(10,4)")
