"""Every cleaning rule on every kind of mess."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leakscope.config import KeywordRule, first_day_not_before, years_before
from leakscope.functions import dates, money, text


def evaluate(spark, sql, values):
    rows = spark.createDataFrame([(at, value) for at, value in enumerate(values)], "at int, x string")
    return [row[0] for row in rows.orderBy("at").select(F.expr(sql)).collect()]


def check(spark, sql, cases):
    assert dict(zip(cases, evaluate(spark, sql, list(cases)))) == cases


DAY = date(2024, 1, 5)


def test_dates(spark):
    check(spark, dates.parse_date("x"), {
        "2024-01-05": DAY, "2024-1-5": DAY, "01/05/2024": DAY, "1/5/2024": DAY, "05-Jan-2024": DAY,
        "5-JAN-2024": DAY, "20240105": DAY, " 2024-01-05 ": DAY, "2024-01-05 10:00": DAY,
        "2024-01-05T10:00:07": DAY, "": None, "  ": None, "NULL": None, "N/A": None, None: None,
        "2024-13-01": None, "2024-02-30": None, "31/12/2024": None, "2024-01": None, "10:00": None,
        "2024-01-05 junk": None, "05-Foo-2024": None,
    })
    check(spark, dates.parse_date("x"), {
        "2024/01/05": DAY, "2024.1.5": DAY, "01-05-2024": DAY, "1.5.2024": DAY, "Jan 5 2024": DAY, "jan 5, 2024": DAY,
        "5 Jan 2024": DAY, "1/5/24": DAY, "01-05-24": DAY, "5-Jan-24": DAY, "1/5/49": date(2049, 1, 5),
        "1/5/50": date(1950, 1, 5), "5-Jan-99 10:00": date(1999, 1, 5), "1/5/2050": date(2050, 1, 5),
        "2051-01-05": date(2051, 1, 5), "1/5/124": None, "May": None, "Mayday 5 2024": None, "NULL 5 2024": None,
    })


def test_datetimes(spark):
    check(spark, dates.parse_datetime("x"), {
        "2024-01-05": datetime(2024, 1, 5), "2024-01-05 10:07": datetime(2024, 1, 5, 10, 7),
        "2024-01-05 10:07:08.25": datetime(2024, 1, 5, 10, 7, 8, 250000),
        "1/5/2024 9:05": datetime(2024, 1, 5, 9, 5), "": None,
        "2024-01-05T10:07:08.1234567": datetime(2024, 1, 5, 10, 7, 8, 123456), "soon": None, None: None,
    })


def test_quarters(spark):
    sql = dates.quarter_start("cast(x AS date)")
    check(spark, sql, {
        "2024-01-01": date(2024, 1, 1), "2024-03-31": date(2024, 1, 1), "2024-04-01": date(2024, 4, 1),
        "2024-09-30": date(2024, 7, 1), "2024-12-31": date(2024, 10, 1), None: None,
    })


def test_money(spark):
    check(spark, money.parse_money("x"), {
        "12345.000000": Decimal("12345.00"), "": Decimal("0.00"), "  ": Decimal("0.00"), "NULL": None, "null": None,
        "N/A": None, None: None, "$1,234.50": Decimal("1234.50"), "-7": Decimal("-7.00"), "1e5": None, "1E5": None,
        "0.125": Decimal("0.13"), ".5": Decimal("0.50"), "1.2.3": None, "12x": None,
    })


def test_lob(spark):
    check(spark, text.norm_lob("x"), {
        "gl": "GL", "Wc ": "WC", "w c": "WC", "GL": "GL", " auto ": "AUTO", "": "GL", None: "GL", "NEW CARS": "NEW CARS",
    })


def test_states(spark):
    check(spark, text.norm_policy_state("x"), {
        "il ": "IL", "wi": "WI", "ILL": "IL", "WIS": "WI", "XIL": None, "tx": "TX", "": None, None: None,
    })
    check(spark, text.norm_loss_state("x"), {
        "il ": "IL", "wi": "WI", "XWI": "WI", "xil": "IL", "ILL": None, "": None, None: None,
    })


def test_status_and_cost_type(spark):
    check(spark, text.norm_status("x"), {
        "open": "Open", " OPEN ": "Open", "Closed": "Closed", "closed": "Closed", "Litigation": "Litigation",
        "open again": "Litigation", "": "Litigation", None: "Litigation",
    })
    check(spark, text.norm_cost_type("x"), {
        "Indemnty": "Indemnity", " INDEMNTY": "Indemnity", "Medical": "Medical", "medical ": "medical", "": None,
        None: None,
    })


def test_phrases(spark):
    rule = KeywordRule("flag", ("late fnol", "reported after"))
    check(spark, text.has_phrases("x", rule), {
        "Late FNOL. Reported after 20 days.": True, "Late FNOL.": False, "reported AFTER late Fnol": True,
        "": False, None: None,
    })
    check(spark, text.has_phrases("x", KeywordRule("flag", ("it's",))), {"So IT'S late": True, "its": False})


@pytest.mark.parametrize("total, count, average", [
    ("3.00", 44, "0.068181"), ("143.00", 145, "0.986206"), ("-2.00", 3, "-0.666666"), ("5.00", 0, None),
    ("9000000000000000000.00", 1000003, "8999973000080.999757"),
])
def test_truncated_average(spark, total, count, average):
    row = spark.range(1).select(
        money.truncated_avg(F.lit(total).cast("decimal(28,2)"), F.lit(count).cast("bigint")).alias("a")
    ).first()
    assert row.a == (None if average is None else Decimal(average))


def test_relative_change_rounds_the_exact_quotient(spark):
    cases = [(104, 100, "0.0400"), (100005, 100000, "0.0001"), (100004, 100000, "0.0000"),
             (1004999996, 1000000000, "0.0050"), (5, 0, None), (None, 5, None), (95, 100, "-0.0500")]
    rows = spark.createDataFrame([(at, c, p) for at, (c, p, _) in enumerate(cases)], "at int, c bigint, p bigint")
    found = [r[0] for r in rows.orderBy("at").select(money.relative_change(F.col("c"), F.col("p"))).collect()]
    assert found == [None if e is None else Decimal(e) for _, _, e in cases]


def test_dates_of_moments():
    assert first_day_not_before(datetime(2001, 5, 3, 10)) == date(2001, 5, 4)
    assert first_day_not_before(datetime(2001, 5, 3)) == date(2001, 5, 3)
    assert years_before(datetime(2024, 2, 29, 8), 2) == datetime(2022, 2, 28, 8)
