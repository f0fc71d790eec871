"""Settings of the analyses. Nothing here reads the clock: every job is
relative to an explicit as-of timestamp, so a run can be repeated."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

# As-of moment of the test fixture.
FIXTURE_AS_OF = datetime(2001, 8, 1, 10, 0, 0)


@dataclass(frozen=True)
class KeywordRule:
    """A note raises ``flag`` when it contains every phrase (any case)."""

    flag: str
    phrases: tuple[str, ...]


# The phrases that mark each kind of leakage in a claim note.
DEFAULT_KEYWORDS = (
    KeywordRule("missed_subrogation", ("subrogation", "not pursued")),
    KeywordRule("missed_FNOL", ("late fnol", "reported after")),
    KeywordRule("dup_billing", ("duplicate billing",)),
)

# Thresholds of the reserve and outlier rules.
RESERVE_AGE_DAYS = 365
RESERVE_RATIO = 3
QUIET_DAYS = 90
SEVERITY_YEARS = 2
IQR_FACTOR = 1.5
MAX_HIERARCHY_DEPTH = 100


def first_day_not_before(moment: datetime) -> date:
    """First date whose midnight is at or after ``moment``.

    A date column is compared with a moment at midnight, so
    ``day >= moment`` equals ``day >= first_day_not_before(moment)``. The date
    literal keeps the column bare and lets the filter reach the file scan.
    """
    at_midnight = (moment.hour, moment.minute, moment.second, moment.microsecond) == (0, 0, 0, 0)
    return moment.date() if at_midnight else moment.date() + timedelta(days=1)


def years_before(moment: datetime, years: int) -> datetime:
    try:
        return moment.replace(year=moment.year - years)
    except ValueError:  # 29 February in a common year
        return moment.replace(year=moment.year - years, day=28)
