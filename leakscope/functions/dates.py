"""Dates and times from free text.

What a text begins with, and which separators it has, tells its spelling; only then a parser with the few patterns of
that kind reads it, so words never reach one. Spark may push a filter on a parsed date below the projection that
computes it, and copies the input expression for each use; the expressions name their input once.
"""

from __future__ import annotations

# The accepted spellings of a date that begins with the year, has slashes, begins with a month, or another;
# and of the time that may follow. A year of two digits is made whole before: up to 49 it is of this century, else of
# the one before.
_YEAR_FIRST = ("yyyy/M/d", "yyyy.M.d")
_SLASHES = ("M/d/yyyy",)
_NAME_FIRST = ("MMM d[,] yyyy",)
_OTHERS = ("d-MMM-yyyy", "yyyyMMdd", "M-d-yyyy", "M.d.yyyy", "d MMM yyyy")
_TIMES = (" H:mm[:ss[.SSSSSSSSS]]", "''T''H:mm[:ss[.SSSSSSSSS]]")
_CENTURIES = {"[0-4][0-9]": "20", "[5-9][0-9]": "19"}
_MONTH = "^[A-Za-z]{3} [0-9]"


def _short(year: str) -> str:
    """A date that ends with this year, before any time."""
    return f"^([0-9]{{1,2}}[/-][0-9]{{1,2}}[/-]|[0-9]{{1,2}}-[A-Za-z]{{3}}-)({year})([ T].*)?$"


def _read(text: str, spellings: tuple[str, ...]) -> str:
    pattern = "".join(f"[{spelling}]" for spelling in spellings + _TIMES)
    return f"cast(try_to_timestamp({text}, '{pattern}') AS timestamp_ntz)"


def _read_any_year(text: str, mark: str, spellings: tuple[str, ...]) -> str:
    """A third digit after the second mark tells a whole year; only others are looked at for a short one."""
    third = f"ascii(substr({text}, locate('{mark}', {text}, locate('{mark}', {text}) + 1) + 3, 1))"
    whole = text
    for year, century in _CENTURIES.items():
        whole = f"regexp_replace({whole}, '{_short(year)}', '$1{century}$2$3')"
    return f"if({third} BETWEEN {ord('0')} AND {ord('9')}, {_read(text, spellings)}, {_read(whole, spellings)})"


def parse_datetime(text: str) -> str:
    """Timestamp of a text column in any accepted spelling, at midnight without a time.

    Anything else, such as an empty text or the word NULL, is NULL: every spelling begins with a digit or a month. The
    result has no time zone; the session's should be UTC, where every time of day exists.
    """
    parsed = f"""CASE
        WHEN ascii(t) BETWEEN {ord('0')} AND {ord('9')} THEN CASE
            WHEN locate('-', t) = 5 THEN if(locate('-', t, 6) > 0, try_cast(t AS timestamp_ntz), NULL)
            WHEN locate('/', t) = 5 OR locate('.', t) = 5 THEN {_read('t', _YEAR_FIRST)}
            WHEN locate('/', t) > 0 THEN {_read_any_year('t', '/', _SLASHES)}
            ELSE {_read_any_year('t', '-', _OTHERS)} END
        WHEN t RLIKE '{_MONTH}' THEN {_read('t', _NAME_FIRST)} END"""
    return f"element_at(transform(array(trim({text})), t -> {parsed}), 1)"


def parse_date(text: str) -> str:
    """Like :func:`parse_datetime`, without the time of day."""
    return f"cast({parse_datetime(text)} AS date)"


def quarter_start(day: str) -> str:
    return f"cast(date_trunc('quarter', cast({day} AS timestamp_ntz)) AS date)"
