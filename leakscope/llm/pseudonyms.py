"""Format-preserving pseudonyms for personal data.

Found are card numbers (13 to 19 digits with a right check digit), IBANs (right check digits), social security
numbers, North American phone numbers, IPv4 addresses, e-mail addresses and dates. What fails its validation is left
alone. A value is the number of its place in its format (days for dates, digits for the others; of e-mail addresses
letters and digits of the part before the @) and a Feistel network, walked until it ends inside the format, permutes the
numbers under a key. So a pseudonym is valid in the same format, other values of that format get other pseudonyms, and
equal values stay equal across documents however they are punctuated. The key undoes it, see ``reveal``.

Of digits around a card number, or words behind an IBAN, the longest part at group bounds that is valid is taken. A
pseudonym is walked on until the same part would be taken again, so that the key finds it; only there a value may get
another pseudonym than elsewhere, and not for digits before or behind a whole card number.

Null stays null, an empty text empty; any row is handled by itself, so repeated rows get equal results. Extra columns
are kept by ``pseudonymise`` as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KEY = b"change me: pseudonyms are as secret as this key"
ROUNDS = 8
KINDS = ("email", "iban", "date", "ip", "phone", "ssn", "card")
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1), 73049  # to 2099-12-31

_PATTERN = re.compile(r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]))
  | (?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))
  | (?P<phone>(?<![\d-])(?:\+?1[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-]))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<card>(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-]))
""", re.VERBOSE | re.ASCII)


def permute(x: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """Keyed permutation of ``range(size)``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    while True:
        left, right = x >> half, x & mask
        for r in order:
            source = left if back else right
            salt = b"%s|%d|%d|%d" % (tweak, size, r, source)
            f = int.from_bytes(hashlib.blake2b(salt, key=key, digest_size=16).digest(), "big") & mask
            left, right = (right ^ f, left) if back else (right, left ^ f)
        x = left << half | right
        if x < size:
            return x


def luhn(digits: str) -> int:
    """Sum that a right check digit makes divisible by 10."""
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def _refill(shape: str, symbols: str, where: Callable[[str], bool] = str.isdigit) -> str:
    """``shape`` with its symbols replaced in order."""
    following = iter(symbols)
    return "".join(next(following) if where(c) else c for c in shape)


def _digits(number: str, key: bytes, tweak: bytes, back: bool) -> str:
    return str(permute(int(number), 10 ** len(number), key, tweak, back)).zfill(len(number))


def _is_card(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return not luhn(digits) % 10 and 13 <= len(digits) <= 19 and len(set(digits)) > 1


def _card(text: str, key: bytes, back: bool) -> str | None:
    if not _is_card(text):
        return None
    number = digits = re.sub(r"\D", "", text)
    while True:
        body = number[0] + _digits(number[1:-1], key, b"card" + number[0].encode(), back)
        number = body + str(-luhn(body + "0") % 10)
        # With the sums of both parities as before, longer digits around the number stay as valid or invalid.
        if (luhn(number + "0") - luhn(digits + "0")) % 10 == 0 and len(set(number)) > 1:
            return _refill(text, number)


def _iban_rest(plain: str) -> int:
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and _iban_rest(plain) == 1 and any(c.isdigit() for c in plain[4:])


def _iban(text: str, key: bytes, back: bool) -> str | None:
    if not _is_iban(text):
        return None
    plain = text.replace(" ", "")
    digits = "".join(c for c in plain[4:] if c.isdigit())
    body = _refill(plain[4:], _digits(digits, key, b"iban" + re.sub(r"\d", "0", plain[4:]).encode() + plain[:2].encode(),
                                      back))
    return _refill(text, plain[:2] + f"{98 - _iban_rest(plain[:2] + '00' + body):02d}" + body, str.isalnum)


def _part(kind: str, text: str) -> tuple[int, int] | None:
    """Begin and end of the longest, then first part of whole groups that is a card number or an IBAN."""
    groups = [g.span() for g in re.finditer(r"[A-Z0-9]+", text)]
    starts = groups if kind == "card" else groups[:1]
    parts = sorted(((a, b) for i, (a, _) in enumerate(starts) for _, b in groups[i:] if b - a >= 13),
                   key=lambda p: (-sum(map(str.isalnum, text[slice(*p)])), p))
    valid = _is_card if kind == "card" else _is_iban
    return next((p for p in parts if valid(text[slice(*p)])), None)


def _within(kind: str, text: str, key: bytes, back: bool) -> tuple[str, int] | None:
    """``text`` with the pseudonym of its part, and where the part ends."""
    part = _part(kind, text)
    if part is None:
        return None
    begin, end = part
    while True:
        text = text[:begin] + _MAKERS[kind](text[begin:end], key, back) + text[end:]
        if _part(kind, text) == part:
            return text[:end], end


def _date(text: str, key: bytes, back: bool) -> str | None:
    try:
        if "-" in text:
            year, month, day = map(int, text.split("-"))
        else:
            day, month, year = map(int, re.split(r"[/.]", text))
            if "/" in text and month > 12:
                day, month = month, day  # month first
        number = (datetime.date(year, month, day) - _FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= number < _DAYS:
        return None
    # A day after the 12th stays one, so that a date with slashes is read in the same order, day or month first; in
    # every spelling, so that equal dates stay equal.
    late = day > 12
    while True:
        number = permute(number, _DAYS, key, b"date", back)
        made = _FIRST_DAY + datetime.timedelta(days=number)
        if (made.day > 12) == late:
            break
    if "-" in text:
        return made.strftime("%Y-%m-%d")
    if "." in text:
        return made.strftime("%d.%m.%Y")
    return made.strftime("%m/%d/%Y" if int(text[3:5]) > 12 else "%d/%m/%Y")


def _ip(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    number = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip", back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _phone(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    lead, own = digits[:-10], digits[-10:]
    if own[0] in "01" or own[3] in "01":
        return None
    number = ((int(own[0]) - 2) * 8 + int(own[3]) - 2) * 10 ** 8 + int(own[1:3] + own[4:])
    head, rest = divmod(permute(number, 64 * 10 ** 8, key, b"phone", back), 10 ** 8)
    rest = str(rest).zfill(8)
    return _refill(text, lead + str(head // 8 + 2) + rest[:2] + str(head % 8 + 2) + rest[2:])


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    areas = [a for a in range(1, 900) if a != 666]
    number = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute(number, len(areas) * 99 * 9999, key, b"ssn", back), 9999)
    return f"{areas[number // 99]:03d}-{number % 99 + 1:02d}-{serial + 1:04d}"


def _email(text: str, key: bytes, back: bool) -> str | None:
    name, _, host = text.rpartition("@")
    shape = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", name)))
    number, size = 0, 1
    for c, kind in zip(name, shape):
        if kind in "aA0":
            n, at = (10, ord(c) - 48) if kind == "0" else (26, ord(c) - ord(kind))
            number, size = number * n + at, size * n
    number = permute(number, size, key, b"email" + shape.encode() + host.lower().encode(), back)
    made = []
    for kind in reversed(shape):
        if kind in "aA0":
            number, at = divmod(number, 10 if kind == "0" else 26)
            made.append(chr(at + (48 if kind == "0" else ord(kind))))
        else:
            made.append(None)
    return "".join(m or c for m, c in zip(reversed(made), name)) + "@" + host


_MAKERS: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "card": _card, "iban": _iban, "date": _date, "ip": _ip, "phone": _phone, "ssn": _ssn, "email": _email}


def replaced(text: str, key: bytes = KEY, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each kind it holds."""
    found: dict[str, int] = {}
    done, at = [], 0
    while match := _PATTERN.search(text, at):
        kind, end = match.lastgroup, match.end()
        if kind in ("card", "iban"):
            made = _within(kind, match[0], key, back)
            if made is not None:
                made, end = made[0], match.start() + made[1]
        else:
            made = _MAKERS[kind](match[0], key, back)
        if made is not None:
            found[kind] = found.get(kind, 0) + 1
        done += text[at:match.start()], text[match.start():end] if made is None else made
        at = end
    return "".join([*done, text[at:]]), found


def reveal(text: str, key: bytes = KEY) -> str:
    """Undoes ``replaced``."""
    return replaced(text, key, back=True)[0]


def pseudonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and __found, a map of how many values of each kind were replaced."""
    at = docs.columns.index("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [replaced(t, key) if t is not None else (None, {}) for t in batch.column(at).to_pylist()]
            columns = [pa.array([m[0] for m in made], pa.string()) if i == at else c
                       for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([list(m[1].items()) for m in made], pa.map_(pa.string(), pa.int64()))],
                names=[*batch.schema.names, "__found"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(read, f"{fields}, __found map<string,bigint>")
