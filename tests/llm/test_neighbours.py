"""Values next to other digits, and dates in several spellings."""

from __future__ import annotations

import datetime
import random
import re

import pytest

from leakscope.llm import pseudonyms

CARD, IBAN = "4111 1111 1111 1111", "BE68 5390 0754 7034"


@pytest.mark.parametrize("text, value, kind", [
    (f"{CARD} 12/27", CARD, "card"), ("4111111111111111 123", "4111111111111111", "card"), (f"12 {CARD}", CARD, "card"),
    ("4111-1111-1111-1111-123", "4111-1111-1111-1111", "card"), (f"{IBAN} EUR", IBAN, "iban"),
    ("BE68539007547034 EUR 5", "BE68539007547034", "iban")])
def test_valid_numbers_next_to_others_go(text, value, kind):
    made, found = pseudonyms.replaced(text)
    assert found == {kind: 1} and value not in made
    before, behind = text.split(value)
    assert made.startswith(before) and made.endswith(behind)
    assert pseudonyms.replaced(made[len(before):len(made) - len(behind)])[1] == {kind: 1}
    assert pseudonyms.reveal(made) == text


def test_cards_stay_equal_and_come_back_with_digits_around():
    rng = random.Random(5)
    for _ in range(300):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card = body + str(-pseudonyms.luhn(body + "0") % 10)
        alone = pseudonyms.replaced(card)[0]
        for text in (f"{card} {rng.randrange(1000):03d}", f"{rng.randrange(100):02d} {card}"):
            made = pseudonyms.replaced(text)[0]
            assert card not in made and pseudonyms.reveal(made) == text
            if pseudonyms.luhn(re.sub(r"\D", "", text)) % 10:
                assert alone in made
            groups = " ".join(re.findall("....", card)) + text[len(card):] if text.startswith(card) else text
            assert pseudonyms.reveal(pseudonyms.replaced(groups)[0]) == groups


def test_dates_are_equal_in_all_spellings():
    for n in range(0, 73049, 97):
        day = datetime.date(1900, 1, 1) + datetime.timedelta(days=n)
        made = pseudonyms.replaced(f"{day:%Y-%m-%d}")[0]
        other = datetime.date.fromisoformat(made)
        for form in ("%d.%m.%Y", "%d/%m/%Y", *(["%m/%d/%Y"] if day.day > 12 else [])):
            text = day.strftime(form)
            assert pseudonyms.replaced(text)[0] == other.strftime(form)
            assert pseudonyms.reveal(other.strftime(form)) == text
        assert pseudonyms.reveal(made) == f"{day:%Y-%m-%d}"
