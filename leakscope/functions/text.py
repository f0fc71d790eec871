"""Text cleaning rules and business keys.

The helpers take the SQL text of their input, usually a column name, and return
the SQL text of a built-in expression.
"""

from __future__ import annotations

from leakscope.config import KeywordRule


def clean_text(text: str) -> str:
    """Trim blanks; an empty text is NULL."""
    return f"nullif(trim({text}), '')"


def clean_upper(text: str) -> str:
    return f"nullif(upper(trim({text})), '')"


def canon_key(key: str) -> str:
    """Form in which keys are matched: case and trailing blanks do not count,
    leading blanks do."""
    return f"upper(rtrim({key}))"


def norm_lob(lob: str) -> str:
    """Line of business in capitals, GL when missing; W C is WC."""
    return f"if(upper(trim({lob})) = 'W C', 'WC', coalesce(nullif(upper(trim({lob})), ''), 'GL'))"


def _two_letters(state: str, of_longer: dict[str, str]) -> str:
    """A value of two letters as it is, a longer one by the first pattern it matches."""
    longer = " ".join(f"WHEN raw LIKE '{pattern}' THEN '{code}'" for pattern, code in of_longer.items())
    rule = f"CASE WHEN length(raw) = 2 THEN raw {longer} END"
    return rule.replace("raw", f"upper(trim({state}))")


def norm_policy_state(state: str) -> str:
    """Two-letter state; longer values count when they begin with IL or WI."""
    return _two_letters(state, {"IL%": "IL", "WI%": "WI"})


def norm_loss_state(state: str) -> str:
    """Two-letter state; longer values count when they end with WI or IL."""
    return _two_letters(state, {"%WI": "WI", "%IL": "IL"})


def norm_status(status: str) -> str:
    """Open or Closed in any case; everything else, also NULL, is Litigation."""
    spelled = f"initcap(trim({status}))"
    return f"if({spelled} IN ('Open', 'Closed'), {spelled}, 'Litigation')"


def norm_cost_type(cost_type: str) -> str:
    """Mends the known misspelling of Indemnity; other values keep their case."""
    return f"if(upper(trim({cost_type})) = 'INDEMNTY', 'Indemnity', nullif(trim({cost_type}), ''))"


def pad_number(number: str, width: int) -> str:
    """Zero-padded text of a whole number; longer numbers are kept whole."""
    digits = f"cast({number} AS string)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def has_phrases(text: str, rule: KeywordRule) -> str:
    """True when one text holds every phrase of the rule, in any case."""
    quoted = [phrase.lower().replace("\\", "\\\\").replace("'", "\\'") for phrase in rule.phrases]
    return " AND ".join(f"contains(lower({text}), '{phrase}')" for phrase in quoted)


def row_digest(columns: list[str]) -> str:
    """Digest of a whole row of text columns, in which NULL differs from empty."""
    marked = ", ".join(f"coalesce({column}, '~')" for column in columns)
    return f"md5(concat_ws('|', {marked}))"
