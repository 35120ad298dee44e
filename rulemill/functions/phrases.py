"""English predicate phrases to SQL predicates."""

from __future__ import annotations

import re

from rulemill.functions.text import ISO_8601


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def compile_phrase(column: str, phrase: str, as_of: str) -> str | None:
    """SQL predicate for a phrase, or None when the phrase is not known.

    ``as_of`` is the moment "the past" ends; it is an argument so that a rerun
    gives the same result. A malformed date is unknown, not in the past.
    """
    c = f"`{column}`"
    text = " ".join(phrase.split())
    if re.fullmatch(r"is not null", text, re.I):
        return f"{c} IS NOT NULL"
    if m := re.fullmatch(r"starts with (\S.*)", text, re.I):
        return f"startswith({c}, {_quoted(m[1])})"
    if m := re.fullmatch(r"must be (>=|<=|<>|!=|>|<|=) (-?[0-9]+(?:[.][0-9]+)?)", text, re.I):
        return f"{c} {m[1]} {m[2]}"
    if m := re.fullmatch(r"matches (\S.*)", text, re.I):
        return f"{c} RLIKE {_quoted(m[1])}"
    if re.fullmatch(r"is a valid ISO 8601 timestamp", text, re.I):
        return f"{c} RLIKE '{ISO_8601}'"
    if re.fullmatch(r"is not in the past", text, re.I):
        return (f"CASE WHEN {c} RLIKE '{ISO_8601}' "
                f"THEN try_cast({c} AS timestamp) >= TIMESTAMP '{as_of}' END")
    return None
