"""Blanks around marks. Marks belong to classes by the side on which they bear no blank, and every pattern is made from a
class, so scanned texts, definitions and rewritten texts are repaired by the same few rules.

A rule is (pattern, replacement) in the syntax that Java's and Python's patterns share.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]

#: Marks that close what stands before them, and those that do so in Chinese text; brackets; marks that part what stands
#: on both sides; marks that end a sentence; signs that join what stands on both sides; dashes that become a long one.
CLOSING, CLOSING_WIDE = ",.;:!?", "。，；：！？、．"
OPEN_BRACKETS, CLOSE_BRACKETS = "([{", ")]}"
PARTING, ENDING, JOINING, DASHES = ",;:", ".!?", "/=", "‑–—"
QUOTES = "\"'“”’"
CURRENCY = "£€¥$"


def one_of(marks: str) -> str:
    return "[" + "".join("\\" + c if c in r"\[]^-" else c for c in marks) + "]"


def none_before(marks: str) -> Rule:
    return rf"\s+({one_of(marks)})", "$1"


def none_after(marks: str) -> Rule:
    return rf"({one_of(marks)})\s+", "$1"


def none_around(marks: str, becomes: str = "$1") -> Rule:
    return rf"\s*({one_of(marks)})\s*", becomes


def one_after(marks: str, but: str) -> Rule:
    """A blank after marks that something else than a digit or one of `but` follows at once."""
    return rf"({one_of(marks)})(?=[^\s\d{one_of(but)[1:-1]}])", "$1 "


def one_blank(least: int = 2) -> Rule:
    return rf"\s{{{least},}}", " "


def at_most(mark: str, n: int) -> Rule:
    return re.escape(mark) + f"{{{n + 1},}}", mark * n


def applied(c: Column, rules: Iterable[Rule]) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def any_of(rules: Iterable[Rule]) -> str:
    """A pattern that is found where one of the rules changes something, or might."""
    return "|".join(f"(?:{p})" for p, _ in rules)
