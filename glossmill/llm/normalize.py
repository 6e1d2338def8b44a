"""Problem 3: visually identical text with different characters.

A token's letters are resolved to the sets of scripts in which they could have been written: a look-alike belongs to
its own script and to Latin, any other letter to its own script only. The sets are intersected across the token. If
Latin is left, the token takes its Latin spelling (mixed-script and whole-script confusables); if only another script
is left, Latin look-alikes in it take that script's spelling; if none is left, the token stays. All other forms -
width, joined letters, accents, blanks, invisible characters - are normalised character by character.

Nulls stay null, the empty text stays empty, whole texts of any length are processed, and equal texts get equal forms.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other alphabets that look like a Latin letter.
CYRILLIC = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ү": "y", "ё": "ë", "ї": "ï", "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G",
    "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W",
    "Х": "X", "У": "Y", "Ү": "Y", "Ё": "Ë", "Ї": "Ï",
}
GREEK = {
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
}
ARMENIAN = {"օ": "o", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Ս": "U", "Լ": "L"}
# Characters that are not seen, and blanks within a line.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\u206a\u206b\u206c\u206d\u206e\u206f\u3164\ufeff\uffa0"
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"

#: Characters a text may consist of and surely be in its consistent form; valid for Java's and Python's patterns.
ORDINARY = r"\t\n\r\x20-\x7e\u00a1-\u00ac\u00ae-\u0131\u0134-\u0148\u014a-\u017e\u0180-\u01c3\u01cd-\u01f0\u01f4-\u024f\u2013-\u2015\u2018-\u201f\u2026\u3001\u3002\u3400-\u4dbf\u4e00-\u9fff"
SUSPICIOUS = f"[^{ORDINARY}]"
_SUSPICIOUS = re.compile(SUSPICIOUS)

_OF = {c: ("Cyrillic", x) for c, x in CYRILLIC.items()} | {c: ("Greek", x) for c, x in GREEK.items()} | {c: ("Armenian", x) for c, x in ARMENIAN.items()}
_BACK = {s: {x: c for c, x in t.items()} for s, t in (("Cyrillic", CYRILLIC), ("Greek", GREEK), ("Armenian", ARMENIAN))}
_CLEAN: dict[int, str] = (
    {c: "" for c in [*range(0x09), *range(0x0E, 0x20), *range(0x7F, 0x85), *range(0x86, 0xA0), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE01F0), *map(ord, INVISIBLE)]}
    | {ord(c): " " for c in BLANKS}
    | {0x2010: "-", 0x2011: "-"}
)
_HAN = r"\u3005\u3007\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
# Wide punctuation and symbols, in runs with those of Chinese, Japanese and Korean.
_WIDE_RUN = re.compile(r"[\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65\uffe0-\uffee\u3001-\u3004\u3008-\u3020\u3030]+")
_HAN_CHAR = re.compile(f"[{_HAN}]")
# Forms that differ from ordinary letters and digits only in width, joining or style.
_COMPAT = re.compile(r"[\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\uff66-\uffdc\ufb00-\ufb06\ufb13-\ufb17\u0132\u0133\u0149\u01c4-\u01cc\u01f1-\u01f3\u2160-\u217f\u2f00-\u2fd5\U0001d400-\U0001d7ff]+")
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f])*")
_FOREIGN = re.compile(r"[\u0370-\u03ff\u0400-\u052f\u0530-\u058f\u1f00-\u1fff]")
_SPOKEN = re.compile(r"/[^/\s]+/")
_WORD = re.compile(r"[^\W_]+")


def _script(c: str) -> str:
    o = ord(c)
    if 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
        return "Greek"
    if 0x400 <= o <= 0x52F:
        return "Cyrillic"
    if 0x530 <= o <= 0x58F:
        return "Armenian"
    if o < 0x250 or 0x250 <= o <= 0x2AF or 0x1E00 <= o <= 0x1EFF:
        return "Latin"
    return "Other"


def _spelling(token: str) -> str:
    """The token in the one script in which all of it can be written, Latin first."""
    left: set[str] | None = None
    for c in token:
        if "\u0300" <= c <= "\u036f":
            continue
        s = _script(c)
        can = {s, "Latin"} if c in _OF else {s}
        if s == "Latin":
            base = unicodedata.normalize("NFD", c)[0]
            can |= {k for k, back in _BACK.items() if base in back}
        left = can if left is None else left & can
    if not left:
        return token
    if "Latin" in left:
        return "".join(_OF[c][1] if c in _OF else c for c in token)
    back = _BACK.get(next(iter(left)), {})
    return "".join(back.get(c, c) for c in token)


def _width(m: re.Match) -> str:
    s, a, b = m.string, m.start(), m.end()
    if (a and _HAN_CHAR.match(s, a - 1)) or (b < len(s) and _HAN_CHAR.match(s, b)):
        return m.group()
    return "".join(unicodedata.normalize("NFKC", c) if c >= "\uff00" else c for c in m.group())


def consistent(text: str) -> str:
    """The consistent form of one text."""
    if not _SUSPICIOUS.search(text):
        return text
    s = text.translate(_CLEAN)
    s = _COMPAT.sub(lambda m: unicodedata.normalize("NFKC", m.group()), _WIDE_RUN.sub(_width, s))
    s = unicodedata.normalize("NFC", s)
    if _FOREIGN.search(s):
        parts, at = [], 0
        for m in _SPOKEN.finditer(s):
            parts += [_TOKEN.sub(_respell, s[at : m.start()]), m.group()]
            at = m.end()
        s = unicodedata.normalize("NFC", "".join([*parts, _TOKEN.sub(_respell, s[at:])]))
    return s


def _respell(m: re.Match) -> str:
    return _spelling(m.group()) if _FOREIGN.search(m.group()) else m.group()


def words(text: str) -> list[str]:
    """The words of a text: runs of letters and digits of its consistent form, in lower case."""
    return _WORD.findall(consistent(text).lower())


@F.pandas_udf(StringType())
def _consistent_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(consistent, na_action="ignore")


# Not deterministic for the optimiser, so that it is not run again for each filter and projection over its result.
_consistent_udf = _consistent_udf.asNondeterministic()


def suspicious_col(text: Column) -> Column:
    """Whether a text has a suspicious character. The pattern is long, so it sees only what isn't plain ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")).otherwise(F.regexp_replace(text, r"[\x20-\x7e]+", "").rlike(SUSPICIOUS))


def consistent_col(text: Column) -> Column:
    """The consistent form as a Column. Only texts with a suspicious character are sent to Python."""
    return F.coalesce(_consistent_udf(F.when(suspicious_col(text), text)), text)


def letters_col(form: Column) -> Column:
    """The letters of a text of which form is the consistent form."""
    return F.regexp_replace(F.lower(form), r"[^\p{L}\p{N}]+", "")


FIELDS = (("dictionary_entry_parsed", "dictionary_entry_parsed_id", "definition"), ("dictionary_entry_synonym", "dictionary_entry_synonym_id", "synonym_text"))


def forms(parsed: DataFrame, synonym: DataFrame) -> DataFrame:
    """(field, row_id, text, form): every text of the two tables with its consistent form, each row once.

    Rows with a null text are left out.
    """
    parts = [t.where(F.col(f).isNotNull()).select(F.lit(f).alias("field"), F.col(i).alias("row_id"), F.col(f).alias("text")) for t, (_, i, f) in zip((parsed, synonym), FIELDS)]
    return parts[0].union(parts[1]).withColumn("form", consistent_col(F.col("text")))


def found(parsed: DataFrame, synonym: DataFrame) -> DataFrame:
    """(field, row_id) of each row whose text differs from its consistent form; repeated deliveries count once."""
    return forms(parsed, synonym).where("form <> text").select("field", "row_id").distinct()
