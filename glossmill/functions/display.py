"""Texts as they are shown: labels, etymologies, numerals, expanded abbreviations, and tokens kept from a change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossmill.functions import text

# Abbreviations of dictionaries in full, and the digits of Roman numerals.
IN_FULL = {
    "abbr.": "abbreviation", "adj.": "adjective", "adv.": "adverb", "cf.": "compare", "e.g.": "for example", "esp.": "especially", "etc.": "and so on", "fig.": "figurative",
    "i.e.": "that is", "n.": "noun", "obs.": "obsolete", "orig.": "originally", "pl.": "plural", "sing.": "singular", "syn.": "synonym", "usu.": "usually", "v.": "verb", "viz.": "namely",
}
NUMERALS = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
SMALL_NUMBERS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")


def domain_label(c: Column) -> Column:
    """A domain with a capital; null if blank."""
    t = text.squeeze(c)
    return F.when(~text.blank(c), F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, F.lit(2), F.greatest(F.length(t), F.lit(1))))))


def usage_label(c: Column) -> Column:
    return F.when(~text.blank(c), F.lower(text.squeeze(c)))


def etymology(c: Column) -> Column:
    """An etymology without brackets around it."""
    return F.when(~text.blank(c), text.squeeze(F.regexp_replace(text.trim(c), r"^\[(.*)\]$", "$1")))


def example(c: Column) -> Column:
    """An example sentence in curly quotes; null if nothing is left of it."""
    return text.let(text.example_sentence(c), lambda t: F.when(t != "", F.concat(F.lit("“"), t, F.lit("”"))))


def expanded(c: Column) -> Column:
    """A text with a dictionary's abbreviations in full."""
    out = c
    for short, full in IN_FULL.items():
        out = F.regexp_replace(out, r"(?i)(?<![\w.])" + short.replace(".", r"\.") + r"(?!\w)", full)
    return out


def numbers_in_words(c: Column) -> Column:
    """A text with its whole numbers up to twelve as words; parts of longer numbers stay."""
    out = c
    for n, word in enumerate(SMALL_NUMBERS):
        out = F.regexp_replace(out, rf"(?<![\w.,:/-]){n}(?![\w:/-]|[.,]\d)", word)
    return out


def roman(c: Column) -> Column:
    """The value of a Roman numeral in capitals; null if it isn't one."""
    digits = F.transform(F.split(c, ""), lambda d: text.literals({k: str(v) for k, v in NUMERALS.items()})[d].cast("int"))
    # A digit counts against the one after it if that is greater.
    signed = F.transform(digits, lambda d, i: F.when(F.get(digits, i + 1) > d, -d).otherwise(d))
    return F.when(c.rlike("^(?=.)M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"), F.aggregate(signed, F.lit(0), lambda a, x: a + x))


#: Tokens that no rewriting may change: addresses, codes, numbers with units, words with inner capitals.
KEPT = r"\b[\w.-]+@[\w.-]+\.\w+\b|https?://\S+|\b[A-Z]{2,}\d+\b|\b\d+(?:\.\d+)?(?:km|kg|cm|mm|m|g|%)\b|\b[a-z]+[A-Z]\w*\b"


def protected(c: Column) -> Column:
    """struct(text, tokens): the text with ⟦PTnnnnnn⟧ for its kept tokens, numbered from 1, and the tokens in order."""

    def place(t: Column) -> Column:
        tokens = F.regexp_extract_all(t, F.lit(KEPT), 0)
        parts = F.split(F.regexp_replace(t, KEPT, "⟦⟧"), "⟦⟧")
        mark = lambda i: F.when(i < F.size(tokens), F.concat(F.lit("⟦PT"), F.lpad((i + 1).cast("string"), 6, "0"), F.lit("⟧"))).otherwise("")
        return F.struct(F.array_join(F.transform(parts, lambda x, i: F.concat(x, mark(i))), "").alias("text"), tokens.alias("tokens"))

    return text.let(c, place)


def restored(c: Column, tokens: Column) -> Column:
    """A protected text with its tokens put back; marks without a token become empty."""
    parts = F.split(c, r"⟦PT\d{6}⟧")
    numbers = F.transform(F.regexp_extract_all(c, F.lit(r"⟦PT(\d{6})⟧"), 1), lambda n: n.cast("int") - 1)
    return F.array_join(F.transform(parts, lambda x, i: F.concat(x, F.coalesce(F.get(tokens, F.coalesce(F.get(numbers, i), F.lit(-1))), F.lit("")))), "")
