"""Pronunciations and syllables. The sequential rules run in Arrow batches; everything else is Columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from glossmill.functions.text import squeeze, trim

# Sounds and spellings.
IPA_VOWELS = "iyɪʏeøɛœæaɑɒɔoʊuəɚɝɜɵɐ"
IPA_LETTERS = "ˈˌɑ-ʊəɐɛɪɔʌθðŋʃʒʤʧɡɜɒɫɾɹɻʲ̃ː"
STRESSABLE = "[ɑæɐəɛɪiɔʊuʌeɜ]"
SYLLABIC = "aeiouæɪʊəɐɑɔɛɜʌoøɒyɯɨɶ"
CONSONANTS = "bcdfghjklmnpqrstvwxyzθðʃʒŋ"
DIGRAPHS = ("ch", "sh", "th", "ph", "wh", "ck", "ng", "gh", "gn", "kn", "wr", "qu")
SUFFIXES = (
    "ation", "ition", "tation", "tion", "sion", "ture", "sure", "cial", "tial", "cian", "gian", "ment", "ness", "able", "ible",
    "ing", "edly", "ed", "er", "est", "ly", "ious", "eous", "uous", "ative", "itive", "ize", "ise", "ate",
)

#: A piece of a pronunciation: all before its second vowel, then from each vowel to the next one.
PIECE = re.compile(rf"^[^{IPA_VOWELS}]*[{IPA_VOWELS}]?[^{IPA_VOWELS}]*|[{IPA_VOWELS}][^{IPA_VOWELS}]*")
#: Whether a piece can be a syllable: it has a vowel and a consonant.
WHOLE = re.compile(rf"(?=.*[{SYLLABIC}])(?=.*[{CONSONANTS}])", re.S)
#: Where a written word parts: before the consonants between two vowels if that is one or begins with a digraph, else after
#: the first of them. A digraph's letters are never parted.
VOWEL, OTHER = "[aeiouyAEIOUY]", "[^aeiouyAEIOUY]"
_PAIR = "|".join(DIGRAPHS)
_WITHIN = "".join(f"(?!(?<={a})(?={b}))" for a, b in (x for d in DIGRAPHS for x in (tuple(d), tuple(d.upper()), tuple(d.title()))))
BREAK = re.compile(rf"(?<={VOWEL})(?=(?:(?i:{_PAIR}){OTHER}*|{OTHER}){VOWEL})|(?<={VOWEL}{OTHER})(?={OTHER}+{VOWEL}){_WITHIN}")

SYLLABLES = ArrayType(StructType([StructField("index", IntegerType()), StructField("text", StringType()), StructField("stress", IntegerType())]))


def locale_code(c: Column) -> Column:
    return F.substring(F.translate(trim(c), "_", "-"), 1, 15)


@F.pandas_udf(StringType())
def _compose(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def normalize_ipa(c: Column) -> Column:
    """A pronunciation without wiki brackets, with long marks and ties of one form, without stops; empty below 2 characters."""
    t = F.trim(F.substring(squeeze(F.regexp_replace(trim(c), r"\[\[|\]\]|\{\{|\}\}", "")), 1, 300))
    made = squeeze(F.translate(_compose(t), ":͡.,，", "ː͜"))
    return F.when(c.isNull() | (F.length(t) < 2), "").otherwise(made)


def locale_of_ipa(c: Column) -> Column:
    """en-US, en-UK or en, by sounds of the two."""
    us = c.rlike("[ɹɑɚɝoʊ]").cast("int") + F.when(c.rlike("[ɚɝ]"), 2).otherwise(0)
    uk = c.rlike("[ɒəʊː]").cast("int") + F.when(c.contains("ː"), 2).otherwise(0)
    return F.when(us > uk, "en-US").when(uk > us, "en-UK").otherwise("en")


def with_stress(c: Column) -> Column:
    """/core/ with a stress mark at its start if it has none and at least two vowels."""
    core = F.regexp_replace(c, "^/+|/+$", "")
    return F.when(~core.rlike("[ˈˌ]") & (F.regexp_count(core, F.lit(STRESSABLE)) >= 2), F.concat(F.lit("/ˈ"), core, F.lit("/"))).otherwise(c)


#: Candidates that are no pronunciation: numbers and marks only, or prose about forms.
NO_IPA = r"^[0-9\s./:-]+$|(?i)\b(?:strong|weak|form|plural|singular)\b"


def ipa_of(text: Column) -> Column:
    """array of struct(ipa, locale): the pronunciations in a text, between slashes if there are slashes, each once.

    Each word of a candidate is reduced to its sounds; what has none is left out.
    """
    slashed = F.regexp_extract_all(text, F.lit("/([^/]+)/"), 1)
    candidates = F.filter(F.when(F.size(slashed) > 0, slashed).otherwise(F.array(text)), lambda r: ~r.rlike(NO_IPA))
    words = F.flatten(F.transform(candidates, lambda r: F.split(F.translate(r, ":", "ː"), " +")))
    sounds = F.array_distinct(F.array_remove(F.transform(words, lambda w: F.regexp_replace(w, f"[^{IPA_LETTERS}]", "")), ""))
    made = F.transform(sounds, lambda p: F.struct(with_stress(F.concat(F.lit("/"), p, F.lit("/"))).alias("ipa"), locale_of_ipa(p).alias("locale")))
    return F.when(text.isNotNull(), made).otherwise(F.array().cast(made_type()))


def made_type() -> str:
    return "array<struct<ipa:string,locale:string>>"


def split_ipa(ipa: str) -> list[tuple[int, str, int]]:
    """(index, text, stress) of each syllable of a pronunciation. A piece without a vowel or a consonant belongs to the one
    before it; a syllable's stress is its strongest piece's, a piece's that of its last mark."""
    pieces = [p for p in PIECE.findall(ipa) if p.strip("ˈˌ")]
    texts = [p.replace("ˈ", "").replace("ˌ", "") for p in pieces]
    stress = [max((p.rfind("ˌ"), 1), (p.rfind("ˈ"), 2))[1] if {"ˈ", "ˌ"} & set(p) else 0 for p in pieces]
    begins = [i for i, t in enumerate(texts) if i == 0 or WHOLE.match(t)]
    return [(n, "".join(texts[i:j]), max(stress[i:j])) for n, (i, j) in enumerate(zip(begins, [*begins[1:], len(texts)]), 1)]


def split_spelling(word: str) -> list[str]:
    """The syllables of a written word: parted at hyphens, before a strong suffix, then between its vowels."""
    word = re.sub(r"[^A-Za-z'-]", "", word)
    if "-" in word:
        return [s for part in word.split("-") for s in split_spelling(part)] or [word]
    if len(word) <= 3 or len(re.findall(f"{VOWEL}+", word)) < 2:
        return [word] if word else []
    suffix = next((s for s in SUFFIXES if len(word) > len(s) + 2 and word.lower().endswith(s)), "")
    stem = word[: len(word) - len(suffix)]
    if suffix and re.search(VOWEL, stem) and re.search(VOWEL, suffix):
        pieces = split_spelling(stem) + split_spelling(word[len(stem) :])
    else:
        pieces = [p for p in BREAK.split(word) if p]
    # A letter alone goes to the syllable after it.
    return [p.replace(" ", "") for p in re.findall(r"(?:\S )*\S{2,}|(?:\S )*\S$", " ".join(pieces))]


@F.pandas_udf(SYLLABLES)
def ipa_syllables(texts: pd.Series) -> pd.Series:
    """array of struct(index, text, stress)."""
    return texts.map(lambda t: [{"index": i, "text": x, "stress": s} for i, x, s in split_ipa(t)] if isinstance(t, str) else [])


@F.pandas_udf(ArrayType(StringType()))
def spelling_syllables(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: split_spelling(t) if isinstance(t, str) else [])


def render_ipa(syllables: Column, locale: Column) -> Column:
    """/syl.lables/ with stress marks; dots between them in en-UK only."""
    marked = F.transform(syllables, lambda s: F.concat(F.when(s["stress"] == 2, "ˈ").when(s["stress"] == 1, "ˌ").otherwise(""), s["text"]))
    return F.when(F.size(syllables) > 0, F.concat(F.lit("/"), F.when(locale == "en-UK", F.array_join(marked, ".")).otherwise(F.array_join(marked, "")), F.lit("/"))).otherwise("")


def render_spelling(syllables: Column) -> Column:
    return F.array_join(syllables, "·")


def by_locale(syllables: Column, locale: Column) -> Column:
    """Written syllables as a locale parts them: in en-UK a final `ion` stands alone."""
    parted = F.flatten(F.transform(syllables, lambda x: F.when(x.rlike(".ion$"), F.array(F.regexp_replace(x, "ion$", ""), F.lit("ion"))).otherwise(F.array(x))))
    return F.when(locale == "en-UK", parted).otherwise(syllables)
