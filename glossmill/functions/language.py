"""Language and script of texts, by the scripts of their characters. Null and blank texts count as having none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glossmill.functions.text import blank

# Characters of scripts, in the syntax that Java's and RE2's patterns share.
CHINESE = r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}"
JAPANESE = r"\x{3040}-\x{30FF}\x{31F0}-\x{31FF}"
KOREAN = r"\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}\x{3130}-\x{318F}"
LATIN = r"A-Za-zÀ-ÿ"
IPA = r"/\[\]ˈˌːɑæəɛɪɔʊʌθðŋʃʒʤʧɡɜɒɫɾɹɻʲˑ˘˞\x{300}-\x{33F}"
SKIPPED = r"\s\p{P}"


def contains(c: Column, script: str) -> Column:
    return F.coalesce(c.rlike(f"[{script}]"), F.lit(False))


def count_of(c: Column, script: str) -> Column:
    """Characters of a text in those ranges."""
    return F.length(F.regexp_replace(c, f"[^{script}]", ""))


def is_bilingual(c: Column) -> Column:
    """Whether Latin letters and Chinese, Japanese or Korean ones stand in one text."""
    return contains(c, LATIN) & contains(c, CHINESE + JAPANESE + KOREAN)


def contains_non_english(c: Column) -> Column:
    """Whether there is a letter that isn't Latin. A text with pronunciation marks counts as English."""
    return ~blank(c) & ~contains(c, IPA) & F.coalesce(F.regexp_replace(c, f"[{LATIN}]", "").rlike(r"\p{L}"), F.lit(False))


def is_primarily_english(c: Column) -> Column:
    """Whether more than 70 % (whole per cent) of what is no white space, punctuation or digit is Latin."""
    rest = F.regexp_replace(c, r"[\s\p{P}\p{Nd}]", "")
    n = F.length(rest)
    return F.coalesce((n > 0) & (F.floor(count_of(rest, LATIN) * 100 / n) > 70), F.lit(False))


def primary_language(c: Column) -> Column:
    """ipa, bilingual, zh, ja, ko, en or unknown; the first that holds."""
    return (
        F.when(blank(c), "unknown").when(contains(c, IPA), "ipa").when(is_bilingual(c), "bilingual").when(contains(c, CHINESE), "zh")
        .when(contains(c, JAPANESE), "ja").when(contains(c, KOREAN), "ko").when(is_primarily_english(c), "en").otherwise("unknown")
    )


def distribution(c: Column) -> Column:
    """struct(latin, chinese, japanese, korean, ipa, other): per cent of the characters but white space and punctuation."""
    rest = F.coalesce(F.regexp_replace(c, r"[\s\p{P}]", ""), F.lit(""))
    n = F.length(rest)
    parts, left = [], rest
    for name, script in (("ipa", IPA), ("latin", LATIN), ("chinese", CHINESE), ("japanese", JAPANESE), ("korean", KOREAN)):
        parts.append((name, count_of(left, script)))
        left = F.regexp_replace(left, f"[{script}]", "")
    parts.append(("other", F.length(left)))
    share = {k: F.when(n > 0, v * 100.0 / n).otherwise(0.0).alias(k) for k, v in parts}
    return F.struct(*[share[k] for k in ("latin", "chinese", "japanese", "korean", "ipa", "other")])
