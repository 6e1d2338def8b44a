"""What a sense's text says beside its meaning: synonyms with their confidence, examples, an etymology, references to other
words, a domain and a part of speech. Each source has extractors of its own; other sources use the general ones.

Synonyms are found by phrases, written as templates: {a} and {b} are words, [x] may be missing, x/y are alternatives, and a
phrase is either the whole text or stands anywhere in it. All is array functions within a row, so nothing is shuffled.
Null and blank texts and headwords give nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text

#: Confidence of a level.
LEVELS = {"high": 100, "medium": 60, "low": 30}


@dataclass(frozen=True)
class Phrase:
    """A template of words, its level, the sources that use it (none: those without a list of their own), whether it is the
    whole text, and whether it counts once or at each place."""

    words: str
    level: str
    sources: tuple[str, ...] = ()
    whole: bool = True
    all: bool = False

    @property
    def pattern(self) -> str:
        """The phrase as a pattern with the groups of its words, blanks between words being any white space."""
        out = ""
        for i, w in enumerate(self.words.split()):
            optional = w.startswith("[")
            core = re.sub(r"[\[\]]", "", w)
            last = "[.]" if core.endswith(".") else ""
            core = core.rstrip(".")
            body = r"(\w+)" if core in ("{a}", "{b}") else r"(\w+ing)" if core in ("{a}ing", "{b}ing") else "[^.,]+," if core == "...," else "(?:" + "|".join(map(re.escape, core.split("/"))) + ")"
            one = (r"\s+" if i else "") + body + last
            out += f"(?:{one})?" if optional else one
        return rf"(?i)^\s*{out}\s*[.]?\s*$" if self.whole else rf"(?i)\b{out}\b"

    @property
    def groups(self) -> str:
        return "".join(re.findall(r"\{([ab])\}", self.words))


_COLLINS, _OXFORD, _CHN = "ENG_COLLINS", "ENG_OXFORD", "ENG_CHN"
# The phrases of the sources.
PHRASES = (
    Phrase("{a} means {b}", "medium"), Phrase("{a} is {b}", "medium"),
    Phrase("{a} means {b}", "high", (_OXFORD, _CHN)), Phrase("{a} is {b}", "high", (_OXFORD, _CHN)), Phrase("{a} is the same as {b}", "high", (_OXFORD, _CHN)),
    Phrase("{a} means [the] same [as] {b}", "high", (_COLLINS,)), Phrase("{a} is [a] synonym of {b}", "high", (_COLLINS,)), Phrase("{a} and {b} are synonyms", "high", (_COLLINS, _CHN)),
    Phrase("same as {b}", "high", (_COLLINS,), whole=False), Phrase("to {a} [something] means to {b} [it]", "high", (_COLLINS, _OXFORD, _CHN)), Phrase("{a}ing is {b}ing", "high", (_COLLINS, _CHN)),
    Phrase("if/when you {a} ..., you {b} [it/something/one]", "high", (_COLLINS, _OXFORD, _CHN)),
    Phrase("{a} or/and/or {b}", "medium", (_COLLINS,), whole=False, all=True), Phrase("also called {b}", "medium", (_COLLINS,), whole=False, all=True), Phrase("known as {b}", "medium", (_COLLINS,), whole=False, all=True),
    Phrase("synonymous with {b}", "low", (_COLLINS, _CHN), whole=False), Phrase("similar to {b}", "low", (_COLLINS, _CHN), whole=False), Phrase("compare with {b}", "low", (_COLLINS,), whole=False), Phrase("see also {b}", "low", (_COLLINS,), whole=False),
)
OWN = (_COLLINS, _OXFORD, _CHN)
# Words that are no synonyms of each other.
OPPOSITES = (("big", "small"), ("hot", "cold"), ("up", "down"), ("good", "bad"), ("yes", "no"), ("love", "hate"), ("day", "night"), ("black", "white"), ("rich", "poor"), ("fast", "slow"))
WORD = r"^(?=.*[a-z])[a-z'-]{2,}$"


def head_of(c: Column) -> Column:
    """A headword as it is compared: in small letters, without marks of rank."""
    return text.trim(F.regexp_replace(F.lower(c), "[★☆●○▶]", ""))


def plain(c: Column) -> Column:
    """A definition as phrases are sought in it: one line, without Chinese text, marks and notes in 【】."""
    return text.squeeze(F.regexp_replace(F.regexp_replace(c, "【[^】]*】|[★☆●○]+", " "), r"[一-鿿㐀-䶿]+", " "))


def pair_allowed(a: Column, b: Column) -> Column:
    """Whether two words may be synonyms: both plain words of two letters or more, not the same, not opposites."""
    key = F.concat_ws("|", F.least(a, b), F.greatest(a, b))
    opposite = key.isin(*["|".join(sorted(p)) for p in OPPOSITES])
    return F.coalesce(a.rlike(WORD) & b.rlike(WORD) & (a != b) & ~opposite, F.lit(False))


def _said(p: Phrase) -> Column:
    """array of struct(synonym, confidence): what a phrase says of the head h in the text d."""
    group = lambda g: F.transform(F.regexp_extract_all("d", F.lit(p.pattern), g), F.lower)
    other = lambda a, b: F.when(a == F.col("h"), b).when(b == F.col("h"), a)
    targets = group(1) if p.groups == "b" else F.zip_with(group(1), group(2), other)
    targets = F.filter(targets if p.all else F.slice(targets, 1, 1), lambda t: pair_allowed(F.col("h"), t))
    return F.transform(targets, lambda t: F.struct(t.alias("synonym"), F.lit(LEVELS[p.level]).alias("confidence")))


def synonyms(senses: DataFrame, row_id: str, head: str, definition: str, source: str) -> DataFrame:
    """(row_id, synonym, confidence, level): what each definition calls a synonym of its head, at the best confidence.

    A phrase of two words counts if one of them is the headword; the other one is the synonym.
    """
    rows = senses.select(row_id, head_of(F.col(head)).alias("h"), plain(F.col(definition)).alias("d"), F.col(source).alias("s")).where("h <> '' AND d <> ''").distinct()
    found = None
    for p in PHRASES:
        mine = F.col("s").isin(*p.sources) if p.sources else F.coalesce(~F.col("s").isin(*OWN), F.lit(True))
        made = F.when(mine, _said(p)).otherwise(F.array().cast("array<struct<synonym:string,confidence:int>>"))
        found = made if found is None else F.concat(found, made)
    each = rows.select(row_id, F.explode(found).alias("x")).groupBy(row_id, F.col("x.synonym").alias("synonym")).agg(F.max("x.confidence").alias("confidence"))
    return each.withColumn("level", text.literals({str(v): k for k, v in LEVELS.items()})[F.col("confidence").cast("string")])


def examples(definition: Column) -> Column:
    """array: the quoted sentences of a definition that can be examples, each once."""
    quoted = F.filter(F.regexp_extract_all(definition, F.lit("[\"“”']([^\"“”]+)[\"“”']"), 1), lambda x: F.length(x) >= 10)
    return F.array_distinct(F.filter(F.transform(quoted, text.example_sentence), text.valid_example))


#: References by type: the words before the target.
REFERENCES = (("see also", r"(?i)\bsee also ([A-Za-z][\w'-]*)"), ("see", r"(?i)\bsee (?!also )([A-Za-z][\w'-]*)"), ("compare", r"(?i)\b(?:compare|cf\.) ([A-Za-z][\w'-]*)"), ("see", r"→see:\s*([A-Za-z][\w'-]*)"))
# The relation that a type of reference becomes.
RELATION = {"see": "SEE", "see also": "RELATED_TO", "compare": "COMPARE"}


def references(definition: Column) -> Column:
    """array of struct(target, type): the words that a definition refers to, in small letters, each once a type."""
    typed = lambda k: lambda w: F.struct(text.reference_target(w).alias("target"), F.lit(k).alias("type"))
    found = [F.transform(F.regexp_extract_all(definition, F.lit(p), 1), typed(k)) for k, p in REFERENCES]
    return F.array_distinct(F.filter(F.concat(*found), lambda r: r["target"] != ""))


def etymology(definition: Column, languages: dict[str, str]) -> Column:
    """struct(etymology, language_code, rest): the line after `Etymology:` or `Origin:`, the language that is named first in
    the list of languages and in it, and the definition without it. All null where there is none."""
    line = F.regexp_extract(definition, r"(?i)\b(?:etymology|origin):?\s*([^\n]+)", 1)
    code = F.coalesce(*[F.when(F.lower(line).contains(name), F.lit(c)) for name, c in languages.items()])
    rest = text.trim(F.regexp_replace(definition, r"(?i)\b(?:etymology|origin):?\s*[^\n]+", ""))
    return F.when(text.trim(line) != "", F.struct(text.trim(line).alias("etymology"), code.alias("language_code"), rest.alias("rest")))


def domain(source: Column, raw: Column, definition: Column) -> Column:
    """The domain of a sense as its source writes it; null if it gives none."""
    first = lambda c, p: F.nullif(text.trim(F.regexp_extract(c, p, 1)), F.lit(""))
    plain_raw = text.trim(raw)
    label = F.get(F.split(text.trim(F.regexp_extract(plain_raw, "^【语域标签】：(.*)$", 1)), " +"), 0)
    marked = F.when(definition.rlike("主美|美式"), "US").when(definition.rlike("主英|英式"), "UK").when(definition.contains("正式"), "FORMAL")
    general = text.trim(F.regexp_replace(plain_raw, "[一-鿿]", ""))
    of = (
        F.when(source == _OXFORD, F.substring(text.trim(F.split(first(definition, r"^\(([^)]+)\)"), r"\.")[0]), 1, 100))
        .when(source == _COLLINS, F.coalesce(F.nullif(label, F.lit("")), marked))
        .when(source.isin("STRUCT_JSON", "KAIKKI"), F.substring(text.trim(F.translate(plain_raw, "<>()", "")), 1, 50))
        .when(source == "GUT_WEBSTER", F.regexp_replace(first(plain_raw, r"[<(]([^>)]+)[>)]"), r"\.+$", ""))
        .when(source == "CENTURY21", F.lit(None).cast("string"))
        .when(source == _CHN, first(definition, "〔([^〕]+)〕"))
        .when((F.length(plain_raw) > 100) | plain_raw.rlike(r"(?i)hours|days|weeks|minutes|seconds|o'clock"), F.lit(None).cast("string"))
        .otherwise(F.nullif(general, F.lit("")))
    )
    return F.when(~text.blank(raw), of)


def header_pos(definition: Column) -> Column:
    """The part of speech that a header of the form `word, n.` names; null if there is none."""
    code = F.lower(F.regexp_extract(definition, r"(?i),\s*(v\.t\.|v\.i\.|v\.|a\.|n\.)", 1))
    return F.when(code.startswith("v"), "verb").when(code == "a.", "adj").when(code == "n.", "noun")
