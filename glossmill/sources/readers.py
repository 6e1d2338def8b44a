"""Readers of the seven dictionary formats and of pronunciation tables.

Every reader gives the columns of ENTRY: one row a sense, senses numbered from 1. Lines and entries that cannot be read
are left out; rejected() counts them for formats of one record a line. Blank and null texts give no senses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.sources.lines import blocks, lines, running

ENTRY = ("source_code", "headword", "part_of_speech", "sense_number", "definition", "examples", "synonyms", "domain", "etymology", "pronunciation", "see_also", "raw")

# Codes of parts of speech in the block format.
CODES = {
    "N": "noun", "NOUN": "noun", "V": "verb", "VERB": "verb", "ADJ": "adj", "ADJECTIVE": "adj", "ADV": "adv", "ADVERB": "adv", "PREP": "preposition",
    "PREPOSITION": "preposition", "CONJ": "conjunction", "CONJUNCTION": "conjunction", "PRON": "pronoun", "PRONOUN": "pronoun", "DET": "determiner",
    "DETERMINER": "determiner", "PHR": "phrase", "PHRASE": "phrase", "ABBR": "abbreviation", "ABBREVIATION": "abbreviation", "PREFIX": "prefix",
    "SUFFIX": "suffix", "NUM": "numeral", "NUMERAL": "numeral", "SYMBOL": "symbol", "INTERJ": "interjection", "INTERJECTION": "interjection",
}
# Marks of domains and registers in the bilingual line format.
MARKS = {"医": "medicine", "化": "chemistry", "物": "physics", "数": "mathematics", "生": "biology", "律": "law", "军": "military", "音": "music", "计": "computing", "口": "informal", "俚": "slang", "古": "archaic", "书": "literary", "方": "dialectal"}
HAN = "[一-鿿]"


def _entry(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    none = {"examples": F.array().cast("array<string>"), "synonyms": F.array().cast("array<string>"), "see_also": F.array().cast("array<string>")}
    made = {"source_code": F.lit(source)} | columns
    return df.select(*[made.get(c, none.get(c, F.lit(None).cast("string"))).alias(c) for c in ENTRY])


def _rest(a: Column | str) -> Column:
    """All but the first of an array."""
    a = F.col(a) if isinstance(a, str) else a
    return F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0)))


def _distinct(a: Column) -> Column:
    """Trimmed texts of an array, blanks dropped, each once."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), text.squeeze), lambda x: x != ""))


KAIKKI = """word string, pos string, lang string, lang_code string, etymology_text string, senses array<struct<glosses:array<string>,
raw_glosses:array<string>, examples:array<struct<text:string>>, synonyms:array<struct<word:string>>, related:array<struct<word:string,sense:string>>,
categories:array<struct<name:string>>, tags:array<string>>>, sounds array<struct<ipa:string>>"""


def read_kaikki(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a line; English entries only; raw_glosses where glosses are missing; each gloss once a word."""
    j = spark.read.text(path).select(F.trim("value").alias("raw")).where("raw <> ''").withColumn("j", F.from_json("raw", KAIKKI))
    j = j.where("j.word IS NOT NULL AND (lower(j.lang_code) = 'en' OR lower(j.lang) LIKE '%english%')")
    none = F.array().cast("array<string>")
    gloss = lambda s: clean_wiki(F.try_element_at(F.when(F.size(F.coalesce(s["glosses"], none)) > 0, s["glosses"]).otherwise(s["raw_glosses"]), F.lit(-1)))
    glossed = F.filter(F.transform("j.senses", lambda s: F.struct(s.alias("s"), gloss(s).alias("gloss"))), lambda x: x["gloss"] != "")
    # Of equal glosses the first stays, all within the row.
    j = j.withColumn("all", glossed)
    first = F.filter("all", lambda x, i: F.array_position(F.transform(F.col("all"), lambda y: y["gloss"]), x["gloss"]) == i + 1)
    s = j.select("raw", "j", F.posexplode(first).alias("i", "x")).select("raw", "j", (F.col("i") + 1).alias("sense"), "x.s", "x.gloss")
    return _entry(
        s, "KAIKKI", headword=F.col("j.word"), part_of_speech=text.normalize_pos(F.col("j.pos")), sense_number=F.col("sense"), definition=F.col("gloss"),
        examples=_distinct(F.col("s.examples.text")), synonyms=_distinct(F.col("s.synonyms.word")), domain=F.get(F.col("s.categories.name"), 0),
        etymology=clean_wiki(F.col("j.etymology_text")), pronunciation=F.get(F.filter("j.sounds.ipa", lambda x: x.isNotNull()), 0), see_also=_distinct(F.col("s.related.word")), raw=F.col("raw"),
    )


def clean_wiki(c: Column) -> Column:
    """A text without wiki marks: templates, links, quotes, references and tags."""
    t = c
    for _ in range(3):
        t = F.regexp_replace(t, r"\{\{[^{}]*\}\}", "")
    for a, b in ((r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"), (r"\[\[([^\[\]]*)\]\]", "$1"), ("'{2,}", ""), (r"(?s)<ref[^>]*>.*?</ref>", ""), ("<[^>]+>", ""), (r"[|{}]", " ")):
        t = F.regexp_replace(t, a, b)
    return text.squeeze(t)


def read_structured(spark: SparkSession, path: str) -> DataFrame:
    """JSON maps of entries; senses by their sequence, 1 where it is not positive.

    A file is parted where an entry begins, one level below the map, so it is read in splits; a map on one line is one row.
    """
    entry = "struct<original_cased_word:string, transliterated_word:string, definitions:array<struct<part_of_speech:string, definition:string, sequence:int>>>"
    bare = F.regexp_replace("line", r'"(?:[^"\\\\]|\\\\.)*"', "")
    depth = F.length(F.regexp_replace(bare, r"[^{\[]", "")) - F.length(F.regexp_replace(bare, r"[^}\]]", ""))
    n = running(lines(spark, path).withColumn("depth", depth), "depth")
    whole = n.where((F.col("before") == 0) & (F.col("depth") == 0) & F.col("line").rlike(r"^\s*\{.*\}\s*$")).select(F.col("line").alias("value"))
    parts = blocks(n.where(~((F.col("before") == 0) & (F.col("depth") == 0))), (F.col("before") == 1) & F.col("line").rlike(r'^\s*"'))
    # The last entry's block ends with the bracket of the map.
    text_of = F.regexp_replace(F.array_join("lines", "\n"), r"\s*,?\s*$", "")
    parted = F.when(F.from_json(F.concat(F.lit("{"), text_of, F.lit("}")), f"map<string, {entry}>").isNotNull(), F.concat(F.lit("{"), text_of, F.lit("}"))).otherwise(F.concat(F.lit("{"), text_of))
    m = whole.union(parts.select(parted)).select(F.explode(F.from_json("value", f"map<string, {entry}>")).alias("key", "e")).where("e IS NOT NULL")
    d = m.select("key", "e", F.explode("e.definitions").alias("d")).where(~text.blank(F.col("d.definition")))
    return _entry(d, "STRUCT_JSON", headword=F.coalesce("e.original_cased_word", "key"), part_of_speech=text.normalize_pos(F.col("d.part_of_speech")), sense_number=F.when(F.col("d.sequence") > 0, F.col("d.sequence")).otherwise(1), definition=text.squeeze(F.col("d.definition")), raw=F.to_json("d"))


def read_bilingual_lines(spark: SparkSession, path: str) -> DataFrame:
    """`headword ⬄ rest` a line, or a headword up to a blank, slash or bracket; the English part of the rest is the sense."""
    line = F.col("value")
    parted = line.contains("⬄")
    head = text.trim(F.when(parted, F.substring_index(line, "⬄", 1)).otherwise(F.regexp_replace(F.regexp_extract(line, r"^([^\[/\s]+)", 1), "[.;:!?·]+$", "")))
    rest = F.when(parted, F.expr("substring(value, instr(value, '⬄') + 1)")).otherwise(F.expr("substring(value, length(regexp_extract(value, '^([^\\\\[/\\\\s]+)', 1)) + 1)"))
    ok = (F.length(head) <= 100) & head.rlike(r"^[\p{L}\p{N}]") & head.rlike(r"\p{L}|^\d+$|^\d+[-/]\d+$")
    t = spark.read.text(path).where(ok).select(head.alias("head"), rest.alias("rest"), F.col("value"))
    r = F.col("rest")
    english = F.regexp_replace(r, r"/[^/]*/|〔[^〕]*〕|〈[^〉]*〉|\[<[^\]]*\]|[一-鿿，。；：、（）]+", " ")
    parts = F.filter(F.transform(F.split(english, r"(?:^|\s)\d+[.)]\s*"), lambda x: text.squeeze(F.regexp_replace(x, r"^\s*(?:n|v|vt|vi|adj|adv|prep|conj|pron|int)\.\s*", ""))), lambda x: x.rlike("[A-Za-z]"))
    s = t.select("head", "rest", "value", F.posexplode(F.when(F.size(parts) > 0, parts).otherwise(F.array(text.squeeze(r)))).alias("i", "d"))
    return _entry(
        s, "ENG_CHN", headword=F.col("head"), part_of_speech=text.normalize_pos(F.regexp_extract(r, r"\b(n|v|vt|vi|adj|adv|prep|conj|pron|int)\.", 0)), sense_number=F.col("i") + 1, definition=F.col("d"),
        domain=text.literals(MARKS)[F.regexp_extract(r, "[〔〈]([^〕〉])[〕〉]", 1)], etymology=F.nullif(F.regexp_extract(r, r"\[<([^\]]*)\]", 1), F.lit("")), pronunciation=F.nullif(F.regexp_extract(r, "/[^/]+/", 0), F.lit("")), raw=F.col("value"),
    )


def read_pronunciations(spark: SparkSession, path: str, locale: str) -> DataFrame:
    """(word, ipa, locale) of a table `word<TAB>ipa, alternatives`; lines of one column are left out."""
    parts = F.split("value", "\t")
    t = spark.read.text(path).where(F.size(parts) >= 2)
    return t.select(F.lower(text.trim(parts[0])).alias("word"), F.regexp_replace(text.trim(F.split(parts[1], ",")[0]), "^/+|/+$", "").alias("ipa"), F.lit(locale).alias("locale")).where("word <> '' AND ipa <> ''")


def read_headword_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Entries under a line in capitals; senses at `N.` or `Defn:`; `Etym:`, `Syn.` and `--` begin other parts.

    Two blank lines end an entry; licence lines are skipped.
    """
    n = lines(spark, path).where(~F.trim("line").rlike(r"^(\*\*\*|Project Gutenberg|Title:|Author:)"))
    t = F.trim("line")
    b = blocks(n, (F.length(t).between(1, 80)) & t.rlike(r"^[A-Z][A-Z'\- ;.,]*(?:\(\w+\))?\.?$") & t.rlike("[A-Z]{2,}|^A$"))
    body = F.split(F.array_join(_rest("lines"), "\n"), r"\n\s*\n\s*\n")[0]
    b = b.select(F.trim(F.regexp_replace(F.col("lines")[0], r"[.;]+$", "")).alias("head"), body.alias("body"))
    parts = F.transform(F.split("body", r"(?m)^\s*(?:\d+\.\s+|Defn:\s*)"), lambda x: text.squeeze(F.regexp_replace(F.regexp_replace(x, r"(?s)(?:Etym:|Syn\.|\n\s*--).*", ""), r"\n", " ")))
    good = F.filter(_rest(parts), lambda x: F.length(x) >= 10)
    s = b.withColumn("first", parts[0]).select("*", F.posexplode(F.array_distinct(good)).alias("i", "d"))
    pos = F.regexp_extract("first", r"\b(n|v|a|adv|prep|conj|pron|interj|adj)\.", 0)
    return _entry(
        s, "GUT_WEBSTER", headword=F.initcap("head"), part_of_speech=text.normalize_pos(F.when(pos == "a.", "adj.").when(pos == "", "n.").otherwise(pos)), sense_number=F.col("i") + 1,
        definition=F.when(F.col("d").endswith("."), F.col("d")).otherwise(F.concat("d", F.lit("."))), examples=_distinct(F.regexp_extract_all("body", F.lit("[\"“]([^\"”]{6,250})[\"”]"), 1)),
        synonyms=_distinct(F.split(F.regexp_extract("body", r"(?s)Syn\.\s*-*\s*([^\n.]+)", 1), r"[,;]")), domain=F.nullif(F.lower(F.regexp_extract("body", r"\(([A-Z][a-z]+)\.\)", 1)), F.lit("")),
        etymology=F.nullif(text.squeeze(F.regexp_extract("body", r"(?s)Etym:\s*\[([^\]]*)\]", 1)), F.lit("")), pronunciation=F.nullif(F.regexp_extract("first", r"^([^,]*[\"*`][^,]*),", 1), F.lit("")), raw=F.col("body"),
    )


def read_separated_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Entries between rules of dashes; senses at `N.CODE`; `•` and `...` examples, `【…】：` notes, `→see:` references."""
    n = lines(spark, path).withColumn("line", text.trim(F.col("line"))).where("line <> ''")
    b = blocks(n, F.col("line").rlike("^(——————————————|---------------|================)"))
    b = b.select(F.filter(_rest("lines"), lambda x: x != "").alias("lines")).where(F.size("lines") > 1)
    head = F.get(F.filter(F.slice("lines", 1, 3), lambda x: ~x.rlike(r"^\d+\.[A-Z]|^【|^•|^\.\.\.") & x.rlike("[A-Za-z]")), 0)
    b = b.select(F.regexp_extract(F.trim(F.regexp_replace(head, "[★☆●○]+", " ")), r"^([A-Za-z0-9'\-]+)", 1).alias("head"), F.array_join("lines", "\n").alias("body")).where("head <> ''")
    pieces = _rest(F.split("body", r"(?m)^(?=\d+\.[A-Z])"))
    s = b.select("head", F.explode(pieces).alias("p"))
    p = F.split("p", "\n")
    note = lambda name: F.nullif(F.trim(F.regexp_extract("p", f"【{name}】：\\s*(.+)", 1)), F.lit(""))
    english = lambda x: F.trim(F.split(x, HAN)[0])
    ends = lambda x: F.when(x.rlike("[.!?]$"), x).otherwise(F.concat(x, F.lit(".")))
    shown = F.filter(F.transform(F.filter(p, lambda x: x.rlike(r"^(\.\.\.|•)")), lambda x: ends(english(F.regexp_replace(x, r"^(\.\.\.|•)\s*", "")))), lambda x: F.length(x) > 10)
    own = F.filter(p, lambda x: ~x.rlike(r"^(\.\.\.|•|【)") & ~x.contains("→see:"))
    definition = text.squeeze(F.regexp_replace(F.regexp_replace(F.array_join(own, " "), r"^\d+\.[A-Z][A-Z\-]+", ""), f"{HAN}|[，。；：、（）]", ""))
    code = F.regexp_extract("p", r"^\d+\.([A-Z]+)", 1)
    s = s.withColumn("d", definition).where("d <> ''")
    return _entry(
        s, "ENG_COLLINS", headword=F.col("head"), part_of_speech=F.coalesce(text.literals(CODES)[code], F.lower(code)), sense_number=F.regexp_extract("p", r"^(\d+)\.", 1).cast("int"), definition=F.col("d"), examples=_distinct(shown),
        domain=F.coalesce(note("语域标签"), note("FIELD标签")), see_also=_distinct(F.regexp_extract_all("p", F.lit(r"→see:\s*([^;\n]+)"), 1)), raw=F.col("p"),
    )


def read_sectioned_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Entries under a headword line that a `▶` block follows; numbered senses with labels, `»` examples, `【…】` sections."""
    n = lines(spark, path).withColumn("line", text.trim(F.col("line"))).where("line <> ''")
    b = blocks(n, F.col("line").rlike(r"^[A-Za-z][A-Za-z'\- ]*\d*(?:\s+/[^/]+/)?(?:\s*▶.*)?$") & ~F.col("line").rlike("[.!?:,;]$"))
    b = b.select(F.col("lines")[0].alias("h"), F.array_join(_rest("lines"), "\n").alias("body"), F.array_join("lines", "\n").alias("raw"))
    head = F.trim(F.regexp_replace(F.regexp_extract("h", r"^([A-Za-z][A-Za-z'\- ]*)", 1), r"\s*\d+$", ""))
    section = lambda name: F.nullif(text.squeeze(F.regexp_extract("body", f"(?s)【(?:{name})】\\s*([^【]*)", 1)), F.lit(""))
    main = F.regexp_replace("body", r"(?s)【(?:Etymology|语源|派生|IDIOMS)】[^【]*", "")
    s = b.select("h", "body", "raw", F.explode(_rest(F.split(main, r"(?m)^(?=\d+\s)"))).alias("p"))
    label = F.regexp_extract("p", r"^\d+\s+[\[(]([^\])]+)[\])]", 1)
    definition = text.squeeze(F.regexp_replace(F.split(F.regexp_replace(F.split("p", "[»•【]")[0], r"^\d+\s*(?:[\[(][^\])]+[\])]\s*)*", ""), HAN)[0], r"\n", " "))
    s = s.withColumn("d", definition).where("d <> ''")
    return _entry(
        s, "ENG_OXFORD", headword=head, part_of_speech=text.normalize_pos(F.regexp_extract("raw", r"▶\s*(?:for\s+)?([a-z]+)", 1)), sense_number=F.regexp_extract("p", r"^(\d+)", 1).cast("int"), definition=F.col("d"),
        examples=_distinct(F.regexp_extract_all("p", F.lit(r"»\s*([^\n»一-鿿]+)"), 1)), domain=F.nullif(label, F.lit("")), etymology=section("Etymology|语源"), pronunciation=F.nullif(F.regexp_extract("h", "/[^/]+/", 0), F.lit("")), raw=F.col("raw"),
    )


def html_text(html: str | None) -> str | None:
    """The text of a piece of HTML, entities decoded, scripts and styles left out, white space squeezed."""
    if html is None:
        return None
    from html.parser import HTMLParser

    out: list[str] = []

    class Parser(HTMLParser):
        skip = 0

        def handle_starttag(self, tag: str, attrs: list) -> None:
            self.skip += tag in ("script", "style")

        def handle_endtag(self, tag: str) -> None:
            self.skip -= tag in ("script", "style") and self.skip > 0

        def handle_data(self, data: str) -> None:
            if not self.skip:
                out.append(data)

    p = Parser(convert_charrefs=True)
    p.feed(html)
    p.close()
    return " ".join("".join(out).split())


def html_blocks(html: str) -> list[dict]:
    """Each `word_block` division: the texts of its named parts, senses in order."""
    from html.parser import HTMLParser

    void = {"br", "hr", "img", "input", "link", "meta", "wbr"}
    found: list[dict] = []

    class Parser(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.stack: list[str] = []

        def handle_starttag(self, tag: str, attrs: list) -> None:
            if tag in void:
                return
            names = (dict(attrs).get("class") or "").split()
            self.stack.append(next((n for n in names if n in ("word_block", "headword", "phonetics", "pos", "definition", "gram", "example")), ""))
            if self.stack[-1] == "word_block":
                found.append({"definition": [], "example": []})
            elif self.stack[-1] in ("definition", "example") and found:
                found[-1][self.stack[-1]].append("")

        def handle_endtag(self, tag: str) -> None:
            if tag not in void and self.stack:
                self.stack.pop()

        def handle_data(self, data: str) -> None:
            name = next((n for n in reversed(self.stack) if n), "")
            if not found or name in ("", "word_block"):
                return
            if name in ("definition", "example"):
                found[-1][name][-1] += data
            else:
                found[-1][name] = found[-1].get(name, "") + data

    Parser().feed(html)
    return found


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """Files of HTML with `word_block` divisions; a block without a definition gets `Definition for <headword>`."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for html in b.value:
                for e in html_blocks(html or ""):
                    head = " ".join(e.get("headword", "").split())
                    if head:
                        senses = [x for d in e["definition"] if (x := " ".join(d.split()))] or [f"Definition for {head}"]
                        rows += [(head, e.get("pos", "").strip(), i, d, e["example"], e.get("gram", "").strip() or None, e.get("phonetics", "").strip() or None) for i, d in enumerate(senses, 1)]
            yield pd.DataFrame(rows, columns=["head", "pos", "i", "d", "examples", "gram", "ipa"])

    # A block begins at its division, so files are read in splits.
    starts = r"(?i)(?=<div[^>]*\bword_block\b)"
    pieces = lines(spark, path).select("file", "split", "pos", F.posexplode(F.split("line", starts)).alias("piece", "line")).withColumn("pos", F.struct("pos", "piece"))
    b = blocks(pieces, F.col("line").rlike(r"(?i)^<div[^>]*\bword_block\b"))
    t = b.select(F.array_join("lines", "\n").alias("value")).mapInPandas(parse, "head string, pos string, i int, d string, examples array<string>, gram string, ipa string")
    return _entry(t, "CENTURY21", headword=F.col("head"), part_of_speech=text.normalize_pos(F.col("pos")), sense_number=F.col("i"), definition=F.col("d"), examples=_distinct(F.col("examples")), domain=F.col("gram"), pronunciation=F.col("ipa"))


@dataclass(frozen=True)
class Source:
    """A source of entries: its code, its reader, and whether a run replaces or adds to what is stored."""

    code: str
    read: Callable[[SparkSession, str], DataFrame]
    rebuild: bool = True


SOURCES = {
    s.code: s
    for s in (
        Source("KAIKKI", read_kaikki), Source("GUT_WEBSTER", read_headword_blocks, rebuild=False), Source("ENG_COLLINS", read_separated_blocks), Source("ENG_OXFORD", read_sectioned_blocks),
        Source("STRUCT_JSON", read_structured), Source("ENG_CHN", read_bilingual_lines), Source("CENTURY21", read_html),
    )
}


def read(spark: SparkSession, code: str, path: str, most: int | None = None) -> DataFrame:
    """The entries of a source; most: read so many at most."""
    if code not in SOURCES:
        raise KeyError(f"no source {code}; there are {', '.join(SOURCES)}")
    df = SOURCES[code].read(spark, path)
    return df if most is None else df.limit(most)


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """(file, rejected): lines of a JSONL source that hold no entry."""
    t = spark.read.text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.from_json("value", KAIKKI).alias("j"))
    return t.groupBy("file").agg(F.count_if(F.col("j.word").isNull()).alias("rejected"))


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A table partitioned by source; a run replaces only the sources it holds."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("source_code").parquet(path)
