"""From staged entries to canonical words, senses and their child tables. All keys are deterministic, so runs repeat.

Repeated deliveries of an id are the same record. Empty tables give empty results; null keys are stated per function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.functions import language, text
from glossmill.session import maybe_broadcast

# Lengths of staged columns.
STAGED = {"word": 200, "normalized_word": 200, "part_of_speech": 50, "etymology": 4000, "source_code": 30}
# Words that may have a short definition.
SHORT_WORDS = ("a", "i", "an", "be", "is", "am", "to", "do", "go", "no", "so")
# Languages named in etymologies.
LANGUAGES = {
    "old english": "ang", "middle english": "enm", "old french": "fro", "old norse": "non", "latin": "la", "greek": "el", "french": "fr",
    "german": "de", "dutch": "nl", "italian": "it", "spanish": "es", "portuguese": "pt", "arabic": "ar", "hebrew": "he",
    "sanskrit": "sa", "persian": "fa", "hindi": "hi", "chinese": "zh", "japanese": "ja", "russian": "ru", "welsh": "cy", "malay": "ms",
}


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in a total order; nulls are one key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def staged(entries: DataFrame) -> DataFrame:
    """Entries with trimmed, shortened columns and hashes of word and key; rows without a word are left out."""
    cut = [text.shorten(F.col(c), n).alias(c) for c, n in STAGED.items()]
    out = entries.where(~text.blank(F.col("word"))).select("dictionary_entry_id", *cut, F.coalesce("sense_number", F.lit(1)).alias("sense_number"), "created_utc").dropDuplicates(["dictionary_entry_id"])
    return out.withColumn("word_hash", F.upper(F.sha2("word", 256))).withColumn("key_hash", F.upper(F.sha2(entry_key(F.col("source_code"), F.col("normalized_word"), F.col("sense_number")), 256)))


def entry_key(source: Column, word: Column, sense: Column) -> Column:
    """The logical key of an entry as one text."""
    return F.concat_ws("|", F.coalesce(source, F.lit("UNKNOWN")), F.coalesce(word, F.lit("")), sense.cast("string"))


def staging_stats(entries: DataFrame) -> DataFrame:
    """(source_code, total_rows, unique_keys, duplicates)."""
    n, k = F.count("*"), F.countDistinct(F.coalesce("normalized_word", F.lit("")), F.coalesce("sense_number", F.lit(1)))
    return entries.groupBy("source_code").agg(n.alias("total_rows"), k.alias("unique_keys"), (n - k).alias("duplicates"))


def merged(entries: DataFrame) -> DataFrame:
    """One entry of each (source_code, normalized_word, sense_number): the earliest, then the smallest id."""
    e = entries.where(~text.blank(F.col("word"))).select("dictionary_entry_id", "word", "normalized_word", F.coalesce("sense_number", F.lit(1)).alias("sense_number"), "source_code", "created_utc")
    # min_by over a struct combines before the shuffle; a window would not.
    best = F.min(F.struct("created_utc", "dictionary_entry_id", "word")).alias("m")
    return e.groupBy("source_code", "normalized_word", "sense_number").agg(best).select("m.dictionary_entry_id", "m.word", "normalized_word", "sense_number", "source_code")


def merge_into(new: DataFrame, existing: DataFrame) -> DataFrame:
    """The merged entries whose key no existing entry has; null sources and words are keys like others."""
    n, e = merged(new), existing.select(F.col("source_code").alias("s"), F.col("normalized_word").alias("w"), F.coalesce("sense_number", F.lit(1)).alias("k")).distinct()
    return n.join(e, F.col("source_code").eqNullSafe(F.col("s")) & F.col("normalized_word").eqNullSafe(F.col("w")) & (F.col("sense_number") == F.col("k")), "left_anti")


def canonical_words(entries: DataFrame) -> DataFrame:
    """(canonical_id, normalized_word, language, entries, sources): each eligible headword once, under a hash of itself."""
    e = entries.dropDuplicates(["dictionary_entry_id"]).select(text.sanitize_word(F.col("word")).alias("normalized_word"), text.word_language(F.col("word")).alias("language"), "source_code")
    e = e.where(text.canonical_eligible(F.col("normalized_word")))
    n = e.groupBy("normalized_word", "language").agg(F.count("*").alias("entries"), F.countDistinct("source_code").alias("sources"))
    return n.select(F.sha2("normalized_word", 256).alias("canonical_id"), "*")


def link_stats(entries: DataFrame, canonical: DataFrame) -> DataFrame:
    """(source_code, linked, unlinked, dangling): entries by whether their canonical word is given and exists."""
    known = canonical.select(F.col("canonical_word_id").alias("k"), F.lit(True).alias("known"))
    e = entries.dropDuplicates(["dictionary_entry_id"]).join(known, F.col("canonical_word_id") == F.col("k"), "left")
    has = F.col("canonical_word_id").isNotNull()
    return e.groupBy("source_code").agg(F.count_if(has & F.col("known").isNotNull()).alias("linked"), F.count_if(~has).alias("unlinked"), F.count_if(has & F.col("known").isNull()).alias("dangling"))


def resolve(entries: DataFrame, canonical: DataFrame) -> DataFrame:
    """(dictionary_entry_id, canonical_word_id): entries without a canonical word linked by their normalised word."""
    free = entries.where("canonical_word_id IS NULL AND normalized_word IS NOT NULL").select("dictionary_entry_id", "normalized_word").distinct()
    return free.join(canonical.select("normalized_word", "canonical_word_id"), "normalized_word").select("dictionary_entry_id", "canonical_word_id")


def validated(parsed: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, reason): why a sense is not valid, ok if it is."""
    word, definition = text.trim(F.col("meaning_title")), text.trim(F.col("definition"))
    short = ((F.length(word) == 1) | F.lower(word).isin(*SHORT_WORDS)) & (F.length(definition) >= 3)
    reason = (
        F.when(text.blank(F.col("meaning_title")), "word missing").when(text.blank(F.col("definition")), "definition missing").when(short, "ok")
        .when(F.length(definition) < 5, "definition too short").when(~definition.rlike(r"\p{L}"), "no letters").otherwise("ok")
    )
    return parsed.select("dictionary_entry_parsed_id", reason.alias("reason")).distinct()


def preprocessed(entries: DataFrame) -> DataFrame:
    """(dictionary_entry_id, word, language, normalized_word): entries as they are imported: without a marker of a domain before
    the word, and only those whose word may become a canonical one."""
    word = text.without_domain_marker(F.col("word")).alias("word")
    e = entries.select("dictionary_entry_id", word).distinct().select("*", text.word_language(F.col("word")).alias("language"), text.sanitize_word(F.col("word")).alias("normalized_word"))
    return e.where(text.canonical_eligible(F.col("normalized_word")))


def validated_by_source(parsed: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, reason): why a sense is not valid by the rules of its source, ok if it is.

    All need a title and a definition; Oxford's senses need a number from 1, Gutenberg's more than five characters, and those
    of the bilingual lines a double arrow or a Chinese character.
    """
    d = text.trim(F.col("definition"))
    s = F.col("source_code")
    reason = (
        F.when(text.blank(F.col("meaning_title")), "word missing").when(text.blank(F.col("definition")), "definition missing")
        .when((s == "ENG_OXFORD") & (F.coalesce("sense_number", F.lit(0)) < 1), "no sense number").when((s == "GUT_WEBSTER") & (F.length(d) <= 5), "definition too short")
        .when((s == "ENG_CHN") & ~d.rlike("[⬄一-鿿]"), "not bilingual").otherwise("ok")
    )
    return parsed.select("dictionary_entry_parsed_id", reason.alias("reason")).distinct()


def other_languages(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Definitions in other languages and what replaces them.

    (text_id, source_code, language, characters, text): each text once a source; (dictionary_entry_parsed_id, text_id,
    shown): the placeholder of each sense that had one.
    """
    d = F.col("definition")
    found = parsed.where(language.contains_non_english(d) | language.is_bilingual(d)).select("dictionary_entry_parsed_id", "source_code", d.alias("text")).distinct()
    found = found.withColumn("text_id", F.sha2(F.concat_ws("|", F.coalesce("source_code", F.lit("UNKNOWN")), "text"), 256))
    side = found.select("text_id", "source_code", language.primary_language(F.col("text")).alias("language"), F.length("text").alias("characters"), "text").distinct()
    shown = found.select("dictionary_entry_parsed_id", "text_id", text.placeholder(F.lit("Definition"), language.is_bilingual(F.col("text"))).alias("shown"))
    return side, shown


def synonyms(synonym: DataFrame, parsed: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, synonym, source_code): each valid synonym of a sense once, compared without case."""
    head = parsed.select("dictionary_entry_parsed_id", F.col("meaning_title").alias("head")).groupBy("dictionary_entry_parsed_id").agg(F.min("head").alias("head"))
    s = synonym.select("dictionary_entry_parsed_id", text.synonym_text(F.col("synonym_text")).alias("synonym"), "source_code").join(head, "dictionary_entry_parsed_id")
    s = s.where(text.valid_synonym(F.col("synonym"), F.col("head")))
    return s.groupBy("dictionary_entry_parsed_id", "source_code", F.lower("synonym").alias("k")).agg(F.min("synonym").alias("synonym")).select("dictionary_entry_parsed_id", "synonym", "source_code")


def new_synonyms(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates (dictionary_entry_parsed_id, synonym, source_code) that are not stored yet."""
    e = existing.select(F.col("dictionary_entry_parsed_id").alias("p"), F.col("synonym_text").alias("t"), F.col("source_code").alias("s")).distinct()
    return candidates.join(e, F.col("dictionary_entry_parsed_id").eqNullSafe(F.col("p")) & F.col("synonym").eqNullSafe(F.col("t")) & F.col("source_code").eqNullSafe(F.col("s")), "left_anti")


def related(parsed: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, word, kind): what a definition's wording relates its sense to.

    kind: compare (`compare x`), antonym (`opposed to x`), likeness (`like x`), shape (`shaped like a x`).
    """
    d = F.lower(F.col("definition"))
    kinds = {"compare": r"compare ([a-z]+)", "antonym": r"opposed to ([a-z]+)", "likeness": r"as with (?:a |an |the )?([a-z]+)", "shape": r"shaped like (?:a |an |the )?([a-z]+)"}
    named = lambda kind: lambda w: F.struct(w.alias("word"), F.lit(kind).alias("kind"))
    arrays = [F.transform(F.regexp_extract_all(d, F.lit(p), 1), named(k)) for k, p in kinds.items()]
    return parsed.where("definition IS NOT NULL").select("dictionary_entry_parsed_id", F.explode(F.concat(*arrays)).alias("r")).select("dictionary_entry_parsed_id", "r.word", "r.kind").distinct()


def cross_references(parsed: DataFrame, entries: DataFrame) -> DataFrame:
    """(from_id, to_id, relation_type): `compare x` as an edge to every sense of the entries whose word is x."""
    r = related(parsed).where("kind = 'compare'").select(F.col("dictionary_entry_parsed_id").alias("from_id"), "word")
    e = entries.select("dictionary_entry_id", F.lower("normalized_word").alias("word")).distinct()
    p = parsed.select("dictionary_entry_id", F.col("dictionary_entry_parsed_id").alias("to_id")).distinct()
    return r.join(e, "word").join(p, "dictionary_entry_id").select("from_id", "to_id", F.lit("COMPARE").alias("relation_type")).distinct()


def without_antonyms(parsed: DataFrame) -> DataFrame:
    """Related words of a sense that no sense names as an opposite of the same sense's words."""
    r = related(parsed)
    bad = r.where("kind = 'antonym'").select("dictionary_entry_parsed_id", "word").distinct()
    return r.where("kind <> 'antonym'").join(bad, ["dictionary_entry_parsed_id", "word"], "left_anti")


def etymologies(entries: DataFrame) -> DataFrame:
    """(dictionary_entry_id, etymology, language_code): the language that is named first in the text, longest name first."""
    names = "|".join(sorted(LANGUAGES, key=lambda n: (-len(n), n)))
    t = text.etymology_text(F.col("etymology"))
    code = text.literals(LANGUAGES)[F.regexp_extract(F.lower(t), rf"\b({names})\b", 1)]
    return entries.select("dictionary_entry_id", t.alias("etymology"), code.alias("language_code")).where("etymology <> ''").distinct()


def variants(entries: DataFrame) -> DataFrame:
    """(dictionary_entry_id, variant, kind): the spelling of a word where it differs from its normalised one."""
    kind = F.when(F.lower("word") == F.col("normalized_word"), "case").when(text.normalize_word(F.col("word")) == F.col("normalized_word"), "marks").otherwise("spelling")
    return entries.where("word <> normalized_word").select("dictionary_entry_id", F.col("word").alias("variant"), kind.alias("kind")).distinct()


def top_synonyms(synonym: DataFrame, n: int) -> DataFrame:
    """(dictionary_entry_parsed_id, rank, synonym_text): the first n synonyms of each sense by id; n is kept in 1..50.

    A sense with very many synonyms is reduced before its rows meet: ranks are first taken within slices of ids.
    """
    n = min(max(n, 1), 50)
    s = synonym.select("dictionary_entry_parsed_id", "dictionary_entry_synonym_id", "synonym_text").dropDuplicates(["dictionary_entry_synonym_id"]).withColumn("slice", F.pmod("dictionary_entry_synonym_id", F.lit(64)))
    w = lambda *keys: Window.partitionBy(*keys).orderBy("dictionary_entry_synonym_id")
    part = s.withColumn("r", F.row_number().over(w("dictionary_entry_parsed_id", "slice"))).where(F.col("r") <= n)
    return part.withColumn("rank", F.row_number().over(w("dictionary_entry_parsed_id"))).where(F.col("rank") <= n).select("dictionary_entry_parsed_id", "rank", "synonym_text")


def running_senses(parsed: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, running): senses of an entry numbered by sense_number, then id, from 1."""
    p = parsed.select("dictionary_entry_id", "dictionary_entry_parsed_id", "sense_number").dropDuplicates(["dictionary_entry_parsed_id"])
    w = Window.partitionBy("dictionary_entry_id").orderBy(F.col("sense_number").asc_nulls_last(), "dictionary_entry_parsed_id")
    return p.select("dictionary_entry_parsed_id", F.row_number().over(w).alias("running"))


def labels_by_source(parsed: DataFrame, labels: DataFrame) -> DataFrame:
    """(source_code, domain, senses): senses with a domain of the catalogue."""
    known = maybe_broadcast(labels.where("label_kind = 'domain'").select(F.col("canonical_label").alias("domain")))
    return parsed.dropDuplicates(["dictionary_entry_parsed_id"]).join(known, "domain", "left_semi").groupBy("source_code", "domain").agg(F.count("*").alias("senses"))
