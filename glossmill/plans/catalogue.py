"""The queries of the core operators, each over whole tables, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.functions import display, language, speech, text
from glossmill.operators import ai, extract, grammar, graph, lexicon, parse, references, rewrite, skew, suggest, verify
from glossmill.plans import oracles
from glossmill.session import cut, spread, table
from glossmill.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = oracles.SQL


def _over(*names: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a function of those tables as a query of its name."""

    def register(op: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[op.__name__.lstrip("_")] = lambda spark, d: op(*[table(spark, d, n) for n in names])
        return op

    return register


def _add(name: str, op: Callable[..., DataFrame], *names: str) -> None:
    QUERIES[name] = lambda spark, d: op(*[table(spark, d, n) for n in names])


ENTRY, PARSED, SYNONYM, CANONICAL, LABEL = "dictionary_entry", "dictionary_entry_parsed", "dictionary_entry_synonym", "canonical_word", "label_catalog"
EDGE, NODE, RELATION = "graph_edge", "graph_node", "graph_relation"

# Problem 2.
_add("p2_found", references.found, EDGE, NODE, RELATION, LABEL)
_add("p2_report", references.report, EDGE, NODE, RELATION, LABEL)

# Staging, merge, canonical words.
_add("canonical_words", lexicon.canonical_words, ENTRY)
_add("canonical_link_stats", lexicon.link_stats, ENTRY, CANONICAL)
_add("canonical_resolve", lexicon.resolve, ENTRY, CANONICAL)
_add("staging_rows", lambda e: lexicon.staged(e).drop("created_utc"), ENTRY)
_add("staging_stats", lexicon.staging_stats, ENTRY)
_add("merge_dedupe", lexicon.merged, ENTRY)
_add("post_merge_verify", verify.post_merge, ENTRY, CANONICAL)
_add("validate_entries", lexicon.validated, PARSED)
_add("running_senses", lexicon.running_senses, PARSED)
_add("word_variants", lexicon.variants, ENTRY)
_add("labels_by_source", lexicon.labels_by_source, PARSED, LABEL)


@_over(ENTRY)
def merge_append(e: DataFrame) -> DataFrame:
    """What a run adds to the entries of other sources than the largest one: keys KAIKKI has and they lack."""
    return lexicon.merge_into(e.where("source_code = 'KAIKKI'"), e.where("source_code <> 'KAIKKI'").withColumn("source_code", F.lit("KAIKKI")))


# Text functions.
def _each(name: str, source: str, row_id: str, column: str, function: Callable[[Column], Column]) -> None:
    _add(name, lambda t: t.select(row_id, function(F.col(column)).alias("value")).distinct(), source)


_each("word_normalize", ENTRY, "dictionary_entry_id", "word", text.normalize_word)
_each("word_sanitize", ENTRY, "dictionary_entry_id", "word", text.sanitize_word)
_each("pos_normalize", ENTRY, "dictionary_entry_id", "part_of_speech", text.normalize_pos)
_each("synonym_clean", SYNONYM, "dictionary_entry_synonym_id", "synonym_text", text.synonym_text)
_each("alias_clean", PARSED, "dictionary_entry_parsed_id", "meaning_title", text.alias_text)
_each("reference_target", SYNONYM, "dictionary_entry_synonym_id", "synonym_text", text.reference_target)
_each("etymology_clean", ENTRY, "dictionary_entry_id", "etymology", text.etymology_text)
_each("example_key", PARSED, "dictionary_entry_parsed_id", "definition", text.example_key)
_each("ocr_normalize", PARSED, "dictionary_entry_parsed_id", "definition", text.ocr_normalize)
_each("definition_tidy", PARSED, "dictionary_entry_parsed_id", "definition", text.tidy_definition)
_each("definition_senses", PARSED, "dictionary_entry_parsed_id", "definition", lambda c: F.array_join(text.senses(c), "|"))
_each("bracket_balance", PARSED, "dictionary_entry_parsed_id", "definition", rewrite.balanced)
_each("abbreviation_standardize", ENTRY, "dictionary_entry_id", "part_of_speech", rewrite.abbreviations)
_each("punctuation_normalize", PARSED, "dictionary_entry_parsed_id", "definition", rewrite.punctuation)
_each("title_case", PARSED, "dictionary_entry_parsed_id", "meaning_title", rewrite.title_case)
_each("primary_language", PARSED, "dictionary_entry_parsed_id", "definition", language.primary_language)


@_over(ENTRY)
def word_for_source(e: DataFrame) -> DataFrame:
    return e.select("dictionary_entry_id", text.normalize_word_for(F.col("word"), F.col("source_code")).alias("value")).distinct()


@_over(ENTRY)
def pos_confidence(e: DataFrame) -> DataFrame:
    pos = text.normalize_pos(F.col("part_of_speech"))
    return e.select("dictionary_entry_id", pos.alias("pos"), text.pos_confidence(pos, F.col("source_code")).alias("confidence")).distinct()


@_over(PARSED)
def pos_infer(p: DataFrame) -> DataFrame:
    """The part of speech that each definition's wording suggests."""
    return p.select("dictionary_entry_parsed_id", text.infer_pos(F.col("definition")).alias("p")).select("dictionary_entry_parsed_id", "p.pos", "p.confidence").distinct()


@_over(ENTRY, PARSED)
def pos_history(e: DataFrame, p: DataFrame) -> DataFrame:
    """(source_code, status, entries): entries whose part of speech is given, inferred from a sense, or stays unknown."""
    best = p.select("dictionary_entry_id", text.infer_pos(F.col("definition")).alias("x")).where("x.pos <> 'unk'").select("dictionary_entry_id").distinct().withColumn("inferred", F.lit(True))
    status = F.when(text.normalize_pos(F.col("part_of_speech")) != "unk", "given").when(F.col("inferred"), "inferred").otherwise("unknown")
    return e.dropDuplicates(["dictionary_entry_id"]).join(best, "dictionary_entry_id", "left").groupBy("source_code", status.alias("status")).agg(F.count("*").alias("entries"))


@_over("documents")
def tokenize_words(d: DataFrame) -> DataFrame:
    """(word, occurrences): the words of all documents."""
    return d.select(F.explode(text.tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("occurrences"))


@_over("documents")
def language_flags(d: DataFrame) -> DataFrame:
    t = F.col("text")
    return d.select("doc_id", language.contains_non_english(t).alias("non_english"), language.is_bilingual(t).alias("bilingual"), language.is_primarily_english(t).alias("english"))


@_over("documents")
def language_distribution(d: DataFrame) -> DataFrame:
    x = d.select("doc_id", language.distribution(F.col("text")).alias("s"))
    return x.select("doc_id", *[F.round(f"s.{c}", 4).alias(c) for c in ("latin", "chinese", "japanese", "korean", "ipa", "other")])


@_over(PARSED)
def non_english_texts(p: DataFrame) -> DataFrame:
    return lexicon.other_languages(p)[0]


@_over(PARSED)
def non_english_shown(p: DataFrame) -> DataFrame:
    return lexicon.other_languages(p)[1]


@_over("documents")
def example_filter(d: DataFrame) -> DataFrame:
    """(valid, sentences): the sentences of all documents that can be examples, and those that cannot."""
    s = d.select(F.explode(F.split("text", r"[.!?]+\s+|\n+")).alias("s")).where("s <> ''")
    return s.groupBy(text.valid_example(F.concat("s", F.lit("."))).alias("valid")).agg(F.count("*").alias("sentences"))


_add("synonym_filter", lexicon.synonyms, SYNONYM, PARSED)
_add("top_synonyms", lambda s: lexicon.top_synonyms(s, 3), SYNONYM)
_add("related_words", lexicon.related, PARSED)
_add("antonym_anti_join", lexicon.without_antonyms, PARSED)
_add("cross_references", lexicon.cross_references, PARSED, ENTRY)
_add("etymology_language", lexicon.etymologies, ENTRY)


@_over(SYNONYM, PARSED)
def synonym_anti_join(s: DataFrame, p: DataFrame) -> DataFrame:
    return lexicon.new_synonyms(lexicon.synonyms(s, p), s)


# Pronunciation and syllables.
@_over(PARSED)
def ipa_extract(p: DataFrame) -> DataFrame:
    x = p.select("dictionary_entry_parsed_id", F.explode(speech.ipa_of(F.when(F.col("definition").rlike("/[^/]+/"), F.col("definition")))).alias("x"))
    return x.select("dictionary_entry_parsed_id", "x.ipa", "x.locale").distinct()


@_over(PARSED)
def ipa_locale_counts(p: DataFrame) -> DataFrame:
    return ipa_extract(p).groupBy("locale").agg(F.count("*").alias("pronunciations"))


@_over(PARSED)
def ipa_syllables(p: DataFrame) -> DataFrame:
    x = ipa_extract(p).select("ipa", "locale").distinct().withColumn("s", speech.ipa_syllables(F.regexp_replace("ipa", "/", "")))
    return x.select("ipa", "locale", speech.render_ipa(F.col("s"), F.col("locale")).alias("rendered"), F.explode("s").alias("y")).select("ipa", "locale", "rendered", F.col("y.index").alias("syllable"), "y.text", "y.stress")


@_over(CANONICAL)
def orthographic_syllables(c: DataFrame) -> DataFrame:
    return c.select("canonical_word_id", F.posexplode(speech.spelling_syllables("normalized_word")).alias("i", "syllable")).select("canonical_word_id", (F.col("i") + 1).alias("syllable_index"), "syllable")


@_over(ENTRY, PARSED, CANONICAL)
def ipa_coverage(e: DataFrame, p: DataFrame, c: DataFrame) -> DataFrame:
    """How many canonical words have a pronunciation in some sense, by locale."""
    s = p.select("dictionary_entry_parsed_id", "dictionary_entry_id").distinct()
    w = e.select("dictionary_entry_id", "canonical_word_id").where("canonical_word_id IS NOT NULL").distinct()
    return verify.coverage(c, ipa_extract(p).join(s, "dictionary_entry_parsed_id").join(w, "dictionary_entry_id").select("locale", "canonical_word_id"))


# Keys, JSON, paging, samples.
@_over("part")
def sha256_keys(p: DataFrame) -> DataFrame:
    return p.select("p_partkey", F.upper(F.sha2("p_name", 256)).alias("name_hash"), F.upper(F.sha2(F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")), 256)).alias("key_hash"))


@_over("events")
def json_props(e: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return e.groupBy("event_type").agg(F.count(k).alias("with_k"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))


@_over("events")
def ai_notes_merge(e: DataFrame) -> DataFrame:
    """Each event's document with a list of notes in place of the one it had."""
    return e.select("event_id", ai.merged_notes(F.col("props"), F.array(F.col("event_type"))).alias("notes"))


@_over("orders")
def keyset_page(o: DataFrame) -> DataFrame:
    """One page of 50 after a key."""
    return o.where("o_orderkey > 100").orderBy("o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@_over("orders")
def offset_page(o: DataFrame) -> DataFrame:
    """The third page of 50 by price."""
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").offset(100).limit(50).select("o_orderkey", "o_totalprice")


_add("grammar_sample", verify.grammar_sample, PARSED)
_add("qa_summary", verify.summary, ENTRY, PARSED, SYNONYM, CANONICAL)

# The graph.
_add("graph_nodes", graph.build_nodes, CANONICAL, PARSED, LABEL)
_add("graph_edges", graph.build_edges, ENTRY, PARSED, LABEL)
_add("graph_validate", graph.validate, EDGE, NODE)
_add("graph_senses", lambda e: graph.neighbours(e, ("HAS_SENSE",), "Word"), EDGE)
_add("graph_sense_count", graph.sense_counts, EDGE, CANONICAL)
_add("graph_refs_out", lambda e: graph.neighbours(e, graph.REFERENCES, "Sense"), EDGE)
_add("graph_refs_in", lambda e: graph.neighbours(e, graph.REFERENCES, "Sense", reverse=True), EDGE)
_add("graph_words_of_concept", graph.words_of_concepts, EDGE, ENTRY, PARSED)
_add("graph_degrees", graph.degrees, EDGE)
_add("graph_concept_confidence", graph.concept_confidence, ENTRY, PARSED)
_add("graph_rank", lambda e: graph.page_rank(e).select("node_id", F.round(F.col("rank") + 1e-9, 6).alias("rank")), EDGE)


@_over(ENTRY, PARSED, LABEL, EDGE)
def graph_append(e: DataFrame, p: DataFrame, labels: DataFrame, g: DataFrame) -> DataFrame:
    """How many edges a run in append mode would add, by relation."""
    return graph.new_edges(graph.build_edges(e, p, labels), g).groupBy("relation_type").agg(F.count("*").alias("added"))


def _words(g: DataFrame) -> DataFrame:
    return g.where("from_node_id LIKE 'Word:%'").select(F.col("from_node_id").alias("node_id"))


_add("graph_walk", lambda g: graph.walk(g, _words(g), 3), EDGE)
_add("graph_reach", lambda g: graph.reach(g, _words(g), 3), EDGE)
_add("graph_shortest_path", lambda g: graph.shortest(g, _words(g), "Domain:", 4), EDGE)
_add("graph_components", lambda g: graph.components(graph.unique(g).where(F.col("relation_type").isin(*graph.REFERENCES)).select(F.col("from_node_id").alias("a"), F.col("to_node_id").alias("b"))), EDGE)

# Rewriting.
RULES = [
    rewrite.Rule(1, "especially", "esp.", priority=10), rewrite.Rule(2, "compare", "cf.", priority=10), rewrite.Rule(3, "a piece of", "some", priority=20), rewrite.Rule(4, "piece", "part", priority=20),
    rewrite.Rule(5, r"\bthe act of (\w+)", "act: $1", is_regex=True, priority=30), rewrite.Rule(6, "which", "that", priority=40, enabled=False), rewrite.Rule(7, "often", "mostly"), rewrite.Rule(8, "the", ""),
]
STOP_WORDS = ("the",)


@_over(PARSED)
def rewrite_map_apply(p: DataFrame) -> DataFrame:
    """The definitions that the rules change."""
    r = rewrite.rewritten(_definitions(p), "dictionary_entry_parsed_id", "definition", rewrite.ordered(RULES, STOP_WORDS))
    return r.select("dictionary_entry_parsed_id", "after", F.array_join("rules", ",").alias("rules"))


@_over(PARSED)
def rewrite_hits(p: DataFrame) -> DataFrame:
    return rewrite.hits(rewrite.rewritten(_definitions(p), "dictionary_entry_parsed_id", "definition", rewrite.ordered(RULES, STOP_WORDS)))


def _definitions(p: DataFrame) -> DataFrame:
    return spread(p.select("dictionary_entry_parsed_id", "definition"))


def _pairs(s: DataFrame) -> DataFrame:
    one = s.dropDuplicates(["dictionary_entry_synonym_id"])
    sure = F.when(F.col("has_non_english_text"), 0.55).when(F.col("synonym_text").contains(" "), 0.7).otherwise(0.9)
    return one.select("source_code", F.col("synonym_text").alias("from_text"), text.synonym_text(F.col("synonym_text")).alias("to_text"), sure.alias("confidence"))


@_over(SYNONYM)
def rewrite_candidates(s: DataFrame) -> DataFrame:
    return rewrite.candidates(_pairs(s))


@_over(SYNONYM, CANONICAL)
def rewrite_promote(s: DataFrame, c: DataFrame) -> DataFrame:
    """Candidates that become rules unless their text is a canonical word."""
    return rewrite.promoted(rewrite.candidates(_pairs(s)), c.select(F.col("normalized_word").alias("from_text")))


PATTERNS = rewrite.pattern_rules([
    {"id": "DASH", "pattern": r"\s--\s", "replacement": "—", "category": "PUNCTUATION"}, {"id": "ETC", "pattern": r"\betc\b(?!\.)", "replacement": "etc.", "category": "DICTIONARY_FORMAT", "languages": ["en"]},
    {"id": "DE", "pattern": "ss", "replacement": "ß", "category": "SPELLING", "languages": ["de"]}, {"id": "OFF", "pattern": "a", "enabled": False},
])


@_over(PARSED)
def rewrite_pipeline(p: DataFrame) -> DataFrame:
    """The definitions that the whole pipeline changes."""
    return rewrite.changed(_definitions(p), "dictionary_entry_parsed_id", "definition", rewrite.ordered(RULES, STOP_WORDS), PATTERNS).select("dictionary_entry_parsed_id", "after", "stable")


@_over(PARSED, SYNONYM)
def rewrite_job(p: DataFrame, s: DataFrame) -> DataFrame:
    """How many fields a run rewrites in senses that have no synonym yet; quoted sentences of a definition are its examples."""
    senses = spread(p.select("dictionary_entry_parsed_id", "definition", "meaning_title")).withColumn("examples", F.regexp_extract_all("definition", F.lit("“([^”]{10,})”"), 1))
    return rewrite.job(senses, s, rewrite.ordered(RULES, STOP_WORDS), PATTERNS).groupBy("field").agg(F.count("*").alias("rewritten"))


# Suggestions and merging of several results.
def _texts(p: DataFrame, mode: str, column: str) -> DataFrame:
    return p.where(F.col(column).isNotNull() & F.col("source_code").isNotNull()).select(F.col("dictionary_entry_parsed_id").alias("doc_id"), F.col(column).alias("text"), F.col("source_code").alias("source"), F.lit(mode).alias("mode")).dropDuplicates(["doc_id"])


def _queries(d: DataFrame) -> DataFrame:
    return d.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")


@_over(PARSED)
def suggestion_topk(p: DataFrame) -> DataFrame:
    """For the whole title of every fiftieth sense, the best definitions of its source that hold all of its words."""
    return suggest.search(_texts(p, "definition", "definition"), _queries(_texts(p, "definition", "meaning_title")))


@_over(PARSED)
def suggestion_whole(p: DataFrame) -> DataFrame:
    """For every fiftieth sense, the best definitions of its source that hold all words of its whole definition, and the best
    titles that hold all words of its whole title, each as a mode of its own. Senses without the text have no rows."""
    d = _texts(p, "definition", "definition").unionByName(_texts(p, "title", "meaning_title"))
    return suggest.search(d, _queries(d))


@_over(SYNONYM)
def suggestion_safe(s: DataFrame) -> DataFrame:
    return s.select("dictionary_entry_synonym_id", suggest.safe(F.col("synonym_text"), 80).alias("safe")).distinct()


@_over(SYNONYM)
def ai_consensus(s: DataFrame) -> DataFrame:
    """Of each sense's synonyms the longest, as a merge of several providers' answers by consensus would choose."""
    x = s.select(F.col("dictionary_entry_parsed_id").alias("item_id"), F.col("source_code").alias("provider"), F.col("dictionary_entry_synonym_id").alias("position"), F.col("synonym_text").alias("answer"))
    return ai.consensus(x)


@_over(SYNONYM)
def ai_first_success(s: DataFrame) -> DataFrame:
    x = s.select(F.col("dictionary_entry_parsed_id").alias("item_id"), F.col("dictionary_entry_synonym_id").alias("position"), F.col("synonym_text").alias("answer"))
    return ai.first_success(x)


@_over("documents")
def readability(d: DataFrame) -> DataFrame:
    """Flesch reading ease of each document from its words, sentences and vowel groups."""
    w, n = text.tokens(F.col("text")), F.col("w")
    x = d.where("text IS NOT NULL").select("doc_id", w.alias("w"), F.greatest(F.regexp_count("text", F.lit("[.!?]+")), F.lit(1)).alias("s")).where(F.size(n) > 0)
    syllables = F.aggregate(n, F.lit(0), lambda a, x: a + F.greatest(F.regexp_count(x, F.lit("[aeiouy]+")), F.lit(1)))
    return x.select("doc_id", F.size(n).alias("words"), F.col("s").alias("sentences"), F.round(206.835 - 1.015 * F.size(n) / F.col("s") - 84.6 * syllables / F.size(n), 3).alias("ease"))


@_over(PARSED)
def html_text(p: DataFrame) -> DataFrame:
    """Titles and fragments of senses put into HTML and read back as text."""
    from glossmill.functions.html import to_text

    x = p.select("dictionary_entry_parsed_id", F.concat(F.lit("<p><b>"), F.coalesce("meaning_title", F.lit("")), F.lit("</b> &amp; "), F.coalesce("alias", F.lit("")), F.lit("</p>")).alias("h")).distinct()
    return x.select("dictionary_entry_parsed_id", to_text("h").alias("value"))


# Display, audit and suggestion pairs.
@_over(PARSED)
def format_labels(p: DataFrame) -> DataFrame:
    return p.select("dictionary_entry_parsed_id", display.domain_label(F.col("domain")).alias("domain"), display.usage_label(F.col("usage_label")).alias("usage_label")).distinct()


_each("format_etymology", ENTRY, "dictionary_entry_id", "etymology", display.etymology)
_each("expand_abbreviations", ENTRY, "dictionary_entry_id", "part_of_speech", display.expanded)
_each("numbers_in_words", PARSED, "dictionary_entry_parsed_id", "definition", display.numbers_in_words)


@_over(PARSED)
def protect_tokens(p: DataFrame) -> DataFrame:
    """Definitions with their kept tokens taken out, changed to capitals and put back."""
    x = p.where("definition IS NOT NULL").select("dictionary_entry_parsed_id", "definition").distinct().withColumn("x", display.protected(F.col("definition")))
    return x.select("dictionary_entry_parsed_id", F.size("x.tokens").alias("tokens"), display.restored(F.upper("x.text"), F.col("x.tokens")).alias("value"))


@_over(PARSED, SYNONYM)
def enhancement_notes(p: DataFrame, s: DataFrame) -> DataFrame:
    """The rewritten senses that have no synonym yet, with an audit of the rules as JSON."""
    new = p.join(s.select("dictionary_entry_parsed_id").distinct(), "dictionary_entry_parsed_id", "left_anti")
    r = rewrite.rewritten(new, "dictionary_entry_parsed_id", "definition", rewrite.ordered(RULES, STOP_WORDS))
    return r.select("dictionary_entry_parsed_id", "after", F.to_json(F.struct(F.col("before").alias("original"), "rules")).alias("notes"))


@_over(PARSED)
def suggestion_pairs(p: DataFrame) -> DataFrame:
    """(source_code, mode, original, enhanced, hash): one row for each changed definition and title."""
    one = p.select("source_code", "definition", "meaning_title").distinct()
    pairs = F.array(*[F.struct(F.lit(m).alias("mode"), text.trim(F.col(c)).alias("original"), f(text.trim(F.col(c))).alias("enhanced")) for m, c, f in (("Definition", "definition", text.tidy_definition), ("MeaningTitle", "meaning_title", rewrite.title_case))])
    x = one.select("source_code", F.explode(pairs).alias("x")).select("source_code", "x.mode", "x.original", "x.enhanced")
    ok = ~text.blank(F.col("source_code")) & ~text.blank(F.col("original")) & ~text.blank(F.col("enhanced")) & (F.col("original") != F.col("enhanced"))
    return x.where(ok).withColumn("hash", F.upper(F.sha2("original", 256))).distinct()


@_over(PARSED)
def duplicate_senses(p: DataFrame) -> DataFrame:
    """(kept, dropped): senses whose definitions have the same words in any order; the first one stays."""
    words = F.array_join(F.array_sort(F.array_distinct(text.tokens(F.col("definition")))), " ")
    k = p.select("dictionary_entry_parsed_id", F.md5(words).alias("k")).where(words != "").distinct()
    g = k.groupBy("k").agg(F.min("dictionary_entry_parsed_id").alias("kept"), F.count("*").alias("senses")).where("senses > 1")
    return skew.attach(k, cut(g), ["k"], "senses").where("dictionary_entry_parsed_id <> kept").select("kept", F.col("dictionary_entry_parsed_id").alias("dropped"))


def _parts(c: str) -> Column:
    return F.filter(F.transform(F.split(c, "[;,] "), text.trim), lambda x: x != "")


@_over(PARSED)
def jaccard_dedupe(p: DataFrame) -> DataFrame:
    """Parts of a definition, and how many are left without those that share half their words with one before them."""
    x = p.where("definition IS NOT NULL").select("dictionary_entry_parsed_id", _parts("definition").alias("x")).distinct()
    return x.select("dictionary_entry_parsed_id", F.size("x").alias("parts"), F.size(text.unlike(F.col("x"), text.word_similarity, 0.5)).alias("kept")).where("parts > 1")


@_over(PARSED)
def fuzzy_dedupe(p: DataFrame) -> DataFrame:
    """The same by letters: parts that need few edits to be one before them are left out."""
    x = p.where("definition IS NOT NULL").select("dictionary_entry_parsed_id", _parts("definition").alias("x")).distinct()
    return x.select("dictionary_entry_parsed_id", F.size("x").alias("parts"), F.size(text.unlike(F.col("x"), text.letter_similarity, 60.0)).alias("kept")).where("kept < parts")


# The parse stage over entries made of senses: what each definition says beside its meaning.
def _said(p: DataFrame) -> DataFrame:
    """Senses as entries of a source, with a remark of one of several forms behind the definition."""
    i = F.col("dictionary_entry_parsed_id") % 7
    other = F.coalesce(F.nullif(F.regexp_extract("alias", r"([A-Za-z]+)", 1), F.lit("")), F.lit("thing"))
    remark = (
        F.when(i == 0, F.concat("meaning_title", F.lit(" means the same as "), other)).when(i == 1, F.concat(F.lit("A kind of thing, also called "), other)).when(i == 2, F.concat("definition", F.lit(". See also "), other))
        .when(i == 3, F.concat("meaning_title", F.lit(" is "), other)).when(i == 4, F.concat("definition", F.lit("\nOrigin: Old French "), other)).when(i == 5, F.concat(F.lit("Shown by “it is the way of "), other, F.lit("” and compare "), other))
        .otherwise(F.concat("meaning_title", F.lit(" or "), other, F.lit(", n. of two kinds")))
    )
    one = p.where("meaning_title IS NOT NULL AND definition IS NOT NULL").dropDuplicates(["dictionary_entry_parsed_id"])
    return one.select("dictionary_entry_parsed_id", F.col("dictionary_entry_parsed_id").alias("dictionary_entry_id"), F.col("meaning_title").alias("word"), remark.alias("definition"), F.col("raw_fragment"), "sense_number", "source_code", "domain", "alias")


@_over(PARSED)
def synonym_patterns(p: DataFrame) -> DataFrame:
    """(dictionary_entry_parsed_id, synonym, confidence, level): the surest phrase for each synonym."""
    return extract.synonyms(_said(p), "dictionary_entry_parsed_id", "word", "definition", "source_code")


@_over(PARSED)
def sense_references(p: DataFrame) -> DataFrame:
    x = _said(p).select("dictionary_entry_parsed_id", F.explode(extract.references(F.col("definition"))).alias("r"))
    return x.select("dictionary_entry_parsed_id", "r.target", "r.type").distinct()


@_over(PARSED)
def sense_examples(p: DataFrame) -> DataFrame:
    return _said(p).select("dictionary_entry_parsed_id", F.explode(extract.examples(F.col("definition"))).alias("example"))


@_over(PARSED)
def sense_origins(p: DataFrame) -> DataFrame:
    x = _said(p).select("dictionary_entry_parsed_id", extract.etymology(F.col("definition"), lexicon.LANGUAGES).alias("o")).where("o IS NOT NULL")
    return x.select("dictionary_entry_parsed_id", "o.etymology", "o.language_code", "o.rest")


@_over(PARSED)
def sense_domains(p: DataFrame) -> DataFrame:
    return p.select("dictionary_entry_parsed_id", extract.domain(F.col("source_code"), F.col("domain"), F.col("definition")).alias("value")).distinct()


@_over(PARSED)
def header_pos(p: DataFrame) -> DataFrame:
    return _said(p).select("dictionary_entry_parsed_id", extract.header_pos(F.col("definition")).alias("pos")).where("pos IS NOT NULL")


@_over(PARSED)
def parse_tables(p: DataFrame) -> DataFrame:
    """How many rows a parse run writes to each of its tables."""
    t = parse.parse(_said(p))
    out = None
    for name in ("senses", "aliases", "synonyms", "examples", "references", "etymologies", "other_languages"):
        one = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@_over(PARSED)
def parse_manifest(p: DataFrame) -> DataFrame:
    return parse.manifest(parse.parse(_said(p)))


_add("import_preprocess", lexicon.preprocessed, ENTRY)
_add("validate_sources", lexicon.validated_by_source, PARSED)
_add("source_counts", verify.source_counts, ENTRY, PARSED)
QUERIES["suggestion_candidates"] = lambda spark, d: suggest.candidates(QUERIES["suggestion_whole"](spark, d))


@_over(PARSED)
def grammar_chain(p: DataFrame) -> DataFrame:
    """Definitions that a chain of two correctors changes, and which of them did."""
    chain = [grammar.Corrector("scan", text.ocr_normalize, 90), grammar.Corrector("brackets", rewrite.balanced, 70), grammar.Corrector("none", lambda c: F.lit(""), 10)]
    return grammar.corrected(p, "dictionary_entry_parsed_id", "definition", chain).select("dictionary_entry_parsed_id", "after", F.array_join("engines", ",").alias("engines"), "confidence")


@_over(PARSED, CANONICAL)
def spell_split(p: DataFrame, c: DataFrame) -> DataFrame:
    """Titles joined to the first word of their definition, as scans do, parted again by the words of all definitions."""
    words = text.tokens(F.col("definition"))
    lexicon_ = p.where("definition IS NOT NULL").select(F.explode(words).alias("word")).unionByName(c.select(F.col("normalized_word").alias("word"))).where(F.length("word") > 3).distinct()
    joined = p.where("definition IS NOT NULL AND meaning_title IS NOT NULL").select(F.concat(F.regexp_replace(F.lower("meaning_title"), r"[^\p{L}\p{N}]", ""), F.coalesce(F.get(words, F.lit(0)), F.lit(""))).alias("token"))
    return grammar.splits(joined, lexicon_)


_each("cjk_strip", PARSED, "dictionary_entry_parsed_id", "definition", lambda c: text.without_cjk_marks(text.without_cjk(c)))
_each("domain_marker_strip", PARSED, "dictionary_entry_parsed_id", "alias", lambda c: text.without_domain_marker(F.concat(F.lit("(law) "), c)))
_each("headword_flags", ENTRY, "dictionary_entry_id", "word", text.is_headword)


@_over(CANONICAL)
def syllables_by_locale(c: DataFrame) -> DataFrame:
    """Canonical words with `ion` behind them, parted as in en-UK."""
    x = c.select("canonical_word_id", speech.spelling_syllables(F.concat("normalized_word", F.lit("tion"))).alias("s"))
    return x.select("canonical_word_id", F.element_at(speech.by_locale(F.col("s"), F.lit("en-UK")), -1).alias("last"), F.element_at(speech.by_locale(F.col("s"), F.lit("en-US")), -1).alias("last_us"))


@_over(ENTRY, CANONICAL)
def pronunciation_match(e: DataFrame, c: DataFrame) -> DataFrame:
    """(matched, words): words of a pronunciation table that are canonical words, compared without case, and those that aren't."""
    w = e.where("word IS NOT NULL").select(F.lower(text.trim(F.col("word"))).alias("word")).distinct()
    known = c.select(F.lower("normalized_word").alias("word"), F.lit(True).alias("known")).distinct()
    return w.join(known, "word", "left").groupBy(F.coalesce("known", F.lit(False)).alias("matched")).agg(F.count("*").alias("words"))


@_over(PARSED)
def senses_by_entry(p: DataFrame) -> DataFrame:
    """The first ten senses of each entry as one ordered list."""
    n = lexicon.running_senses(p).where("running <= 10")
    s = p.select("dictionary_entry_parsed_id", "dictionary_entry_id").distinct().join(n, "dictionary_entry_parsed_id")
    ordered = F.sort_array(F.collect_list(F.struct("running", "dictionary_entry_parsed_id")))
    return s.where("dictionary_entry_id IS NOT NULL").groupBy("dictionary_entry_id").agg(F.array_join(F.transform(ordered, lambda x: x["dictionary_entry_parsed_id"].cast("string")), ",").alias("senses"))


QUERIES["stream_canonical_words"] = incremental.canonical_words_once
