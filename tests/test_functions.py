import pytest
from pyspark.sql import functions as F

from glossmill.functions import display, language, speech, text


def value(spark, f, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("f", "x", "want"),
    [
        (text.normalize_word, "  Café—Noir_x★ ", "cafe-noir x"), (text.normalize_word, None, ""), (text.normalize_word, "", ""),
        (text.sanitize_word, "Don't-Stop 2", "don t stop"), (text.sanitize_word, " 橡树 ", "橡树"), (text.sanitize_word, None, ""),
        (text.normalize_pos, " Vt. ", "verb"), (text.normalize_pos, "odd.", "odd"), (text.normalize_pos, None, "unk"), (text.normalize_pos, "  ", "unk"),
        (text.synonym_text, " “big  oak”. ", "big oak"), (text.synonym_text, "橡", ""), (text.synonym_text, "[NON_ENGLISH]", ""), (text.synonym_text, "a" * 90, "a" * 80),
        (text.example_sentence, " \"it is  so!!\" ", "It is so."), (text.example_sentence, None, ""), (text.valid_example, "It is an oak.", True), (text.valid_example, "See oak now is.", False), (text.valid_example, None, False),
        (text.reference_target, "[[Oak|Tree]], ", "oak tree"), (text.reference_target, "12", ""), (text.etymology_text, "ab", ""), (text.mode_code, "Legal", "Legal"), (text.mode_code, "legal", "English"),
        (text.clean_definition, "/ək/ n. a  tree", "a tree"), (text.ocr_normalize, "a ,b(  c )\r\n d", "a, b(c) d"), (text.ocr_normalize, None, None),
        (text.tidy_definition, "n. a tree (big) ; oak", "A tree ; oak."), (text.senses, "1. a\n2. b;C", ["a", "b", "C"]), (text.senses, None, []),
        (language.primary_language, "橡树", "zh"), (language.primary_language, "oak 橡", "bilingual"), (language.primary_language, "oak", "en"), (language.primary_language, "/oak/", "ipa"), (language.primary_language, None, "unknown"), (language.primary_language, "ねこ", "ja"), (language.primary_language, "123", "unknown"),
        (language.contains_non_english, "дуб", True), (language.contains_non_english, "oak é", False), (language.contains_non_english, None, False),
        (speech.normalize_ipa, "[[a:b]]", "aːb"), (speech.normalize_ipa, "a", ""), (speech.with_stress, "/ɑbɪ/", "/ˈɑbɪ/"), (speech.with_stress, "/ɑb/", "/ɑb/"), (speech.locale_of_ipa, "kɑːr", "en-UK"), (speech.locale_of_ipa, "bɝd", "en-US"),
    ],
)
def test_value(spark, f, x, want):
    assert value(spark, f, x) == want


def test_syllables(spark):
    assert speech.split_spelling("nation") == ["na", "tion"] and speech.split_spelling("window") == ["win", "dow"]
    assert speech.split_spelling("mother-in") == ["moth", "er", "in"] and speech.split_spelling("father's") == ["fa", "ther's"] and speech.split_spelling("about") == ["about"]
    assert speech.split_spelling("") == [] and speech.split_spelling("cat") == ["cat"] and "".join(speech.split_spelling("extraordinary")) == "extraordinary"
    assert speech.split_ipa("ˈwɪndoʊ") and "".join(t for _, t, _ in speech.split_ipa("ˈwɪndəʊ")) == "wɪndəʊ"
    assert speech.split_ipa("") == []
    assert value(spark, speech.ipa_syllables, None) == [] and value(spark, speech.spelling_syllables, "window") == ["win", "dow"]


def test_priority_and_headword(spark):
    r = spark.createDataFrame([(60, 0.95), (0, -1.0)], "n int, c double").select(text.rule_priority(F.col("n"), F.col("c"))).collect()
    assert [x[0] for x in r] == [440, 500]
    d = spark.createDataFrame([("Oak a tree", "oak"), ("Oakwood", "oak"), ("x", None)], "d string, h string").select(text.clean_definition(F.col("d"), F.col("h"))).collect()
    assert [x[0] for x in d][:2] == ["a tree", "Oakwood"]


def test_display(spark):
    assert value(spark, display.roman, "MCMXCIV") == 1994 and value(spark, display.roman, "IIX") is None and value(spark, display.roman, None) is None
    assert value(spark, display.expanded, "esp. a fig. use, viz.") == "especially a figurative use, namely"
    assert value(spark, display.numbers_in_words, "2 of 12, not 3.5 or 20") == "two of twelve, not 3.5 or 20"
    assert value(spark, display.etymology, "[ from x ]") == "from x" and value(spark, display.domain_label, " lAW ") == "Law"
    assert value(spark, display.example, "it is so") == "“It is so.”"
    p = spark.createDataFrame([("see a@b.co or 5kg iPhone x",)], "t string").select(display.protected(F.col("t")).alias("p"))
    r = p.select("p.text", "p.tokens", display.restored(F.upper("p.text"), F.col("p.tokens")).alias("back")).first()
    assert r.text == "see ⟦PT000001⟧ or ⟦PT000002⟧ ⟦PT000003⟧ x" and r.back == "SEE a@b.co OR 5kg iPhone X"


def test_small_functions(spark):
    assert value(spark, text.confidence_percent, 0.125, "double") == 13 and value(spark, text.confidence_percent, None, "double") == 0
    assert value(spark, text.ai_confidence, 0, "int") == 80 and value(spark, text.ai_confidence, 120, "int") == 100 and value(spark, text.ai_confidence, None, "int") == 80
    assert value(spark, text.notes_title, '{"title": " x "}') == "x" and value(spark, text.notes_title, "no") is None
    assert value(spark, text.notes_examples, '{"examples": ["a", " ", null, "b"]}') == ["a", "b"] and value(spark, text.notes_examples, None) == []
    assert value(spark, text.without_domain_marker, "【law】 [x] oak") == "[x] oak" and value(spark, text.without_cjk, "oak 橡树") == "oak" and value(spark, text.without_cjk_marks, "（oak）。") == "oak"
    assert value(spark, text.is_headword, " OAK-1 ") and not value(spark, text.is_headword, "Oak") and not value(spark, text.is_headword, None) and not value(spark, text.is_headword, "123")
    assert value(spark, lambda c: text.unlike(F.split(c, ";"), text.word_similarity, 0.5), "a b;A B;c;a b c;d e") == ["a b", "c", "d e"]
    assert value(spark, lambda c: text.unlike(F.split(c, ";"), text.letter_similarity, 85), "colour;color;cooler;") == ["colour", "cooler", ""]
    assert value(spark, lambda c: speech.by_locale(F.split(c, ";"), F.lit("en-UK")), "na;tion;ion") == ["na", "t", "ion", "ion"]
