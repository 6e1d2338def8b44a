import json

import pytest

from glossmill.sources import lines, readers


def _read(spark, tmp_path, code, name, content):
    f = tmp_path / name
    f.write_text(content, encoding="utf8")
    return sorted(readers.read(spark, code, str(f)).collect(), key=lambda r: (r.headword, r.sense_number))


def test_kaikki(spark, tmp_path):
    a = {"word": "oak", "pos": "noun", "lang": "English", "lang_code": "en", "senses": [{"glosses": ["A {{x|y}} [[tree|big tree]]."], "examples": [{"text": " An oak. "}], "synonyms": [{"word": "tree"}]}, {"raw_glosses": ["Its '''wood'''."]}, {"glosses": ["A big tree."]}, {}], "etymology_text": "From [[Old English]]."}
    b = {"word": "Eiche", "lang": "German", "lang_code": "de", "senses": [{"glosses": ["oak"]}]}
    r = _read(spark, tmp_path, "KAIKKI", "k.jsonl", "\n".join([json.dumps(a), "", json.dumps(b), "{broken"]))
    assert [(x.headword, x.sense_number, x.definition) for x in r] == [("oak", 1, "A big tree."), ("oak", 2, "Its wood.")]
    assert r[0].examples == ["An oak."] and r[0].synonyms == ["tree"] and r[0].etymology == "From Old English."
    assert readers.rejected(spark, str(tmp_path / "k.jsonl")).first().rejected == 1


def test_structured(spark, tmp_path):
    m = {"oak": {"original_cased_word": "Oak", "definitions": [{"part_of_speech": "n.", "definition": "tree", "sequence": 0}, {"part_of_speech": "v", "definition": " ", "sequence": 2}]}, "x": None}
    r = _read(spark, tmp_path, "STRUCT_JSON", "s.json", json.dumps(m, indent=1))
    assert [(x.headword, x.part_of_speech, x.sense_number, x.definition) for x in r] == [("Oak", "noun", 1, "tree")]


def test_bilingual_lines(spark, tmp_path):
    r = _read(spark, tmp_path, "ENG_CHN", "e.txt", "oak ⬄ /əʊk/ n. 橡树 a tree 〔医〕 [<OE ac]\n24/7 ⬄ adv. always\n!bad ⬄ x\nplain word here\n\n")
    got = {x.headword: x for x in r}
    assert set(got) == {"oak", "24/7", "plain"}
    assert got["oak"].definition == "a tree" and got["oak"].domain == "medicine" and got["oak"].etymology == "OE ac" and got["oak"].pronunciation == "/əʊk/" and got["oak"].part_of_speech == "noun"


WEBSTER = """*** START OF THIS EBOOK ***
Title: x

ABACK
A*back", adv. Etym: [Pref. a- + back; AS. on bæc at the back.]

1. Toward the back; backward. (Naut.) "They drew aback." Chaucer.
2. Behind and also in the rear
Syn. -- behind, rearward.


loose text that belongs nowhere
OAK
Oak, n.

Defn: A tree of the genus Quercus, of many species.
"""


def test_headword_blocks(spark, tmp_path):
    r = _read(spark, tmp_path, "GUT_WEBSTER", "w.txt", WEBSTER)
    assert [(x.headword, x.sense_number, x.part_of_speech) for x in r] == [("Aback", 1, "adv"), ("Aback", 2, "adv"), ("Oak", 1, "noun")]
    assert r[1].definition == "Behind and also in the rear." and r[0].synonyms == ["behind", "rearward"] and r[0].domain == "naut"
    assert r[2].definition.startswith("A tree of the genus")


COLLINS = """——————————————
oak ★★☆
1.N-COUNT An oak is a large tree. 橡树
• The oak grew tall. 橡树长高了
【语域标签】：BRIT
2.ADJ Oak furniture is made of oak.
→see: acorn
---------------
elm
1.N-VAR An elm is a tree.
"""


def test_separated_blocks(spark, tmp_path):
    r = _read(spark, tmp_path, "ENG_COLLINS", "c.txt", COLLINS)
    assert [(x.headword, x.sense_number, x.part_of_speech) for x in r] == [("elm", 1, "noun"), ("oak", 1, "noun"), ("oak", 2, "adj")]
    assert r[1].definition == "An oak is a large tree." and r[1].examples == ["The oak grew tall."] and r[1].domain == "BRIT" and r[2].see_also == ["acorn"]


OXFORD = """oak /əʊk/
▶ noun
1 [botany] a large tree. • 橡树 » the oak fell.
2 (mass noun) the wood of the oak
【Etymology】 Old English āc.
ash
▶ verb
1 turn to ash
"""


def test_sectioned_blocks(spark, tmp_path):
    r = _read(spark, tmp_path, "ENG_OXFORD", "o.txt", OXFORD)
    assert [(x.headword, x.sense_number, x.part_of_speech, x.definition) for x in r] == [("ash", 1, "verb", "turn to ash"), ("oak", 1, "noun", "a large tree."), ("oak", 2, "noun", "the wood of the oak")]
    assert r[1].domain == "botany" and r[1].examples == ["the oak fell."] and r[1].etymology == "Old English āc." and r[1].pronunciation == "/əʊk/"


def test_html(spark, tmp_path):
    h = '<html><body><div class="word_block"><b class="headword">oak</b><i class="phonetics">/ək/</i><span class="pos">n.</span><div class="definition">a <em>tree</em></div><p class="example">An oak &amp; elm.</p></div><div class="word_block"><b class="headword">elm</b><br></div><div class="word_block">none</div></body></html>'
    r = _read(spark, tmp_path, "CENTURY21", "c.html", h)
    assert [(x.headword, x.definition) for x in r] == [("elm", "Definition for elm"), ("oak", "a tree")]
    assert r[1].examples == ["An oak & elm."] and readers.html_text("<p>a&amp;b<script>x</script> c</p>") == "a&b c" and readers.html_text(None) is None


def test_pronunciations(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("Oak\t/əʊk/, /oʊk/\nnone\n\t/x/\n", encoding="utf8")
    assert [tuple(r) for r in readers.read_pronunciations(spark, str(tmp_path / "p.tsv"), "en-UK").collect()] == [("oak", "əʊk", "en-UK")]


def test_blocks_across_splits_of_a_file(spark, tmp_path):
    from pyspark.sql import functions as F

    n = 3000
    (tmp_path / "l.txt").write_text("".join(f"# {i}\n" + f"body {i}\n" * (i % 4) for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        numbered = lines.lines(spark, str(tmp_path / "l.txt"))
        assert numbered.select("split").distinct().count() > 3
        got = {r["lines"][0]: r["lines"][1:] for r in lines.blocks(numbered, F.col("line").startswith("#")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"# {i}": [f"body {i}"] * (i % 4) for i in range(n)}


def test_unknown_source_and_partitioned_write(spark, tmp_path):
    with pytest.raises(KeyError):
        readers.read(spark, "NONE", str(tmp_path))
    (tmp_path / "e.txt").write_text("oak ⬄ tree\n", encoding="utf8")
    df = readers.read(spark, "ENG_CHN", str(tmp_path / "e.txt"), most=5)
    for _ in range(2):
        readers.write(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
