import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from glossmill.operators import ai, extract, grammar, graph, lexicon, parse, references, rewrite, skew, suggest


def test_attach_equals_join_for_heavy_and_light_keys(spark, monkeypatch):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else ("hot" if i % 3 else f"k{i % 11}")) for i in range(300)], "id int, k string")
    agg = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("lo"))
    want = {(r.id, r.k, r.lo) for r in skew._join(rows, agg, ["k"]).collect()}
    for heavy, keys, whole in ((10, 1000, 0), (5, 0, 0), (10_000, 1000, 0), (10, 1000, 1000)):
        monkeypatch.setattr(skew, "HEAVY_KEYS", keys)
        monkeypatch.setattr(skew, "ATTACH_ROWS", whole)
        got = skew.attach(rows, agg, ["k"], "n", heavy)
        assert {(r.id, r.k, r.lo) for r in got.collect()} == want
        assert got.count() == 300


@pytest.mark.parametrize("heavy", [5, 100_000])
def test_orphans_equal_brute_force(spark, heavy):
    rnd = random.Random(heavy)
    t0 = dt.datetime(2024, 1, 1)
    when = lambda: t0 + dt.timedelta(days=rnd.randrange(200), seconds=rnd.randrange(3))
    name = lambda: rnd.choice(["Sense:1", "Sense:1", "Sense:1", "Sense:12", "Word:2", "word:2", "Word:3 ", "Domain:1", "Domain:01", "Domain:9", "Language:1", "x", "", None])
    edges = [(i, name(), name(), rnd.choice(["SEE", "see", None]), rnd.choice([when(), when(), None])) for i in range(400)]
    edges += edges[:20]
    nodes = [(name(), rnd.choice([when(), when(), None]), rnd.choice([None, when(), when()])) for _ in range(60)]
    labels = [(1, "domain", "A"), (1, "usage_label", "B"), (2, "language", None)]
    e = spark.createDataFrame(edges, "edge_id long, from_node_id string, to_node_id string, relation_type string, created_utc timestamp_ntz").withColumn("ref", F.lit(1)).withColumn("n", F.lit(2))
    n = spark.createDataFrame(nodes, "node_id string, created_utc timestamp_ntz, deleted_utc timestamp_ntz").withColumn("until", F.lit("x"))
    r = spark.createDataFrame([("SEE",)], "relation_type string")
    lab = spark.createDataFrame(labels, "label_id int, label_kind string, canonical_label string")

    def resolved(v, t):
        import re

        if re.fullmatch(r"(Domain|Language):[0-9]+", v):
            return v in {"Domain:1", "Language:2"}
        return t is not None and any(k == v and c is not None and c <= t and (d is None or d > t) for k, c, d in nodes)

    want = {(i, f) for i, a, b, _, t in edges for f, v in (("from_node_id", a), ("to_node_id", b)) if v is not None and not resolved(v, t)}
    want |= {(i, "relation_type") for i, _, _, x, _ in edges if x is not None and x != "SEE"}
    got = [tuple(x) for x in references.broken(e, n, r, lab, heavy).select("edge_id", "ref_field").collect()]
    assert set(got) == want and len(got) == len(want)


def test_walks_do_not_confuse_prefixes_and_stop_at_cycles(spark):
    e = spark.createDataFrame([("Sense:1", "Sense:12", "SEE"), ("Sense:12", "Sense:1", "SEE"), ("Sense:12", "Sense:2", "SEE"), ("Sense:2", "Sense:2", "SEE"), (None, "Sense:2", "SEE")], "from_node_id string, to_node_id string, relation_type string")
    starts = spark.createDataFrame([("Sense:1",)], "node_id string")
    got = {(r.to_node_id, r.depth, r.path) for r in graph.walk(e, starts, 4).collect()}
    assert got == {("Sense:12", 1, "Sense:1>Sense:12"), ("Sense:2", 2, "Sense:1>Sense:12>Sense:2")}
    assert {(r.node_id, r.depth) for r in graph.reach(e, starts, 4).collect()} == {("Sense:12", 1), ("Sense:2", 2), ("Sense:1", 2)}


def test_components_equal_union_find(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100 + rnd.randrange(60), 100 + rnd.randrange(60)) for _ in range(40)] + [(7, 7), (500, 400)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_rules_fold_in_order_and_count(spark):
    rules = rewrite.ordered([rewrite.Rule(1, "cat", "dog", priority=5), rewrite.Rule(2, "dog", "cow", priority=9), rewrite.Rule(3, "a.b", "x$1", whole_word=False), rewrite.Rule(4, "stop", "go"), rewrite.Rule(5, "off", "on", enabled=False), rewrite.Rule(6, "all of it", "")], ("STOP",))
    assert [r.id for r in rules] == [1, 2, 6, 3]
    df = spark.createDataFrame([(1, " Cat cats a.b axb stop "), (2, None), (3, "  "), (4, "all of it"), (5, "off")], "id int, t string")
    got = {r.id: (r.after, list(r.rules)) for r in rewrite.rewritten(df, "id", "t", rules).collect()}
    assert got == {1: ("cow cats x$1 axb stop", [1, 2, 3])}
    assert {r.rule_id: r.hits for r in rewrite.hits(rewrite.rewritten(df, "id", "t", rules)).collect()} == {1: 1, 2: 1, 3: 1}


def test_fold_ends_after_so_many_changes_not_so_many_rules(spark, monkeypatch):
    monkeypatch.setattr(rewrite, "MAX_RULES", 3)
    rules = [rewrite.Rule(i, f"w{i}", f"x{i}") for i in range(40)]
    assert len(rewrite.ordered(rules)) == 40
    df = spark.createDataFrame([(1, "w30 w31 w32 w33"), (2, "w39"), (3, "none")], "id int, t string")
    got = {r.id: list(r.rules) for r in rewrite.rewritten(df, "id", "t", rewrite.ordered(rules)).collect()}
    assert got == {1: [30, 31, 32], 2: [39]}


def test_pattern_rules_are_ranked():
    rules = rewrite.pattern_rules([
        {"id": "c", "pattern": "x", "category": "cleanup"}, {"id": "b", "pattern": "y", "category": "spelling", "priority": 5}, {"id": "a", "pattern": "z", "category": "spelling", "priority": 5, "confidence": 0.9},
        {"id": "o", "pattern": "q"}, {"id": "off", "pattern": "r", "enabled": False}, {"id": "", "pattern": "s"}, {"id": "n", "pattern": None}, None, {"id": "d", "pattern": "d", "languages": ["de"]},
        {"id": "x1", "pattern": "same", "enabled": False, "confidence": 1.0, "category": "style"}, {"id": "x2", "pattern": "same", "category": "style"}, {"id": "e", "pattern": "e", "languages": ["en"], "category": "grammar"},
    ])
    assert [r.id for r in rewrite.ranked(rules, "en-US")] == ["a", "b", "e", "x2", "c", "o"]
    assert [r.id for r in rewrite.by_merit(rules)][:2] == ["a", "b"] and rewrite.by_merit(rules)[-1].enabled is False


def test_repairs(spark):
    one = lambda f, x: spark.createDataFrame([(x,)], "t string").select(f(F.col("t"))).first()[0]
    assert one(rewrite.balanced, "a (b") == "a (b)" and one(rewrite.balanced, "a b)") == "a b" and one(rewrite.balanced, "a ((b") == "a ((b"
    assert one(rewrite.balanced, 'say "x') == 'say "x"' and one(rewrite.balanced, None) is None
    assert one(rewrite.abbreviations, "adj, fig") == "adj., fig." and one(rewrite.abbreviations, "adjective") == "adjective" and one(rewrite.abbreviations, "(n)") == "(n.)"
    assert one(rewrite.punctuation, "a ,b . See x.y@z.com , 1 . 5 and  U.S.A. now") == "a, b. See x.y@z.com, 1.5 and U.S.A. now"
    for x, want in {"": "", " a ": "a", "12 : 30": "12:30", "£ 5 or 6 %": "£5 or 6%", "3 x 10 ^ 4": "3×10^4", "1 / 2 / 1999": "1/2/1999", "and / or": "and/or", "it 's": "it's", "Why????!": "Why!?", "wow!!!!!": "wow!!!", "a.....b": "a...b", "a – b": "a—b", "( x ) [ y ]": "(x) [y]", "dog’s": "dog's", "end.Next": "end.Next", "go!Now": "go! Now", "a;b": "a; b", "see ISBN 978-3-16-148410-0 , ok": "see ISBN 978-3-16-148410-0, ok"}.items():
        assert one(rewrite.punctuation, x) == want, x
    assert one(rewrite.punctuation, None) is None
    assert one(rewrite.title_case, "the LIFE of-a McDonald of x2") == "The Life Of-A McDonald of x2" and one(rewrite.title_case, "x" * 3000) == "X" + "x" * 2999
    assert one(rewrite.title_case, "the house of the cat") == "The House of the Cat"


def test_pipeline_keeps_tokens_and_tells_what_is_stable(spark):
    rows = [(1, "see  a cat@cat.com , the cat"), (2, None), (3, "  "), (4, "fine."), (5, "adj , iPhone cat")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {r.id: (r.after, r.stable) for r in rewrite.changed(df, "id", "t", rewrite.ordered([rewrite.Rule(1, "cat", "dog"), rewrite.Rule(2, "iphone", "phone")]), rewrite.pattern_rules([{"id": "a", "pattern": r"\ba\b", "replacement": "one"}])).collect()}
    assert got == {1: ("see one cat@cat.com, the dog", True), 5: ("adj, iPhone dog", True)}
    senses = spark.createDataFrame([(1, "a cat", "the CAT of x", ["cat !", "no"]), (2, "cat", None, None), (3, None, None, [])], "dictionary_entry_parsed_id long, definition string, meaning_title string, examples array<string>")
    done = rewrite.job(senses, senses.where("dictionary_entry_parsed_id = 2"), rewrite.ordered([rewrite.Rule(1, "cat", "dog")])).collect()
    assert {(r.field, r.after) for r in done} == {("Definition", "a dog"), ("MeaningTitle", "The Dog of X"), ("Example", "dog!")} and all(r.before in r.notes for r in done)


def test_search_needs_all_terms_and_ranks(spark):
    d = spark.createDataFrame([(1, "red fox runs"), (2, "red fox"), (3, "red dog"), (4, None), (5, ""), (6, "fox red red")], "doc_id long, text string")
    q = spark.createDataFrame([(100, "red fox"), (101, "blue"), (102, None)], "query_id long, text string")
    got = [(r.query_id, r["rank"], r.doc_id) for r in suggest.search(d, q, 2, 0.0).orderBy("query_id", "rank").collect()]
    assert [g[0] for g in got] == [100, 100] and {g[2] for g in got} <= {1, 2, 6}
    assert suggest.search(d.limit(0), q).count() == 0


def test_answers(spark):
    a = spark.createDataFrame([(1, 1, None), (1, 2, "ab"), (1, 3, "abc"), (1, 4, "xyz"), (2, 1, " ")], "item_id int, position int, answer string")
    assert [tuple(r) for r in ai.consensus(a).collect()] == [(1, "abc")]
    assert [tuple(r) for r in ai.first_success(a).collect()] == [(1, "ab")]
    t = spark.createDataFrame([("x", None)], "a string, b string").select(ai.filled("<{{a}}|{{b}}|{{c}}>", {"a": F.col("a"), "b": F.col("b")}))
    assert t.first()[0] == "<x||>"


def test_merge_is_idempotent(spark, sf):
    e = spark.read.parquet(f"{sf}/dictionary_entry.parquet")
    once = lexicon.merged(e)
    assert lexicon.merge_into(e, once).count() == 0
    assert once.select("source_code", "normalized_word", "sense_number").distinct().count() == once.count()


def test_orphans_of_empty_tables(spark, sf):
    e, n, r, lab = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("graph_edge", "graph_node", "graph_relation", "label_catalog"))
    assert references.found(e.limit(0), n, r, lab).count() == 0
    known = e.select(F.explode(F.array(*[F.col(f) for f in references.FIELDS])).alias("v")).where("v IS NOT NULL").count()
    assert 0 < references.broken(e, n.limit(0), r.limit(0), lab.limit(0)).count() <= known


def test_phrases_tell_synonyms_by_source(spark):
    rows = [
        (1, "Oak", "oak means tree.", "ENG_OXFORD"), (2, "oak", "Oak means the same as tree", "ENG_COLLINS"), (3, "oak", "an elm or oak, also called quercus, known as it, see also ash", "ENG_COLLINS"), (4, "oak", "oak is tree", "OTHER"), (5, "oak", "oak is oak", "OTHER"),
        (6, "big", "big is small", "OTHER"), (7, "go", "If you go away, you leave it.", "ENG_CHN"), (8, "run", "running is racing", "ENG_CHN"), (9, "running", "Running is racing.", "ENG_CHN"), (10, None, "oak is tree", "OTHER"), (11, "oak", None, "OTHER"), (12, "oak", "similar to 橡 elm", "ENG_CHN"), (13, "oak", "elm is oak", None),
    ]
    df = spark.createDataFrame(rows, "id int, w string, d string, s string").withColumn("h", F.lit("clash"))
    got = {(r.id, r.synonym, r.level) for r in extract.synonyms(df, "id", "w", "d", "s").collect()}
    assert got == {(1, "tree", "high"), (2, "tree", "high"), (3, "elm", "medium"), (3, "quercus", "medium"), (3, "it", "medium"), (3, "ash", "low"), (4, "tree", "medium"), (7, "leave", "high"), (9, "racing", "high"), (12, "elm", "low"), (13, "elm", "medium")}


def test_parse_writes_its_tables(spark):
    rows = [(1, "oak", "oak means tree", None, 1, "ENG_OXFORD", "law", "Acorn"), (1, "oak", "A tree. “It is the way of trees.” See ash", None, 2, "ENG_OXFORD", None, None), (1, "oak", "Another. “it is the way of trees” Origin: Old French x", None, 3, "ENG_OXFORD", None, None), (2, "дуб", "дерево", None, None, "GUT_WEBSTER", None, None), (3, None, None, None, None, None, None, None)]
    e = spark.createDataFrame(rows, "dictionary_entry_id long, word string, definition string, raw_fragment string, sense_number int, source_code string, domain string, alias string")
    t = parse.parse(e)
    senses = {(r.dictionary_entry_id, r.sense_number): r.definition for r in t.senses.collect()}
    assert senses == {(1, 1): "Oak means tree.", (1, 2): 'A tree. "It is the way of trees." See ash.', (1, 3): 'Another. "it is the way of trees" Origin: Old French x.', (2, 1): "[NON_ENGLISH_DEFINITION]", (3, 1): ""}
    assert [(r.sense_number, r.example) for r in t.examples.collect()] == [(2, "“It is the way of trees.”")]
    assert [(r.target, r.type) for r in t.references.collect()] == [("ash", "see")] and [r.synonym for r in t.synonyms.collect()] == ["tree"] and [r.alias for r in t.aliases.collect()] == ["Acorn"]
    assert [r.language_code for r in t.etymologies.collect()] == ["fro"] and [r.text for r in t.other_languages.collect()] == ["дерево"]
    assert parse.insert_or_get(t.senses, t.senses).count() == 0 and parse.insert_or_get(t.senses.union(t.senses), t.senses.limit(0)).count() == 5


def test_shortest_paths_and_merged_concepts(spark):
    e = spark.createDataFrame([("A", "B", "r"), ("A", "C", "r"), ("B", "T:1", "r"), ("C", "T:1", "r"), ("T:1", "T:2", "r"), ("A", "D", "r"), ("D", "A", "r"), (None, "A", "r")], "from_node_id string, to_node_id string, relation_type string")
    s = spark.createDataFrame([("A",)], "node_id string")
    assert [tuple(r) for r in graph.shortest(e, s, "T:", 5).collect()] == [("A", "T:1", 2, "A>B>T:1")]
    b = spark.createDataFrame([("Sense:1", "Concept:1", "BELONGS_TO"), ("Sense:2", "Concept:2", "BELONGS_TO"), ("Sense:3", "Concept:3", "BELONGS_TO")], "from_node_id string, to_node_id string, relation_type string")
    same = spark.createDataFrame([("Concept:2", "Concept:1")], "a string, b string")
    assert {(r.from_node_id, r.to_node_id) for r in graph.merged_concepts(b, same).collect()} == {("Sense:1", "Concept:1"), ("Sense:2", "Concept:1"), ("Sense:3", "Concept:3")}


def test_a_chain_tells_who_changed_what(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, " "), (4, "b")], "id int, t string")
    chain = [grammar.Corrector("x", lambda c: F.replace(c, F.lit("a"), F.lit("c")), 90), grammar.Corrector("y", lambda c: F.replace(c, F.lit("c"), F.lit("d")), 50), grammar.Corrector("blank", lambda c: F.lit(" "))]
    assert [tuple(r) for r in grammar.corrected(df, "id", "t", chain).collect()] == [(1, "a", "d", ["x", "y"], 70)]
    assert [r.engines for r in grammar.corrected(df, "id", "t", chain, off=("y",)).collect()] == [["x"]] and grammar.corrected(df, "id", "t", chain, enabled=False).count() == 0
    words = spark.createDataFrame([("there",), ("fore",), ("the",), ("refore",), ("Known",), (None,)], "word string")
    tokens = spark.createDataFrame([("Therefore",), ("known",), ("theory",), ("fore",), (None,)], "token string")
    assert [tuple(r) for r in grammar.splits(tokens, words).collect()] == [("therefore", "the refore")]
    assert ai.chosen(["a", "b", "a", "c"], "c") == ["c", "a", "b"] and ai.chosen(["a"], "x", 0) == []
    assert ai.chunked(spark.range(100), "id", 10).groupBy("chunk").count().count() == 10


def _shuffled(spark):
    """Records written to shuffles by each stage so far."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    stages = sc._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return {s.stageId(): s.shuffleWriteRecords() for s in (stages.apply(i) for i in range(stages.size()))}


def test_search_follows_the_rarest_term_only(spark):
    """2,000 texts of 20 words, each word in 40 texts, and a word of its own: the postings of the 20 words stay where they are."""
    d = spark.range(2000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 19), i -> concat('w', i, 'x', pmod(hash(id, i), 50))), concat('own', id)) AS text")
    before = _shuffled(spark)
    got = suggest.search(d, d.withColumnRenamed("doc_id", "query_id").where("query_id % 50 = 0")).count()
    assert got == 0 and sum(n for s, n in _shuffled(spark).items() if s not in before) < 10 * 2000


def test_suggestion_candidates_shuffle_in_proportion(spark, tmp_path):
    """1,000 definitions of 20 words, each word in 20 of them: the query shuffles some rows for each text, not its words."""
    from glossmill.plans.catalogue import QUERIES

    words = "concat_ws(' ', transform(sequence(0, 19), i -> concat('w', i, 'x', pmod(hash(id, i), 50))), concat('own', id DIV 100 * 2))"
    p = spark.range(1000).selectExpr("id AS dictionary_entry_parsed_id", f"IF(id % 100 = 50, NULL, {words}) AS definition", "concat('titles', id DIV 100) AS meaning_title", "'S' AS source_code")
    p.write.parquet(str(tmp_path / "dictionary_entry_parsed.parquet"))
    before = _shuffled(spark)
    got = [(r["mode"], r.query_id, r.doc_id, r.confidence) for r in QUERIES["suggestion_candidates"](spark, str(tmp_path)).collect()]
    assert len(got) == 60 and all(m == "title" and q // 100 == d // 100 and c == 0.9 for m, q, d, c in got)
    assert sum(n for s, n in _shuffled(spark).items() if s not in before) < 10 * 2000


@pytest.mark.parametrize("broadcast", [True, False])
def test_search_finds_what_every_pair_compared_finds(spark, monkeypatch, broadcast):
    """Texts of few words, many of them equal or equal but for their order: all ranks, with and without broadcasts."""
    if not broadcast:
        monkeypatch.setattr(suggest, "small", lambda df: False)
        monkeypatch.setattr(suggest, "maybe_broadcast", lambda df: df)
    r = random.Random(7)
    docs = [(i, s, " ".join(r.choices("abcdef", weights=[9, 6, 3, 2, 1, 1], k=r.randint(1, 4)))) for i in range(120) for s in ("S", "T")] + [(500, None, "a b"), (501, "S", " - "), (502, "S", None)]
    asked = [(i, s, t) for i, s, t in docs if i % 3 == 0] + [(900, "S", "a unknown"), (901, "S", "B a"), (902, "S", ""), (903, "U", "a")]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string")
    q = spark.createDataFrame(asked, "query_id long, source string, text string")
    got = sorted((x.query_id, x["rank"], x.doc_id, x.score, x.preview) for x in suggest.search(d, q, 3, 0.3).collect())
    want = []
    for qid, source, text_ in asked:
        words = {i: t.split() for i, s, t in docs if s == source and source and t and t.strip(" -")}
        need = sorted(set((text_ or "").strip(" -").lower().split()))
        if not need or not words:
            continue
        n, mean, scored = len(words), sum(map(len, words.values())) / len(words), []
        df = {t: sum(t in w for w in words.values()) for t in need}
        for i, w in words.items():
            if i != qid and set(need) <= set(w):
                idf = lambda t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                scored.append((-round(sum(idf(t) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in need), 6), i))
        texts = {i: t for i, s, t in docs if s == source}
        want += [(qid, k, i, -x, texts[i]) for k, (x, i) in enumerate(sorted(y for y in scored if -y[0] >= 0.3)[:3], 1)]
    assert [x[:3] + x[4:] for x in got] == [x[:3] + x[4:] for x in sorted(want)] and len(want) > 200
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, sorted(want), strict=True))
