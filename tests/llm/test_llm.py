import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.llm import formatdup, labelmap, leakage, mixing, neardup, normalize, queries, reading

PARSED = "dictionary_entry_parsed_id long, definition string, domain string, usage_label string"


def parsed(spark, texts):
    return spark.createDataFrame([(i, t, None, None) for i, t in texts], PARSED).withColumn("id", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("form", F.lit(2))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("plain – “quoted” … é", "plain – “quoted” … é"), ("a​b­c﻿", "abc"), ("a b　c\td\n", "a b c\td\n"), ("ＡＢ１２，x", "AB12,x"), ("（油品）x", "（油品）x"), ("油，品。", "油，品。"),
        ("a，b", "a,b"), ("ﬁsh ﬆ", "fish st"), ("é", "é"), ("сat", "cat"), ("рaу", "pay"), ("А", "A"), ("соса", "coca"), ("(лбпфол)", "(лбпфол)"), ("/kɪɛʃθο/", "/kɪɛʃθο/"),
        ("лбпфoл", "лбпфол"), ("ｂο​οｋ", "book"), ("", ""), ("   ", "   "), ("е́", "é"), ("Ⅳ", "IV"), ("θο", "θο"),
    ],
)
def test_consistent(text, want):
    assert normalize.consistent(text) == want
    assert normalize.consistent(want) == want


def test_ordinary_pattern_never_hides_a_change():
    pattern = re.compile(normalize.SUSPICIOUS)
    free = normalize._SUSPICIOUS
    normalize._SUSPICIOUS = re.compile("")
    try:
        for o in itertools.chain(range(9, 0x250), range(0x2000, 0x2100), range(0x3000, 0x3100), range(0xFF00, 0xFFF0), range(0x370, 0x590)):
            if not pattern.search(chr(o)):
                assert normalize.consistent(f"a{chr(o)}b") == f"a{chr(o)}b", hex(o)
    finally:
        normalize._SUSPICIOUS = free


def test_suspicious_column_is_the_pattern(spark):
    chars = [chr(o) for o in itertools.chain(range(0x2100), range(0x3000, 0x3100), range(0x4DFF, 0x4E02), range(0xF900, 0x10000), range(0x1D400, 0x1D404)) if not 0xD800 <= o < 0xE000]
    rows = spark.createDataFrame([(f"a{c}b",) for c in chars] + [(f"é{c} – x",) for c in chars] + [("",), (None,)], "t string")
    for t, got in rows.select("t", normalize.suspicious_col(F.col("t"))).collect():
        assert got == (None if t is None else bool(normalize._SUSPICIOUS.search(t))), repr(t)


def test_p3_rows(spark):
    p = parsed(spark, [(1, "ok"), (2, "a​"), (2, "a​"), (3, None), (4, "")])
    s = spark.createDataFrame([(9, 1, "ﬁ", "S"), (8, 1, None, "S")], "dictionary_entry_synonym_id long, dictionary_entry_parsed_id long, synonym_text string, source_code string")
    assert {tuple(r) for r in normalize.found(p, s).collect()} == {("definition", 2), ("synonym_text", 9)}


def key(text):
    c = normalize.consistent(text)
    if re.match(r"(?i)\s*(gloss|usage|note|origin)\s*:", c):
        return ";" + ";".join(sorted(x for x in ("".join(normalize.words(q)) for q in re.split("[;|\r\n]", c)) if x))
    return "".join(normalize.words(text))


def test_copies_equal_brute_force(spark):
    rnd = random.Random(3)
    base = ["a red Oak", "gloss: a tree; note: big", "the big tree", "usage: rare|origin: Old", "oak", "-- !", "", "x" * 5000]
    dress = [str.upper, str.title, lambda t: f" “{t}”.", lambda t: t.replace(" ", "  "), lambda t: t.replace("a", "а"), lambda t: "; ".join(reversed(re.split("; ?", t))), lambda t: t]
    texts = [(i, rnd.choice(dress)(rnd.choice(base))) for i in range(200)] + [(300, None)]
    texts += texts[:10]
    syn = [(i, rnd.choice([1, 2]), rnd.choice(["b, a", "a b", "A  b.", "ab", "x", "", None, "b,, a"]), rnd.choice(["S", None])) for i in range(80)]
    s = spark.createDataFrame(syn, "dictionary_entry_synonym_id long, dictionary_entry_parsed_id long, synonym_text string, source_code string")
    groups = defaultdict(set)
    for i, t in texts:
        if t is not None and key(t).strip(";"):
            groups["definition", key(t)].add(i)
    for i, sense, t, source in syn:
        if t is not None:
            m = re.fullmatch(r"([^,]*),([^,]*)", t)
            w = "".join(normalize.words(f"{m[2]} {m[1]}" if m and normalize.words(m[1]) and normalize.words(m[2]) else t))
            if w:
                groups["synonym_text", (sense, source, w)].add(i)
    want = {(f, min(g), i) for (f, _), g in groups.items() for i in g if i != min(g)}
    p = parsed(spark, texts)
    got = [tuple(r) for r in formatdup.found(p, s).collect()]
    assert set(got) == want and len(got) == len(want)
    records = {(r.field, r.record_id): r.copies for r in formatdup.collapsed(p, s).collect()}
    assert records == {(f, min(g)): len(g) for (f, _), g in groups.items()}


def test_distance_is_a_metric_and_the_tree_finds_all():
    rnd = random.Random(1)
    ws = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 7))) for _ in range(60)]
    d = {(a, b): labelmap.distance(a, b, 20) for a in ws for b in ws}
    assert all(d[a, b] == d[b, a] and (d[a, b] == 0) == (a == b) for a, b in d)
    assert all(d[a, c] <= d[a, b] + d[b, c] for a, b, c in itertools.product(ws[:25], repeat=3))
    assert labelmap.distance("ca", "abc", 9) == 2 and labelmap.distance("abcd", "badc", 9) == 2
    tree = labelmap.BKTree(ws)
    for q in ws[:20] + ["aaaa", ""]:
        for most in (0, 1, 2, 3):
            assert sorted(tree.within(q, most)) == sorted({(x, w) for w in ws if (x := labelmap.distance(q, w, 20)) <= most})


@pytest.mark.parametrize("labels", [labelmap.TREE_LABELS, 2])
def test_labels(spark, monkeypatch, labels):
    monkeypatch.setattr(labelmap, "TREE_LABELS", labels)
    cat = spark.createDataFrame([(1, "domain", "Law"), (2, "domain", "General vocabulary"), (3, "domain", "Geology"), (4, "domain", "Ecology"), (5, "usage_label", "formal"), (6, "usage_label", "informal"), (None, "domain", "x"), (7, "language", "Latin")], "label_id int, label_kind string, canonical_label string")
    cases = {"Law": None, " ": None, None: None, "LAW.": 1, "laaw": 1, "lxxw": 0, "vocabulary, general": 2, "gen.": 2, "ge": 0, "(esp. geology)": 3, "esp. geology": 3, "geol": 3, "ecolgoy": 4, "eology": 3, "Latin": 0, "??": 0, "Ｇｅοlogy, etc.": 3}
    rows = spark.createDataFrame([(i, "x", v, None) for i, v in enumerate(cases)] + [(100, "x", None, "infromal"), (101, "x", None, "formla"), (102, "x", None, "in formal"), (103, "x", None, "informal."), (104, "x", None, "(formal)")], PARSED)
    # Words round three labels are dressing; a word round two is not.
    dressed = ["esp. law", "esp: ecology", "esp: law", "in law", "in geology", "in ecology", "generalvocabulary", "law, etc.", "Geology, etc", "ecology (etc.)", "near law", "near geology"]
    rows = rows.union(spark.createDataFrame([(200 + i, "x", v, None) for i, v in enumerate(dressed)], PARSED))
    cases |= {"esp. law": 1, "esp: ecology": 4, "esp: law": 1, "in law": 1, "in geology": 3, "in ecology": 4, "generalvocabulary": 2, "law, etc.": 1, "Geology, etc": 3, "ecology (etc.)": 4, "near law": 0, "near geology": 0}
    at = [*range(len(cases) - len(dressed)), *range(200, 200 + len(dressed))]
    got = {(r.field, r.dictionary_entry_parsed_id): r.label_id for r in labelmap.found(rows, cat).collect()}
    want = {("domain", i): v for i, v in zip(at, cases.values()) if v is not None} | {("usage_label", 100): 6, ("usage_label", 101): 5, ("usage_label", 102): 5, ("usage_label", 103): 6, ("usage_label", 104): 5}
    assert got == want
    assert {r.label_id for r in labelmap.found(rows, cat.limit(0)).collect()} == {0}


def test_shards_tell_what_one_tree_tells(spark, monkeypatch):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abio") for _ in range(rnd.randrange(2, 9)))
    labels = [(i, rnd.choice(["domain", "usage_label"]), w.title() if rnd.random() < 0.5 else w) for i, w in enumerate([word() for _ in range(40)] + ["biology", "biometry", "biopsy", "biotope", "Bi ology", "bio-logy"])]
    cat = spark.createDataFrame(labels, "label_id int, label_kind string, canonical_label string")
    values = ["bio", "biol", "biom", "biotop", *[rnd.choice([w, w[:4], f"esp {w}", w[1:], f"{w}, etc.", f"x{w}"]) for _, _, w in labels for _ in range(3)]]
    rows = spark.createDataFrame([(i, "x", v, rnd.choice(values)) for i, v in enumerate(values)], PARSED)
    got = {}
    for n in (1000, 6, 3, 999):
        monkeypatch.setattr(labelmap, "TREE_LABELS", n)
        monkeypatch.setattr(labelmap, "small", lambda df, n=n: n == 1000)
        got[n] = sorted(tuple(r) for r in labelmap.found(rows, cat).collect())
    assert got[1000] == got[999] == got[6] == got[3] and sum(r[2] > 0 for r in got[3]) > 50


def edited(rnd, vocabulary, n):
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(6, 20))] for _ in range(n)]
    out = []
    for w in base:
        out.append(w)
        for _ in range(rnd.randrange(3)):
            v = list(w)
            for _ in range(rnd.randrange(1, 4)):
                v[rnd.randrange(len(v))] = rnd.choice(vocabulary)
            rnd.shuffle(v)
            out.append(v)
    return [" ".join(w) for w in out]


def pairs_by_force(rows, threshold=neardup.THRESHOLD):
    sets = {i: (set(normalize.words(t)), key(t)) for i, t in rows if t is not None and normalize.words(t)}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a][1] != sets[b][1] and len(sets[a][0] & sets[b][0]) / len(sets[a][0] | sets[b][0]) >= threshold}


@pytest.mark.parametrize(("bucket", "block"), [(512, 2048), (2, 3)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, bucket, block):
    rnd = random.Random(bucket)
    template = ["the plural form of the noun called " + w for w in (f"w{i}" for i in range(40))]
    texts = edited(rnd, [f"v{i}" for i in range(300)] + ["of", "the"], 60) + template + ["", "--", None, "word", "word!", "a b", "b a", "x " * 3000]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    monkeypatch.setattr(neardup, "BLOCK", block)
    want = pairs_by_force(rows)
    got = [tuple(r) for r in neardup.found(parsed(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want
    assert len(want - set(got)) <= 0.005 * len(want)
    assert len(want) > 500


@pytest.mark.parametrize("round", ["one word", "two words", "blocks"])
def test_splitting_a_bucket_loses_no_pair(spark, round):
    """All sets in one bucket: each way of splitting it finds every similar pair by itself."""
    rnd = random.Random(9)
    sets = {i: sorted(rnd.sample(range(30), rnd.randrange(1, 14)) if i % 3 else rnd.sample(range(12), rnd.randrange(1, 12))) for i in range(250)}
    for threshold in (0.7, 0.5):
        want = {(a, b) for a, b in itertools.combinations(sets, 2) if len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b])) >= threshold and sets[a] != sets[b]}
        s = spark.createDataFrame(list(sets.items()), "set_id long, words array<long>")
        hot = s.withColumn("key", F.lit(7).cast("long"))
        made = neardup.blocked(hot.select("key", "set_id"), s, 20) if round == "blocks" else neardup.prefixed(hot, {w: 30 - w for w in range(8)}, 1 if round == "one word" else 2, threshold)
        got = {(r.a, r.b) for r in neardup.run_pairs(made, None, threshold).collect()}
        assert len(want) > 50 and want <= got
        assert len(got) < 250 * 249 / 2


def test_links_count_similar_groups(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "A b, c d e f g h i j!"), (3, "a b c d e f g h i k"), (4, "b a c d e f g h i j"), (5, "x y"), (6, None), (7, "-")]
    got = {r.dictionary_entry_parsed_id: (r.class_id, r.links) for r in neardup.links(parsed(spark, rows)).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 2), 4: (4, 2), 5: (5, 0)}
    assert {r.dictionary_entry_parsed_id: (r.group_id, r.members) for r in neardup.groups(parsed(spark, rows)).collect()} == {i: (1, 4) for i in (1, 2, 3, 4)}


def test_signatures_never_part_similar_sets():
    rnd = np.random.default_rng(2)
    for _ in range(300):
        n = int(rnd.integers(1, 40))
        x = rnd.integers(0, 2**62, n + 20)
        m = int(rnd.integers(0, 8))
        a, b = x[:n], x[m : n + int(rnd.integers(0, 8))]
        if len(b) and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.7:
            g = neardup.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
            assert neardup.may_be_similar(g[:1], g[1:], 0.7).all()


def test_sketches_fill_and_estimate_similarity():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 2**63, 90).astype(np.uint64)
    sets = [x[:60], x[20:80], x[:1], x[60:]]
    s = neardup.sketch(np.concatenate(sets), np.repeat(np.arange(4), [len(a) for a in sets]), 4, 800)
    assert (s != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.08 and (s[0] == s[3]).mean() < 0.01


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(7)
    v = [f"w{i}" for i in range(50)]
    items = [(i, "s", " ".join(rnd.choice(v) for _ in range(rnd.choice([5, 12, 30])))) for i in range(20)] + [(50, "s", None), (51, None, "")]
    docs = []
    for d in range(150):
        t = [rnd.choice(v + ["q"]) for _ in range(rnd.randrange(40))]
        w = rnd.choice(items[:20])[2].split()
        at, n = rnd.randrange(max(1, len(w) - 3)), rnd.randrange(3, 20)
        part = w[at : at + n]
        if rnd.random() < 0.3 and len(part) > 6:
            part[5] = "zz"
        t[5:5] = part
        docs.append((d, rnd.choice([" ", ", ", "\n​ "]).join(t).replace("w", rnd.choice("wWｗ"))))
    docs += [(900, None), (901, ""), (902, "w1 " * 20000)]
    grams = defaultdict(set)
    for i, _, t in items:
        w = normalize.words(t or "")
        for k in range(len(w) - 11):
            grams[tuple(w[k : k + 12])].add(i)
    want = {(d, i) for d, t in docs if t for w in [normalize.words(t)] for k in range(len(w) - 11) for i in grams.get(tuple(w[k : k + 12]), ())}
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(3)).withColumn("run", F.lit(3))
    i = spark.createDataFrame(items, "item_id long, suite string, item_text string")
    assert len(want) > 10
    got = [tuple(r) for r in leakage.found(d, i).collect()]
    assert set(got) == want and len(got) == len(want)
    assert leakage.found(d, i.limit(0)).count() == 0 and leakage.found(d.limit(0), i).count() == 0
    assert leakage.leaked(d, i).count() == len(items)
    block, leakage.BLOCK = leakage.BLOCK, 40
    try:
        assert {tuple(r) for r in leakage.found(d, i).collect()} == want
    finally:
        leakage.BLOCK = block


def test_substitutions_are_tolerated(spark):
    w = [f"a{i}" for i in range(24)]
    t = list(w)
    t[3] = "zz"
    t[15] = "zz"
    d = spark.createDataFrame([(1, " ".join(t))], "doc_id long, text string")
    i = spark.createDataFrame([(1, "s", " ".join(w))], "item_id long, suite string, item_text string")
    r = leakage.overlaps(d, i).first()
    assert (r.run, r.matches, r.substitutions) == (11, 22, 2)


def best_by_force(same):
    """(score, -begin, end) of the best stretch that never falls below 0 or too far below its peak, and begins anew after that."""
    best, begin = (0, 0, 0), 0
    while begin < len(same):
        score = peak = 0
        for n in range(begin, len(same)):
            score += 1 if same[n] else -1
            if score < 0 or score < peak - leakage.DROP:
                break
            peak = max(peak, score)
            if same[n] and score == peak:
                best = max(best, (score, -begin, n + 1))
        else:
            break
        begin = n + 1
    return best


def test_best_overlap_of_several_on_a_diagonal():
    def overlap(same):
        index = leakage.Index([(1, [f"a{k}" for k in range(len(same))])])
        return index.overlap(np.where(same, np.arange(len(same)), -1), 0, len(same), 0, 0)[:3]

    first = [1] * 10 + [0] + [1] * 10
    for rest, want in [([], (10, 20, 1)), ([0] * 5 + [1] * 10, (10, 20, 1)), ([0] * 5 + [1] * 30, (30, 30, 0)), ([0] * 5 + [1] * 11 + [0] + [1] * 11, (11, 22, 1)), ([0] * 3 + [1] * 10, (10, 30, 4))]:
        assert overlap(first + rest) == want
    rnd = random.Random(3)
    for _ in range(2000):
        same = [x for _ in range(rnd.randrange(1, 8)) for x in [1] * rnd.randrange(15) + [0] * rnd.randrange(7)]
        if same:
            _, matches, substitutions = overlap(same)
            score, begin, end = best_by_force(same)
            assert (matches, substitutions) == (sum(same[-begin:end]), end + begin - sum(same[-begin:end]))


def test_overlap_before_another_is_not_lost(spark):
    w = [f"a{i}" for i in range(36)]
    t = [x if k not in (10, 21, 22, 23, 24, 25) else "zz" for k, x in enumerate(w)]
    d = spark.createDataFrame([(1, " ".join(t))], "doc_id long, text string")
    i = spark.createDataFrame([(1, "s", " ".join(w))], "item_id long, suite string, item_text string")
    assert [tuple(r) for r in leakage.overlaps(d, i).collect()] == [(1, 1, 10, 20, 1)]
    assert [tuple(r) for r in leakage.leaked(d, i).collect()] == [(1, "s", 0, 1)]


@pytest.mark.parametrize(("words", "rate", "least"), [(16, 0.1, 0.93), (24, 0.1, 0.95), (40, 0.1, 0.95), (16, 0.2, 0.85), (24, 0.2, 0.75), (40, 0.2, 0.75), (60, "sixth", 1.0)])
def test_recall_of_substituted_overlaps(words, rate, least):
    """Random overlaps of at least SPAN equal words without a run of SPAN, each within other words on both sides."""
    rnd = random.Random(words)
    found = 0
    for _ in range(300):
        while True:
            same = [k % 6 != 5 for k in range(words)] if rate == "sixth" else [rnd.random() >= rate for _ in range(words)]
            if sum(same) >= leakage.SPAN and "1" * leakage.SPAN not in "".join(map(str, map(int, same))):
                break
        item = [f"i{k}" for k in range(words + 40)]
        index = leakage.Index([(9, item)])
        text = ["x"] * 30 + [w if x else "y" for w, x in zip(item[20:], same)] + ["x"] * 30
        flat = np.array([index.vocabulary.get(w, -1) for w in text])
        rows = [index.overlap(flat, 0, len(flat), i, diagonal) for _, i, diagonal in index.hits(flat, np.zeros(len(flat), np.int64))]
        found += any(leakage.counts(*r) for r in rows)
    assert found >= least * 300


def test_templates_are_no_leaks(spark):
    """Sentences with the same words but for their slots overlap, but only a passage with its own words has leaked."""
    text = lambda k: f"teachers often say n{k} before the a{k} since the first is b{k} and the second is c{k} in all of them"
    items = spark.createDataFrame([(k, "s", text(k)) for k in range(30)], "item_id long, suite string, item_text string")
    docs = spark.createDataFrame([(1, text(99)), (2, text(7).replace("since", "as").replace("often", "now"))], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r.substitutions) for r in leakage.overlaps(docs, items).collect()] == [(2, 7, 2)]


def test_hits_of_a_template_in_all_items_come_in_steps(spark, monkeypatch):
    monkeypatch.setattr(leakage, "STEP", 50)
    common = " ".join(f"t{k}" for k in range(15))
    items = spark.createDataFrame([(i, "s", f"{common} own{i}") for i in range(40)], "item_id long, suite string, item_text string")
    docs = spark.createDataFrame([(d, f"begin {common} {common} end{d}") for d in range(5)] + [(9, "t1 t2")], "doc_id long, text string")
    assert {tuple(r) for r in leakage.found(docs, items).collect()} == {(d, i) for d in range(5) for i in range(40)}


def test_mix_meets_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 2_000_000))
    targets = spark.createDataFrame([("entry_articles", 0.5, 1), ("usage_notes", 0.3, 2), ("nowhere", 0.2, 2)], "source string, target_share double, max_repeats int")
    mix = mixing.mixed(docs, targets).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    assert all(source[r.doc_id] == r.source and 1 <= r.repeats <= (1 if r.source == "entry_articles" else 2) for r in mix)
    assert len({r.doc_id for r in mix}) == len(mix)
    total = Counter()
    for r in mix:
        total[r.source] += r.tokens * r.repeats
    assert abs(total["entry_articles"] / sum(total.values()) - 0.625) < 0.005
    shares = {r.source: r for r in mixing.shares(docs, targets).collect()}
    assert shares["nowhere"].share == 0 and abs(sum(r.share for r in shares.values()) - 1) < 1e-9
    assert mixing.mixed(docs.limit(0), targets).count() == 0 and mixing.mixed(docs, targets.limit(0)).count() == 0


def test_fit_reaches_domains_and_labels(spark):
    """Documents that are labelled a but read like b count for b: the rates of both make up for it."""
    rows = [("a", [16, 0], 1000), ("a", [4, 12], 500), ("b", [0, 16], 1000), ("b", [8, 8], 100)]
    classes = spark.createDataFrame(rows, "source string, member array<int>, tokens long")
    listed = [("a", 0.5, 3), ("b", 0.5, 2)]
    rates, target, expected = mixing.fitted(classes, listed)
    assert np.allclose(target, [2200, 2200]) and np.allclose(expected, 2200, rtol=0.25) and np.allclose(expected[2:], 2200, rtol=0.1)
    got = {(r.source, tuple(r.member)): r.rate for r in rates.collect()}
    assert all(0 <= x <= (3 if s == "a" else 2) for (s, _), x in got.items()) and got["a", (16, 0)] > got["a", (4, 12)]


def test_fit_on_the_driver_and_by_jobs_is_the_same(spark, monkeypatch):
    rnd = random.Random(2)
    classes = spark.createDataFrame([(s, [m, 16 - m], rnd.randrange(1, 1000)) for s in "ab" for m in range(17)], "source string, member array<int>, tokens long")
    monkeypatch.setattr(mixing, "ITERATIONS", 8)
    got = []
    for here in (True, False):
        monkeypatch.setattr(mixing, "small", lambda df, here=here: here)
        rates, target, expected = mixing.fitted(classes, [("a", 0.3, 2), ("b", 0.7, 3)])
        got.append((sorted((r.source, r.member, round(r.rate, 9)) for r in rates.collect()), np.round(target, 6).tolist(), np.round(expected, 6).tolist()))
    assert got[0] == got[1]


def test_too_many_sources_are_an_error(spark, sf, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 3)
    with pytest.raises(ValueError, match="3 sources"):
        mixing.mixed(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/mix_target.parquet"))


def test_tokens_are_those_of_the_tokenizer(spark, sf):
    enc = mixing.encoder(mixing._ranks(mixing.TOKENIZER))
    assert enc.decode(enc.encode_ordinary("Naïve <|endoftext|> ok\n\n")) == "Naïve <|endoftext|> ok\n\n"


def test_reading_levels_agree_with_held_out_readers(spark):
    big = "/root/testdata/sf0.01"
    docs, ratings = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/doc_rating.parquet")
    got = reading.levels(docs, ratings)
    held = reading.rated(got, ratings).where("NOT learned").toPandas()
    assert held[["level", "grade_band"]].rank().corr().iloc[0, 1] > 0.8
    assert got.count() == docs.where("text IS NOT NULL").count() == got.select("doc_id").distinct().count()
    assert got.where("level IS NULL OR band NOT BETWEEN 1 AND 5").count() == 0


def test_reading_levels_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "一二三"), (4, "a " * 50000), (5, "?!")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string")).withColumn("level", F.lit("x")).withColumn("source", F.lit("s"))
    none = spark.createDataFrame([], "doc_id long, rater_id int, grade_band int")
    got = {r.doc_id: r for r in reading.levels(docs, none).collect()}
    assert sorted(got) == [2, 3, 4, 5] and all(-4.1 <= r.level <= 4.1 for r in got.values())
    assert reading.levels(docs.limit(0), none).count() == 0


def read(spark, texts):
    return reading._read(spark.createDataFrame(texts, "doc_id long, text string"), reading.Languages(["en"], np.zeros((1, reading.BYTES))))


@pytest.mark.parametrize("broadcast", [True, False])
def test_rare_words_count_for_the_level(spark, monkeypatch, broadcast):
    """Documents alike in their common words and surface, of which some hold rare words of long-worded documents."""
    monkeypatch.setattr(reading, "small", lambda df, n: broadcast)
    docs, items = reading.encoded(read(spark, [(k, f"the cat sat on {w} mat") for k, w in enumerate(["a", "a", "zyx", "zyx", "wvu"] + ["a"] * 20)]))
    got = {r.doc_id: sorted(r["items"]) for r in docs.collect()}
    assert got[0] == [0, 1, 2, 3, 4, 5] and got[2] == got[3] and got[2][-1] == 7 and got[4][-1] == 6 and len(got) == 25 and len(items.own) == 6
    none = spark.createDataFrame([], "doc_id long, rater_id int, grade_band int")
    plain = [(k, "the cat sat on the mat", "en") for k in range(60)]
    hard = [(100 + k, f"the cat sat on extraordinarily{k} incomprehensible{k} mat", "en") for k in range(60)]
    same = [(200, "the cat sat on qqq rrr mat", None), (201, "the cat sat on the the mat", "en")]
    level = {r.doc_id: r.level for r in reading.levels(spark.createDataFrame(plain + hard + same, "doc_id long, text string, lang string"), none).collect()}
    assert level[200] > level[201]


def test_languages_have_levels_of_their_own(spark):
    rnd = random.Random(6)
    easy, hard = "the cat sat on a mat and the dog ran to it".split(), "epistemological considerations notwithstanding contemporary lexicographers systematically differentiate".split()
    leicht, schwer = "der hund lief zu der katze und sie sah ihn".split(), "erkenntnistheoretische auseinandersetzungen rechtfertigen wissenschaftliche begriffsbestimmungen gewissermaßen".split()
    rows = []
    for k in range(400):
        share, german = rnd.random(), k % 4 == 0
        ws = [rnd.choice((schwer if german else hard) if rnd.random() < share else (leicht if german else easy)) for _ in range(40)]
        rows.append((k, " ".join(ws) + ".", rnd.choice(["DE ", "de", "de", None, "en"]) if german else rnd.choice(["en", "en", "EN", "de"]), share))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, share double")
    got = reading.levels(docs, spark.createDataFrame([], "doc_id long, rater_id int, grade_band int")).join(docs.select("doc_id", "share"), "doc_id").toPandas()
    assert set(got.language) == {"de", "en"} and ((got.doc_id % 4 == 0) == (got.language == "de")).all()
    for _, part in got.groupby("language"):
        assert part.level.rank().corr(part.share.rank()) > 0.9 and set(part.band) == {1, 2, 3, 4, 5} and abs(part.level.mean()) < 0.3


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_has_rows(spark, sf, name):
    """Those that no SQL is compared with."""
    assert queries.QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_over_empty_tables(spark, sf, tmp_path_factory, name):
    at = tmp_path_factory.getbasetemp() / "empty_llm"
    if not at.exists():
        import glob
        import os

        for f in glob.glob(f"{sf}/*.parquet"):
            spark.read.parquet(f).limit(0).coalesce(1).write.parquet(str(at / os.path.basename(f)))
    assert queries.QUERIES[name](spark, str(at)).collect() == []


def test_sql_gives_the_same(spark, sf):
    from compare import both, connection

    con = connection(sf)
    for name, sql in queries.ORACLES.items():
        got, want = both(spark, sf, queries.QUERIES[name], sql, con)
        assert got == want, name
