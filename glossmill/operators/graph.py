"""The semantic graph: building nodes and edges, checking them, and walking them.

Edges are (from_node_id, to_node_id, relation_type). Null endpoints are never matched. Repeated edges count once.
Walks go by frontiers: each hop is one join, and each frontier is written before the next, so plans stay short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.operators import extract
from glossmill.session import cut, maybe_broadcast

# The relations of the graph.
RELATIONS = ("HAS_SENSE", "SUB_SENSE_OF", "IN_DOMAIN", "DERIVED_FROM", "SEE", "RELATED_TO", "COMPARE", "BELONGS_TO")
REFERENCES = ("SEE", "RELATED_TO", "COMPARE")


def node(kind: str, key: Column) -> Column:
    """The id of a node."""
    return F.concat(F.lit(f"{kind}:"), key.cast("string"))


def unique(edges: DataFrame) -> DataFrame:
    return edges.select("from_node_id", "to_node_id", "relation_type").where("from_node_id IS NOT NULL AND to_node_id IS NOT NULL").distinct()


def build_nodes(words: DataFrame, parsed: DataFrame, labels: DataFrame) -> DataFrame:
    """(node_id, node_type): words, senses, one concept a sense, and the domains and languages of the catalogue."""
    sense = parsed.where("dictionary_entry_parsed_id IS NOT NULL").select(F.col("dictionary_entry_parsed_id").alias("i")).distinct()
    parts = [
        words.where("canonical_word_id IS NOT NULL").select(node("Word", F.col("canonical_word_id")).alias("node_id"), F.lit("Word").alias("node_type")),
        sense.select(node("Sense", F.col("i")), F.lit("Sense")),
        sense.select(node("Concept", F.col("i")), F.lit("Concept")),
        labels.where("label_kind IN ('domain', 'language')").select(F.concat(F.initcap("label_kind"), F.lit(":"), F.col("label_id").cast("string")), F.initcap("label_kind")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def build_edges(entries: DataFrame, parsed: DataFrame, labels: DataFrame) -> DataFrame:
    """(from_node_id, to_node_id, relation_type) of words, senses, their parents, concepts, domains, languages and references.

    A domain is linked when its name is written exactly as in the catalogue.
    """
    entry = entries.where("canonical_word_id IS NOT NULL").select("dictionary_entry_id", "canonical_word_id").distinct()
    sense = parsed.select("dictionary_entry_parsed_id", "dictionary_entry_id", "parent_parsed_id", "domain").where("dictionary_entry_parsed_id IS NOT NULL").distinct()
    me = node("Sense", F.col("dictionary_entry_parsed_id"))
    domains = maybe_broadcast(labels.where("label_kind = 'domain'").select("label_id", F.col("canonical_label").alias("domain")))
    named = lambda a, b, r: (a.alias("from_node_id"), b.alias("to_node_id"), F.lit(r).alias("relation_type"))
    parts = [
        sense.join(entry, "dictionary_entry_id").select(*named(node("Word", F.col("canonical_word_id")), me, "HAS_SENSE")),
        sense.where("parent_parsed_id IS NOT NULL").select(*named(me, node("Sense", F.col("parent_parsed_id")), "SUB_SENSE_OF")),
        sense.select(*named(me, node("Concept", F.col("dictionary_entry_parsed_id")), "BELONGS_TO")),
        sense.join(domains, "domain").select(*named(me, node("Domain", F.col("label_id")), "IN_DOMAIN")),
        origin_edges(entries, labels),
        reference_edges(parsed, entries),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def reference_edges(parsed: DataFrame, entries: DataFrame) -> DataFrame:
    """(from_node_id, to_node_id, relation_type): SEE, RELATED_TO and COMPARE from each sense to all senses of the word that
    its definition refers to."""
    r = parsed.select("dictionary_entry_parsed_id", F.explode(extract.references(F.col("definition"))).alias("r"))
    r = r.select(F.col("dictionary_entry_parsed_id").alias("s"), F.col("r.target").alias("word"), text.literals(extract.RELATION)[F.col("r.type")].alias("relation_type")).distinct()
    e = entries.select("dictionary_entry_id", F.lower("normalized_word").alias("word")).where("word IS NOT NULL").distinct()
    p = parsed.select("dictionary_entry_id", F.col("dictionary_entry_parsed_id").alias("t")).distinct()
    return r.join(e, "word").join(p, "dictionary_entry_id").where("s <> t").select(node("Sense", F.col("s")).alias("from_node_id"), node("Sense", F.col("t")).alias("to_node_id"), "relation_type").distinct()


def origin_edges(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """(from_node_id, to_node_id, relation_type): DERIVED_FROM from each canonical word to the languages of the catalogue that
    its etymologies name."""
    names = maybe_broadcast(labels.where("label_kind = 'language' AND canonical_label IS NOT NULL").select("label_id", F.lower("canonical_label").alias("name")))
    # Each run of words of an etymology is looked up among the names, so the tables meet by a key.
    w = entries.where("canonical_word_id IS NOT NULL AND etymology IS NOT NULL").select("canonical_word_id", text.tokens(F.col("etymology")).alias("w")).distinct()
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, F.lit(2)), " "))
    said = w.select("canonical_word_id", F.explode(F.array_distinct(F.concat("w", pairs))).alias("name"))
    return said.join(names, "name").select(node("Word", F.col("canonical_word_id")).alias("from_node_id"), node("Language", F.col("label_id")).alias("to_node_id"), F.lit("DERIVED_FROM").alias("relation_type")).distinct()


def merged_concepts(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(from_node_id, to_node_id, relation_type): BELONGS_TO edges with each concept replaced by the first of those that
    pairs (a, b) of concepts say are the same."""
    e = unique(edges).where("relation_type = 'BELONGS_TO'")
    one = components(pairs).select(F.col("id").alias("to_node_id"), "component")
    return e.join(one, "to_node_id", "left").select("from_node_id", F.coalesce("component", "to_node_id").alias("to_node_id"), "relation_type").distinct()


def new_edges(built: DataFrame, existing: DataFrame) -> DataFrame:
    """The edges that an append run adds: those that do not exist yet."""
    keys = ["from_node_id", "to_node_id", "relation_type"]
    return built.select(*keys).distinct().join(existing.select(*keys).distinct(), keys, "left_anti")


def validate(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(check_name, failures): self loops, edges to unknown nodes, unknown relations, hierarchies that aren't of senses."""
    e = unique(edges)
    known = nodes.where("node_id IS NOT NULL").select(F.col("node_id")).distinct()
    orphan = lambda c: e.join(known, F.col(c) == F.col("node_id"), "left_anti")
    checks = {
        "self_loop": e.where("from_node_id = to_node_id"),
        "orphan_from": orphan("from_node_id"),
        "orphan_to": orphan("to_node_id"),
        "unknown_relation": e.where(F.col("relation_type").isNull() | ~F.col("relation_type").isin(*RELATIONS)),
        "broken_hierarchy": e.where("relation_type = 'SUB_SENSE_OF' AND NOT (from_node_id LIKE 'Sense:%' AND to_node_id LIKE 'Sense:%')"),
    }
    out = None
    for name, df in checks.items():
        one = df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        out = one if out is None else out.union(one)
    return out


def neighbours(edges: DataFrame, relations: tuple[str, ...], kind: str, reverse: bool = False) -> DataFrame:
    """(node_id, other_id, relation_type): what nodes of a kind refer to, or with reverse, what refers to them."""
    me, other = ("to_node_id", "from_node_id") if reverse else ("from_node_id", "to_node_id")
    found = unique(edges).where(F.col("relation_type").isin(*relations) & F.col(me).startswith(f"{kind}:"))
    return found.select(F.col(me).alias("node_id"), F.col(other).alias("other_id"), "relation_type")


def sense_counts(edges: DataFrame, words: DataFrame) -> DataFrame:
    """(canonical_word_id, senses, has_sense) for every canonical word, with or without senses."""
    n = neighbours(edges, ("HAS_SENSE",), "Word").groupBy("node_id").agg(F.count("*").alias("n"))
    count = F.coalesce("n", F.lit(0).cast("long"))
    w = words.select("canonical_word_id", node("Word", F.col("canonical_word_id")).alias("node_id"))
    return w.join(n, "node_id", "left").select("canonical_word_id", count.alias("senses"), (count > 0).cast("int").alias("has_sense"))


def words_of_concepts(edges: DataFrame, entries: DataFrame, parsed: DataFrame) -> DataFrame:
    """(concept_id, word): the words whose senses belong to each concept."""
    e = unique(edges).where("to_node_id LIKE 'Concept:%'")
    p = parsed.select(node("Sense", F.col("dictionary_entry_parsed_id")).alias("from_node_id"), "dictionary_entry_id").distinct()
    w = entries.where("word IS NOT NULL").select("dictionary_entry_id", "word").distinct()
    return e.join(p, "from_node_id").join(w, "dictionary_entry_id").select(F.col("to_node_id").alias("concept_id"), "word").distinct()


def walk(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(start, to_node_id, relation_type, depth, path): all walks of up to `depth` hops that visit no node twice.

    starts: node_id. The cycle check is on whole node ids, so Sense:1 is not taken for Sense:12.
    """
    e = cut(unique(edges))
    first = starts.select(F.col("node_id").alias("from_node_id")).distinct()
    at = e.join(maybe_broadcast(first), "from_node_id").select(F.col("from_node_id").alias("start"), "to_node_id", "relation_type", F.lit(1).alias("depth"), F.array("from_node_id", "to_node_id").alias("path"))
    at = cut(at)
    out = at
    for d in range(2, depth + 1):
        step = e.select(F.col("from_node_id").alias("here"), F.col("to_node_id").alias("next"), F.col("relation_type").alias("r"))
        at = at.join(step, F.col("to_node_id") == F.col("here")).where(~F.array_contains("path", F.col("next")))
        at = cut(at.select("start", F.col("next").alias("to_node_id"), F.col("r").alias("relation_type"), F.lit(d).alias("depth"), F.array_append("path", F.col("next")).alias("path")))
        out = out.unionByName(at)
    return out.withColumn("path", F.array_join("path", ">"))


def reach(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(start, node_id, depth): each node within `depth` hops of each start and its distance, by breadth-first frontiers.

    A start is listed only if a cycle leads back to it.
    """
    e = cut(unique(edges).select(F.col("from_node_id").alias("here"), F.col("to_node_id").alias("next")).distinct())
    at = starts.select(F.col("node_id").alias("start")).distinct().withColumn("node_id", F.col("start"))
    seen = None
    for d in range(1, depth + 1):
        found = at.join(e, F.col("node_id") == F.col("here")).select("start", F.col("next").alias("node_id")).distinct()
        if seen is not None:
            found = found.join(seen, ["start", "node_id"], "left_anti")
        at = cut(found.withColumn("depth", F.lit(d)))
        seen = at if seen is None else seen.unionByName(at)
        at = at.select("start", "node_id")
    return seen


def shortest(edges: DataFrame, starts: DataFrame, targets: str, depth: int) -> DataFrame:
    """(start, target, depth, path): a shortest path from each start to each node whose id begins with `targets`.

    Of several of one length the first in the order of the alphabet. Frontiers keep one path a node and start, do not go on
    from a target, and end when none is left.
    """
    e = cut(unique(edges).select(F.col("from_node_id").alias("here"), F.col("to_node_id").alias("next")).distinct())
    at = starts.select(F.col("node_id").alias("start")).distinct().select("start", F.col("start").alias("node_id"), F.col("start").alias("path"))
    seen = at.select("start", "node_id")
    out = None
    for d in range(1, depth + 1):
        found = at.join(e, F.col("node_id") == F.col("here")).groupBy("start", F.col("next").alias("node_id")).agg(F.min(F.concat_ws(">", "path", "next")).alias("path"))
        at = cut(found.join(seen, ["start", "node_id"], "left_anti"))
        if at.isEmpty() and out is not None:
            break
        seen = seen.unionByName(at.select("start", "node_id"))
        hit = F.col("node_id").startswith(targets)
        one = at.where(hit).select("start", F.col("node_id").alias("target"), F.lit(d).alias("depth"), "path")
        out = one if out is None else out.unionByName(one)
        at = at.where(~hit)
    return out


def concept_confidence(entries: DataFrame, parsed: DataFrame) -> DataFrame:
    """(canonical_word_id, sources, confidence): the share of all sources that know each canonical word's senses."""
    p = parsed.select("dictionary_entry_id", "source_code").where("source_code IS NOT NULL").distinct()
    e = entries.where("canonical_word_id IS NOT NULL").select("dictionary_entry_id", "canonical_word_id").distinct()
    total = F.lit(max(p.select("source_code").distinct().count(), 1))
    n = p.join(e, "dictionary_entry_id").select("canonical_word_id", "source_code").distinct().groupBy("canonical_word_id").agg(F.count("*").alias("sources"))
    return n.select("canonical_word_id", "sources", F.round(F.col("sources") / total, 4).alias("confidence"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node_id, out_degree, in_degree)."""
    e = unique(edges)
    ends = e.select(F.explode(F.array(F.struct(F.col("from_node_id").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("to_node_id").alias("node_id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x"))
    return ends.groupBy("x.node_id").agg(F.sum("x.o").alias("out_degree"), F.sum("x.i").alias("in_degree"))


def page_rank(edges: DataFrame, rounds: int = 5, damping: float = 0.85) -> DataFrame:
    """(node_id, rank) after some rounds; a node without outgoing edges passes nothing on."""
    e = cut(unique(edges).select("from_node_id", "to_node_id").distinct())
    out = e.groupBy("from_node_id").agg(F.count("*").alias("n"))
    links = cut(e.join(out, "from_node_id").select(F.col("from_node_id").alias("node_id"), "to_node_id", "n"))
    nodes = cut(e.select(F.explode(F.array("from_node_id", "to_node_id")).alias("node_id")).distinct())
    rank = nodes.withColumn("rank", F.lit(1.0))
    for i in range(rounds):
        given = links.join(rank, "node_id").groupBy(F.col("to_node_id").alias("node_id")).agg(F.sum(F.col("rank") / F.col("n")).alias("got"))
        rank = nodes.join(given, "node_id", "left").select("node_id", (F.lit(1 - damping) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"))
        if i % 3 == 2:
            rank = cut(rank)
    return rank


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(id, component): the least id of each connected component of links (a, b), by alternating star joins.

    Ends when nothing changes; raises after `most` rounds, which suffice for chains of far more than 2 ** 30 nodes.
    """
    e = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    for _ in range(most):
        both = e.select("a", "b").union(e.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        low2 = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low2, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").union(low2.select("m", "b")).distinct()
        small = cut(small)
        if small.exceptAll(e).isEmpty() and e.exceptAll(small).isEmpty():
            break
        e = small
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("id"), F.col("a").alias("component")).union(e.select("a", "a").distinct())
