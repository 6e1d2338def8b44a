"""Full-text suggestions: for a text, the stored texts of its source and mode that hold all its terms, best first.

Searches look up the postings of one term only, the rarest of a query: every text that holds all terms holds that one, too.
No other postings are made: texts are split into terms where they lie, and only those terms go on that some query asks
for. What is found is checked against the whole query. Queries of equal terms are searched once.

Scores are BM25 over the texts of one source and mode, rounded to 6 digits; equal scores are ordered by document id.

Whole texts are indexed and searched for. Texts without a source or a mode meet nothing, unless the column is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.functions import text
from glossmill.session import cut, maybe_broadcast, small

K1, B = 1.2, 0.75
#: The least score of a hit, and characters of its preview.
LEAST = 1.2
PREVIEW_CHARS = 120
KEYS = ["source", "mode"]


def terms(c: Column) -> Column:
    return text.tokens(c)


def _keyed(df: DataFrame) -> DataFrame:
    for k in KEYS:
        if k not in df.columns:
            df = df.withColumn(k, F.lit(""))
    return df


def index(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source, mode, doc_id, words, length, preview) and (source, mode, documents, mean) of documents (doc_id, text, and perhaps
    source and mode): the words in order with their repetitions, and the number and mean length of the texts."""
    w = _keyed(documents).select(*KEYS, "doc_id", terms(F.col("text")).alias("words"), F.substring("text", 1, PREVIEW_CHARS).alias("preview"))
    # Filtered after it is written, else texts are split twice.
    d = cut(w.withColumn("length", F.size("words"))).where("length > 0")
    return d, cut(d.groupBy(*KEYS).agg(F.count("*").alias("documents"), F.avg("length").alias("mean")))


def _frequencies(d: DataFrame, asked: DataFrame) -> DataFrame:
    """(source, mode, term, df): in how many documents the terms of asked (source, mode, term) are; none if in none."""
    key = [*KEYS, "term"]
    asked, post = cut(asked.distinct()), d.select(*KEYS, F.explode(F.array_distinct("words")).alias("term"))
    count = F.count("*").alias("df")
    if small(asked):
        return cut(post.join(F.broadcast(asked), key, "left_semi").groupBy(*key).agg(count))
    return cut(post.groupBy(*key).agg(count).join(asked, key, "left_semi"))


def _holding(d: DataFrame, leads: DataFrame) -> DataFrame:
    """(source, mode, asked, doc_id, words, length): documents that hold the term of leads (source, mode, asked, term)."""
    key, post = [*KEYS, "term"], F.explode(F.array_distinct("words")).alias("term")
    if small(leads):
        return d.select(*KEYS, "doc_id", "words", "length", post).join(F.broadcast(leads), key).drop("term")
    found = d.select(*KEYS, "doc_id", post).join(leads, key).drop("term")
    return found.join(d.drop("preview"), [*KEYS, "doc_id"])


def search(documents: DataFrame, queries: DataFrame, top: int = 3, least: float = LEAST) -> DataFrame:
    """(query_id, mode, rank, doc_id, score, preview): the best documents that hold every term of each query (query_id, text,
    and perhaps source and mode), of its source and mode.

    A document is not suggested for itself. doc_id and query_id are unique in their source and mode; of a query that is
    repeated there any one counts.
    """
    top = min(max(top, 1), 10)
    d, stats = index(documents)
    q = _keyed(queries).select(*KEYS, "query_id", F.sort_array(F.array_distinct(terms(F.col("text")))).alias("need")).dropDuplicates([*KEYS, "query_id"])
    q = cut(q.withColumn("asked", F.min("query_id").over(Window.partitionBy(*KEYS, "need")))).where(F.size("need") > 0)
    one = [*KEYS, "asked"]
    each = q.where("query_id = asked").select(*one, F.size("need").alias("terms"), F.explode("need").alias("term"))
    df = _frequencies(d, each.select(*KEYS, "term"))
    idf = F.log(1 + (F.col("documents") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = each.join(maybe_broadcast(df), [*KEYS, "term"]).join(maybe_broadcast(stats), KEYS).withColumn("idf", idf)
    need = known.groupBy(*one, "terms", "mean").agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("need"), F.min(F.struct("df", "term")).alias("rarest"))
    need = cut(need.where(F.size("need") == F.col("terms")).select(*one, "mean", "need", F.col("rarest.term").alias("term")))
    full = _holding(d, need.select(*one, "term")).join(maybe_broadcast(need.drop("term")), one)
    full = full.where(F.forall("need", lambda t: F.array_contains("words", t["term"])))
    tf = lambda t: F.size(F.filter("words", lambda x: x == t["term"]))
    weight = lambda t: t["idf"] * tf(t) * (K1 + 1) / (tf(t) + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    scored = full.select(*one, "doc_id", F.round(F.aggregate("need", F.lit(0.0), lambda s, t: s + weight(t)), 6).alias("score")).where(F.col("score") >= least)
    order = [F.desc("score"), "doc_id"]
    # One more than asked for: a query's own document is among them for some of the queries only.
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*one).orderBy(*order))).where(F.col("rank") <= top + 1).drop("rank")
    hits = q.drop("need").join(best, one).where("doc_id <> query_id")
    hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*KEYS, "query_id").orderBy(*order))).where(F.col("rank") <= top)
    shown = d.select(*KEYS, "doc_id", "preview")
    return shown.join(maybe_broadcast(cut(hits.select(*KEYS, "query_id", "rank", "doc_id", "score"))), [*KEYS, "doc_id"]).select("query_id", "mode", "rank", "doc_id", "score", "preview")


def confidence(score: Column) -> Column:
    """A score as a confidence of 0.05 to 0.99."""
    return F.when(score <= 0, 0.0).otherwise(F.round(text.clamp(score / 10, 0.05, 0.99), 4))


def safe(c: Column, most: int) -> Column:
    """Whether a text may become a rewrite: 4 to `most` characters of one line, few digits and symbols, no final colon."""
    t = text.trim(c)
    seen = F.regexp_replace(t, r"\s", "")
    share = lambda p: (F.length(seen) - F.length(F.regexp_replace(seen, p, ""))) / F.length(seen)
    ok = (F.length(t) > 3) & (F.length(t) <= most) & ~t.rlike(r"[\n\r\t]") & (share(r"\p{Nd}") < 0.2) & (share(r"[^\p{L}\p{Nd}]") < 0.35) & ~t.endswith(":")
    return F.coalesce(ok, F.lit(False))


def score_band(score: Column) -> Column:
    return F.when(score >= 2.0, 0.9).when(score >= 1.6, 0.8).when(score >= 1.2, 0.7).otherwise(0.6)


#: The longest text of each mode that may become a rewrite.
SAFE_CHARS = {"title": 80, "definition": 300, "example": 200}


def candidates(hits: DataFrame) -> DataFrame:
    """(query_id, mode, doc_id, confidence): hits (query_id, mode, doc_id, score, preview) whose text may become a rewrite, as sure
    as the band of their score."""
    ok = None
    for mode, most in SAFE_CHARS.items():
        one = (F.col("mode") == mode) & safe(F.col("preview"), most)
        ok = one if ok is None else ok | one
    # Hits are written first, else the test goes on to every stored text, before the few hits are chosen.
    return cut(hits).where(ok).select("query_id", "mode", "doc_id", score_band(F.col("score")).alias("confidence"))
