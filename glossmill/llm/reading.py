"""Problem 8: reading level of each document, by a Rasch-style latent difficulty model.

Whether word w occurs in document d is modelled as a rare event of rate m_d * exp(a_w + level_d * b_w), m_d being the
number of distinct words of the document: hard words (b > 0) become more frequent with the level, easy ones rarer. As in a
Rasch model there are sufficient statistics, so alternating optimisation needs one pass over the documents a round:

* given the words, a document's level depends on the sum of its words' difficulties and on m_d alone;
* given the levels, a word's difficulty depends on the mean level of the documents it occurs in and on how m is spread
  over the levels, a histogram of GRID bins.

Each language has a model of its own, so that a level tells how hard a text is among those of its language: words, spread
and scale are kept apart. The language of a text is told by its bytes in threes, by naive Bayes over a bounded sample of
at most about SAMPLE labelled documents of each language; labels that fewer than LEAST_LABELLED documents bear, and null
ones, teach nothing. All documents are read.

Words in at least MIN_DOCUMENTS documents and SHARE of all of a language have a difficulty of their own; there are at most
(words a document) / SHARE of them. All other words are pooled by the number of their documents: those in 1, in 2 or 3, in
4 to 7 and so on share the difficulty of their class, and each such word of a document counts as one occurrence of the
class. So every word of every document takes part, whatever the size of the corpus. The classes are broadcast if they are
few, else looked up by a shuffled join.

The first levels come from the length of words and sentences, which also fixes the sign. Levels are standardised; bands 1
to 5 are cut half-way between the mean levels of the bands that readers gave, learned from the rated documents whose hash
is even, so the others remain for a test. Without ratings, the cuts are the quintiles.

Null texts have no row. A document without a word gets the level of its surface, so every text has a level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.normalize import words
from glossmill.session import cut, small

MIN_DOCUMENTS = 20
SHARE = 0.001
ROUNDS = 6
#: Levels considered, in steps of a tenth; also the bins of the histogram.
GRID = np.round(np.arange(-40, 41) / 10, 1)
#: Labelled documents of each language that teach it, and how many of a label there must be.
SAMPLE = 500
LEAST_LABELLED = 20
#: Languages told apart.
LANGUAGES = 200
#: Numbers that three bytes in a row are reduced to.
BYTES = 1 << 14
#: Rare words up to which their classes are broadcast.
RARE = 2_000_000
_ENDS = re.compile(r"[.!?。！？]+")


def _threes(text: str) -> np.ndarray:
    """A number below BYTES for each three bytes in a row of a text in lower case."""
    b = np.frombuffer(text.lower().encode("utf8", "surrogatepass"), np.uint8).astype(np.uint32)
    return ((b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> np.uint32(18)).astype(np.int64)


class Languages:
    """The names of languages, the commonest first, and log weights (languages x BYTES) that tell them."""

    def __init__(self, names: list[str], counts: np.ndarray) -> None:
        self.names = names
        prior = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * BYTES) if len(names) else np.ones(BYTES)
        smooth = counts + 1000 * prior
        self.weights = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)

    def of(self, text: str) -> int:
        """The number of a text's language; the first one for a text of fewer than three bytes."""
        if len(self.names) < 2:
            return 0
        return int(self.weights[:, _threes(text)].sum(axis=1).argmax())


def languages(documents: DataFrame) -> Languages:
    """The languages of the labels of documents (doc_id, lang, text)."""
    labelled = documents.withColumn("l", F.lower(F.trim("lang"))).where(F.col("l").rlike(r"^[a-z]{2,3}$") & (F.length("text") > 0))
    n = {r.l: r.n for r in labelled.groupBy("l").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_LABELLED).orderBy(F.desc("n"), "l").limit(LANGUAGES + 1).collect()}
    if len(n) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    names = list(n)
    if len(names) < 2:
        return Languages(names or ["und"], np.zeros((1, BYTES)))
    share = F.create_map(*[x for k, v in n.items() for x in (F.lit(k), F.lit(int(min(1.0, SAMPLE / v) * (1 << 32))))])[F.col("l")]
    chosen = labelled.where(F.col("l").isin(names)).where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 32)) < share).select("l", "text")
    number = {k: i for i, k in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BYTES), np.int64)
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[number[k]] += np.bincount(_threes(t), minlength=BYTES)
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total.ravel()[i])], names=["i", "n"])

    rows = chosen.mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(names) * BYTES)
    counts[rows["i"].to_numpy()] = rows["n"].to_numpy()
    return Languages(names, counts.reshape(len(names), BYTES))


def _read(texts: DataFrame, told: Languages) -> DataFrame:
    """(doc_id, language, surface, words, hashes): the number of each document's language, the level its surface suggests,
    its number of words, and the hashes of its distinct words, each with its language."""
    shared = texts.sparkSession.sparkContext.broadcast(told)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, digest = shared.value, xxhash.xxh3_64_intdigest
        for whole in batches:
            for at in range(0, len(whole), 1024):
                b = whole.slice(at, 1024)
                language, hashes, surface, counts = [], [], [], []
                for t in b.column(1).to_pylist():
                    ws = words(t)
                    language.append(known.of(t))
                    hashes.append([digest(w, language[-1]) for w in set(ws)])
                    counts.append(len(ws))
                    letters = sum(map(len, ws)) / max(1, len(ws))
                    surface.append((letters - 5) / 0.8 + np.log(max(1.0, len(ws) / max(1, len(_ENDS.findall(t)))) / 12) / 0.4 if ws else 0.0)
                ends = np.cumsum([0, *map(len, hashes)]).astype(np.int32)
                flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, int(ends[-1])).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(language, pa.int32()), pa.array(np.clip(np.array(surface, float) / 2, -4, 4)), pa.array(counts, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc_id", "language", "surface", "words", "hashes"],
                )

    return texts.mapInArrow(of, "doc_id long, language int, surface double, words int, hashes array<long>")


class Items:
    """The numbering of words and classes: each word of its own, then for each language the classes of the rest."""

    def __init__(self, own: np.ndarray, language: np.ndarray, classes: list[int]) -> None:
        order = np.argsort(own)
        self.own = own[order]
        self.first = len(own) + np.cumsum([0, *classes])
        self.language = np.concatenate([language[order], np.repeat(np.arange(len(classes)), classes)]).astype(np.int64)


def _encoded(docs: DataFrame, items: Items, classes: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """(doc_id, items, surface, words, language, rare): documents with the numbers of their words; rare are the hashes of
    those without one. classes: the sorted hashes of all rare words and the number of each one's class, or null."""
    shared = docs.sparkSession.sparkContext.broadcast((items.own, classes))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pooled = shared.value
        for b in batches:
            lists = b.column(4)
            flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(b)), sizes)
            at = np.minimum(np.searchsorted(own, flat), max(len(own) - 1, 0))
            mine = own[at] == flat if len(own) else np.zeros(len(flat), bool)
            number = np.where(mine, at, -1)
            if pooled is not None and not mine.all():
                number[~mine] = pooled[1][np.searchsorted(pooled[0], flat[~mine])]
            some = number >= 0
            make = lambda keep, values, kind: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(b)))]).astype(np.int32)), pa.array(values[keep], kind))
            yield pa.RecordBatch.from_arrays([b.column(0), make(some, number, pa.int32()), b.column(2), b.column(3), b.column(1), make(~some, flat, pa.int64())], names=["doc_id", "items", "surface", "words", "language", "rare"])

    return docs.mapInArrow(of, "doc_id long, items array<int>, surface double, words int, language int, rare array<long>")


def encoded(docs: DataFrame) -> tuple[DataFrame, Items]:
    """(doc_id, items, surface, words, language) of documents as read, and the numbering of the items."""
    n = {r.language: r.n for r in docs.groupBy("language").agg(F.count("*").alias("n")).collect()}
    counts = cut(docs.select("language", F.explode("hashes").alias("h")).groupBy("language", "h").agg(F.count("*").alias("n")))
    least = {k: max(MIN_DOCUMENTS, int(np.ceil(SHARE * v))) for k, v in n.items()} or {0: MIN_DOCUMENTS}
    most = max(least) + 1
    limit = F.element_at(F.array(*[F.lit(least.get(k, MIN_DOCUMENTS)) for k in range(most)]), F.col("language") + 1)
    frequent = counts.where(F.col("n") >= limit).select("language", "h").toArrow()
    items = Items(frequent["h"].to_numpy(), frequent["language"].to_numpy(), [(least.get(k, MIN_DOCUMENTS) - 1).bit_length() for k in range(most)])
    first = F.element_at(F.array(*[F.lit(int(x)) for x in items.first]), F.col("language") + 1)
    rare = counts.where(F.col("n") < limit).select("h", (F.length(F.bin("n")) - 1 + first).cast("int").alias("item"))
    if small(rare, RARE):
        t = rare.toArrow()
        order = np.argsort(t["h"].to_numpy())
        return _encoded(docs, items, (t["h"].to_numpy()[order], t["item"].to_numpy()[order])).drop("rare"), items
    docs = cut(_encoded(docs, items, None).withColumn("row", F.monotonically_increasing_id()))
    # A rare word is in few documents, so no key of the join on words is hot; a document's classes are no more than its words.
    pooled = docs.select("row", F.explode("rare").alias("h")).join(rare, "h").groupBy("row").agg(F.collect_list("item").alias("pooled"))
    found = F.when(F.col("pooled").isNull(), F.col("items")).otherwise(F.concat("items", "pooled"))
    return docs.drop("rare").join(pooled, "row", "left").select("doc_id", found.alias("items"), "surface", "words", "language"), items


class Model:
    """Word difficulties and, on the grid, the rate of all words of each language together."""

    def __init__(self, a: np.ndarray, b: np.ndarray, language: np.ndarray, languages: int) -> None:
        self.b = b
        self.rate = np.zeros((languages, len(GRID)))
        np.add.at(self.rate, language, np.exp(a[:, None] + b[:, None] * GRID[None, :]))

    def levels(self, flat: np.ndarray, sizes: np.ndarray, surface: np.ndarray, language: np.ndarray) -> np.ndarray:
        """The most likely level of each document under a standard normal prior, between grid points by a parabola."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        total = np.bincount(owner, weights=self.b[flat] if len(flat) else None, minlength=len(sizes))
        score = total[:, None] * GRID - sizes[:, None] * self.rate[language] - GRID**2 / 2
        k = np.clip(score.argmax(axis=1), 1, len(GRID) - 2)
        r = np.arange(len(k))
        left, mid, right = score[r, k - 1], score[r, k], score[r, k + 1]
        bend = np.minimum(left - 2 * mid + right, -1e-9)
        return np.where(sizes > 0, np.clip(GRID[k] + 0.1 * np.clip(0.5 * (left - right) / bend, -1, 1), GRID[0], GRID[-1]), surface)


def difficulties(counts: np.ndarray, sums: np.ndarray, volume: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) of each word or class from its occurrences, the sum of their levels and the volume of each grid level. A class
    without occurrences has no rate.

    b makes the mean level under volume * exp(b * level) equal to the word's mean level, which a weak prior draws to the
    overall mean; found by bisection for all words at once.
    """
    mean = (volume * GRID).sum() / volume.sum()
    want = (sums + 5 * mean) / (counts + 5)
    lo, hi = np.full(len(counts), -3.0), np.full(len(counts), 3.0)
    for _ in range(30):
        b = (lo + hi) / 2
        w = volume * np.exp(b[:, None] * GRID)
        low = (w * GRID).sum(axis=1) / w.sum(axis=1) < want
        lo, hi = np.where(low, b, lo), np.where(low, hi, b)
    b = (lo + hi) / 2
    return np.log(np.maximum(counts, 1e-300)) - np.log((volume * np.exp(b[:, None] * GRID)).sum(axis=1)), b


def _lists(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items, their number in each document, surfaces and languages of a batch of encoded documents."""
    lists = b.column(1)
    return lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()), b.column(2).to_numpy(), b.column(4).to_numpy().astype(np.int64)


def _with_levels(docs: DataFrame, model: Model | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            flat, sizes, surface, language = _lists(b)
            level = surface if m is None else m.levels(flat, sizes, surface, language)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(level), b.column(3), b.column(4)], names=["doc_id", "level", "words", "language"])

    return docs.mapInArrow(of, "doc_id long, level double, words int, language int")


def fitted(docs: DataFrame, items: Items, rounds: int = ROUNDS) -> Model | None:
    """The model after alternating optimisation over encoded documents."""
    model: Model | None = None
    v, n, g = len(items.language), len(items.first) - 1, len(GRID)
    if not v:
        return None
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def of(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            m, total = shared.value, np.zeros(2 * v + n * (g + 3))
            volume, moments = total[2 * v : 2 * v + n * g].reshape(n, g), total[2 * v + n * g :].reshape(n, 3)
            for b in batches:
                flat, sizes, surface, language = _lists(b)
                level = surface if m is None else m.levels(flat, sizes, surface, language)
                total[:v] += np.bincount(flat, minlength=v)
                total[v : 2 * v] += np.bincount(flat, weights=np.repeat(level, sizes), minlength=v)
                np.add.at(volume, (language, np.clip(np.rint(level * 10).astype(int) + g // 2, 0, g - 1)), sizes)
                used = (sizes > 0).astype(float)
                np.add.at(moments, language, np.stack([used, used * level, used * level**2], axis=1))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "x"])

        rows = docs.mapInArrow(of, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
        total = np.zeros(2 * v + n * (g + 3))
        total[rows["i"].to_numpy()] = rows["x"].to_numpy()
        a, b = np.zeros(v), np.zeros(v)
        for k in range(n):
            mine = items.language == k
            counts, sums = total[:v][mine], total[v : 2 * v][mine]
            volume, (m, s, q) = total[2 * v + k * g : 2 * v + (k + 1) * g], total[2 * v + n * g + 3 * k :][:3]
            mean, sd = s / max(m, 1), max(np.sqrt(max(q / max(m, 1) - (s / max(m, 1)) ** 2, 0)), 1e-6)
            # Levels are standardised: the statistics are moved to the new scale, the volume to the nearest bins.
            to = np.clip(np.rint((GRID - mean) / sd * 10).astype(int) + g // 2, 0, g - 1)
            a[mine], b[mine] = difficulties(counts, (sums - mean * counts) / sd, np.bincount(to, weights=volume, minlength=g) + 1e-9)
        model = Model(a, b, items.language, n)
    return model


def levels(documents: DataFrame, ratings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, language, level, band, words): one row for each document with a text."""
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    told = languages(texts)
    docs, items = encoded(cut(_read(texts.select("doc_id", "text"), told)))
    docs = cut(docs)
    scored = cut(_with_levels(docs, fitted(docs, items, rounds)))
    means = {r.grade_band: r.level for r in rated(scored, ratings).where("learned").groupBy("grade_band").agg(F.avg("level").alias("level")).collect()}
    if len(means) == 5 and sorted(means.values()) == [means[k] for k in sorted(means)]:
        cuts = [(means[k] + means[k + 1]) / 2 for k in range(1, 5)]
    else:
        cuts = scored.approxQuantile("level", [0.2, 0.4, 0.6, 0.8], 0.001) or [0.0] * 4
    band = F.lit(1)
    for c in cuts:
        band = band + (F.col("level") > c).cast("int")
    name = F.element_at(F.array(*[F.lit(x) for x in told.names]), F.col("language") + 1)
    return scored.select("doc_id", name.alias("language"), F.round("level", 6).alias("level"), band.alias("band"), "words")


def rated(scored: DataFrame, ratings: DataFrame) -> DataFrame:
    """scored with grade_band for each rating, and whether the document is one that the cuts are learned from."""
    r = ratings.where("grade_band BETWEEN 1 AND 5").select("doc_id", "grade_band")
    return scored.join(r, "doc_id").withColumn("learned", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)


def profile(documents: DataFrame, ratings: DataFrame) -> DataFrame:
    """(source, language, band, documents, words): the corpus by source, language and band."""
    made = levels(documents, ratings).join(documents.select(F.col("doc_id"), "source"), "doc_id")
    return made.groupBy("source", "language", "band").agg(F.count("*").alias("documents"), F.sum("words").alias("words"))


def agreement(documents: DataFrame, ratings: DataFrame) -> DataFrame:
    """(grade_band, ratings, mean_level, same, near): ratings of held-out documents against their bands."""
    got = rated(levels(documents, ratings), ratings).where("NOT learned")
    off = F.abs(F.col("band") - F.col("grade_band"))
    return got.groupBy("grade_band").agg(F.count("*").alias("ratings"), F.round(F.avg("level"), 4).alias("mean_level"), F.count_if(off == 0).alias("same"), F.count_if(off <= 1).alias("near"))
