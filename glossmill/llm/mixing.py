"""Problem 7: mixing sources to target weights.

1. A classifier (multinomial naive Bayes over the tokens of a public tokenizer) is fitted on a bounded sample of
   labelled documents and gives every document's posteriors over the listed sources. A document's own label is evidence
   too: it is right with a probability that is fitted, with the scale of the posteriors, on the half of the sample that the
   classifier has not seen.
2. Distributed projected-gradient least squares fits a rate of use between 0 and max_repeats for each document, so that
   the expected tokens of each domain, and the tokens under each label, reach their targets. The rate of a document depends
   on its source and its posteriors only, so documents are first aggregated by those (posteriors in steps of 1 / STEPS).
3. Rates become whole repeats: floor(rate * scale + u) with a u in [0, 1) of each document, which is unbiased. Of SALTS
   draws of u and all scales near 1, each source takes those whose tokens come nearest to its target.

The mix is as large as the scarcest listed source allows: its max_repeats times all of its tokens. A listed source
without documents cannot be mixed; the others share its part in proportion. Documents of sources that are not listed,
or of no source, take no part, nor do null and empty texts. No document is dropped for its length; whole texts count.
More than SOURCES listed sources are an error.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.session import cut, maybe_broadcast, small

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that cuts a text into pieces for this tokenizer.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Labelled documents, about, on which the classifier is fitted.
SAMPLE = 4000
#: Probabilities that a label is right, and scales of the posteriors' logits, of which the likeliest are taken.
TRUSTS = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99, 0.995, 0.999)
SCALES = (0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0)
STEPS = 16
#: Most iterations of the fit; it ends when no rate moves by TOLERANCE.
ITERATIONS = 300
TOLERANCE = 1e-5
#: Draws of each document's u, and the numbers of scales between 1 / WIDE and WIDE that are told apart at a time.
SALTS, BINS, WIDE = 8, 1024, 1.5
#: Sources a mix may list; each has a column of the classifier.
SOURCES = 1000


def encoder(ranks: bytes):  # noqa: ANN201
    """The tokenizer of the content of a rank file."""
    import tiktoken

    return tiktoken.Encoding("public", pat_str=PIECES, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, special_tokens={})


def _ranks(path: str) -> bytes:
    """A rank file, read by the driver and sent to the tasks; a few megabytes for any public tokenizer."""
    with open(path, "rb") as f:
        return f.read()


def _texts(documents: DataFrame, names: list[str]) -> DataFrame:
    return documents.where(F.col("source").isin(names) & F.col("doc_id").isNotNull() & (F.length("text") > 0)).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")


def _bits(doc_id: str, salt: int, bits: int) -> F.Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(salt)), F.lit(1 << bits))


def _logits(w: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
    """The mean of a text's weights counts as much as the root of their number, as tokens of a text are not independent."""
    return np.stack([w[x].sum(axis=0) / np.sqrt(max(1, len(x))) for x in ids])


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


class Classifier:
    """Log weights (tokens x sources), the scale of their sums and the probability that a label is right."""

    def __init__(self, counts: np.ndarray) -> None:
        all_tokens = counts.sum(axis=1, keepdims=True) + 0.5
        prior = all_tokens / all_tokens.sum()
        smooth = counts + 2000 * prior
        self.weights = np.log(smooth / smooth.sum(axis=0, keepdims=True) / prior).astype(np.float32)
        self.scale, self.trust = 1.0, TRUSTS[-1]

    def posteriors(self, ids: list[np.ndarray], labels: list[int]) -> np.ndarray:
        k = self.weights.shape[1]
        label = np.full((k, k), np.log((1 - self.trust) / max(1, k - 1)))
        np.fill_diagonal(label, np.log(self.trust))
        return _softmax(self.scale * _logits(self.weights, ids) + label[labels])


def classifier(documents: DataFrame, names: list[str], ranks: bytes, sample: int = SAMPLE) -> Classifier:
    """The classifier fitted on about `sample` labelled documents, chosen by a hash of their id."""
    labelled = documents.where(F.col("source").isin(names)).count()
    # A threshold on the hash chooses in place; a sort would bring candidates of all tasks to one.
    chosen = _texts(documents, names).where(_bits("doc_id", 3, 32) < F.lit(int(min(1.0, sample / max(labelled, 1)) * (1 << 32))))
    chosen = cut(chosen.withColumn("half", _bits("doc_id", 4, 1).cast("int")))
    number, k = {s: i for i, s in enumerate(names)}, len(names)
    shared = documents.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = encoder(shared.value), {}
        for b in batches:
            for s, text, half in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                got = np.bincount(np.asarray(enc.encode_ordinary(text), np.int64), minlength=enc.max_token_value + 2)
                total[half, s] = total.get((half, s), 0) + got
        for (half, s), got in total.items():
            t = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), half, np.int32)), pa.array(np.full(len(t), number[s], np.int32)), pa.array(t), pa.array(got[t])], names=["half", "k", "t", "n"])

    # At most 2 x tokens x sources rows come to the driver.
    rows = chosen.mapInArrow(count, "half int, k int, t long, n long").groupBy("half", "k", "t").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, encoder(ranks).max_token_value + 1, k))
    counts[rows["half"].to_numpy(), rows["t"].to_numpy(), rows["k"].to_numpy()] = rows["n"].to_numpy()
    halved, whole = documents.sparkSession.sparkContext.broadcast(Classifier(counts[0]).weights), Classifier(counts.sum(axis=0))

    def likelihood(b: pa.RecordBatch) -> np.ndarray:
        ids = [np.asarray(enc.encode_ordinary(t), np.int64) for enc in [encoder(shared.value)] for t in b.column(2).to_pylist()]
        x, own = _logits(halved.value, ids), np.array([number[s] for s in b.column(1).to_pylist()])
        p = np.stack([_softmax(s * x)[np.arange(len(own)), own] for s in SCALES])
        trust = np.array(TRUSTS)[:, None, None]
        return np.log(trust * p + (1 - trust) / max(1, k - 1) * (1 - p) + 1e-12).sum(axis=2)

    told = _sums(chosen.where("half = 1"), likelihood, (len(TRUSTS), len(SCALES)))
    t, s = np.unravel_index(told.argmax(), told.shape) if told.any() else (len(TRUSTS) - 1, SCALES.index(1.0))
    whole.trust, whole.scale = TRUSTS[t], SCALES[s]
    return whole


def scored(documents: DataFrame, names: list[str], ranks: bytes) -> DataFrame:
    """(doc_id, source, tokens, member): each listed document's tokens and soft membership in steps of 1 / STEPS."""
    shared = documents.sparkSession.sparkContext.broadcast((ranks, classifier(documents, names, ranks)))
    number, k = {s: i for i, s in enumerate(names)}, len(names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, model = encoder(shared.value[0]), shared.value[1]
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.slice(at, 512)
                ids = [np.asarray(enc.encode_ordinary(t), np.int64) for t in b.column(2).to_pylist()]
                n = np.array([len(x) for x in ids])
                p = model.posteriors(ids, [number[s] for s in b.column(1).to_pylist()])
                steps = np.floor(p * STEPS).astype(np.int64)
                rest = STEPS - steps.sum(axis=1)
                order = np.argsort(np.argsort(steps - p * STEPS, axis=1, kind="stable"), axis=1)
                steps += order < rest[:, None]
                member = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * k + 1, k, dtype=np.int32)), pa.array(steps.astype(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), pa.array(n.astype(np.int64)), member], names=["doc_id", "source", "tokens", "member"])

    return _texts(documents, names).mapInArrow(of, "doc_id long, source string, tokens long, member array<int>")


def _names(documents: DataFrame, targets: DataFrame) -> list[tuple[str, float, int]]:
    """(source, share of those that have documents, max_repeats) of each listed source with documents."""
    rows = targets.where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").select("source", "target_share", "max_repeats").limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise ValueError(f"a mix may list {SOURCES} sources")
    listed = {r.source: (r.target_share, r.max_repeats) for r in sorted(rows, key=str)}
    have = documents.where(F.col("source").isin(list(listed)) & (F.length("text") > 0)).select("source").distinct().collect()
    got = sorted(r.source for r in have)
    total = sum(listed[s][0] for s in got)
    return [(s, listed[s][0] / total, listed[s][1]) for s in got]


def _sums(df: DataFrame, partial: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all batches of an array of that small shape; only sums of partitions are shuffled."""
    n = int(np.prod(shape))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for b in batches:
            if len(b):
                total += partial(b).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "x"])

    rows = df.mapInArrow(of, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(n)
    out[rows["i"].to_numpy()] = rows["x"].to_numpy()
    return out.reshape(shape)


def _columns(b: pa.RecordBatch, number: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Source numbers, features (memberships and own label) and tokens of a batch of classes (source, member, tokens)."""
    source = np.array([number[s] for s in b.column(0).to_pylist()], np.int64)
    member = b.column(1).flatten().to_numpy().reshape(len(b), len(number)) / STEPS
    return source, np.hstack([member, np.eye(len(number))[source]]), b.column(2).to_numpy().astype(float)


def _rate(source: np.ndarray, features: np.ndarray, start: np.ndarray, cap: np.ndarray, steps: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after accelerated projected steps (step, momentum), and the point from which the next step is taken."""
    rate = ahead = start[source]
    for step, momentum in steps:
        new = np.clip(ahead - features @ step, 0, cap[source])
        rate, ahead = new, new + momentum * (new - rate)
    return rate, ahead


def fitted(classes: DataFrame, listed: list[tuple[str, float, int]]) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(source, member, cap, rate) of each class (source, member, tokens), the target tokens of each source, and the
    tokens expected of each domain and under each label.

    Each iteration is one aggregation over the classes: the sums of all sources go to the driver, the step that follows
    from them goes back. A table of classes that may be broadcast is aggregated on the driver.
    """
    k, number = len(listed), {s: i for i, (s, _, _) in enumerate(listed)}
    df = classes.select("source", "member", "tokens")
    local = [b for b in df.toArrow().to_batches() if len(b)] if small(df) else None
    total = lambda f, shape: sum((f(b) for b in local), np.zeros(shape)) if local is not None else _sums(df, f, shape)

    def volumes(b: pa.RecordBatch) -> np.ndarray:
        _, features, tokens = _columns(b, number)
        return tokens @ features

    volume = total(volumes, (2 * k,))
    have, volume = volume[k:], np.maximum(volume, 1)
    share, cap = np.array([q for _, q, _ in listed]), np.array([c for _, _, c in listed], float)
    target = (have * cap / share).min() * share
    start, steps, aims = target / have, [], np.concatenate([target, target])

    def reached(b: pa.RecordBatch) -> np.ndarray:
        source, features, tokens = _columns(b, number)
        rate, ahead = _rate(source, features, start, cap, steps)
        moved = np.abs(rate - _rate(source, features, start, cap, steps[:-1])[0]) if steps else np.ones(len(rate))
        return np.concatenate([(tokens * rate) @ features, (tokens * ahead) @ features, [(tokens * moved).sum()]])

    momentum = 1.0
    for _ in range(ITERATIONS):
        sums = total(reached, (4 * k + 1,))
        if sums[-1] < TOLERANCE * have.sum():
            break
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        # The two kinds of features have a norm of 1 each in this metric, so half a step never overshoots.
        steps.append((0.5 * (sums[2 * k : 4 * k] - aims) / volume, (momentum - 1) / after))
        momentum = after
    expected = total(reached, (4 * k + 1,))[: 2 * k]

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            source, features, _ = _columns(b, number)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cap[source]), pa.array(_rate(source, features, start, cap, steps)[0])], names=["source", "member", "cap", "rate"])

    return df.mapInArrow(rates, "source string, member array<int>, cap double, rate double"), target, expected


def rounded(rated: DataFrame, names: list[str], target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scale of each source's rates and the salt of its draws, by which its tokens come nearest to the target.

    rated: source, tokens, cap, rate and draws, the u of each salt. With repeats floor(min(cap, rate * scale) + u), a
    document gets its n-th repeat at scale (n - u) / rate; tokens are summed by bins of those, first of all scales near 1,
    then of those in the best bin.
    """
    number, n = {s: i for i, s in enumerate(names)}, len(names)
    bins = max(64, min(BINS, (1 << 20) // (n * SALTS)))
    lo, hi = np.full((n, SALTS), 1 / WIDE), np.full((n, SALTS), WIDE)

    def steps(b: pa.RecordBatch) -> np.ndarray:
        source = np.array([number[s] for s in b.column(0).to_pylist()], np.int64)
        tokens, cap, rate = (b.column(i).to_numpy().astype(float) for i in (1, 2, 3))
        u = b.column(4).flatten().to_numpy().reshape(len(b), SALTS)
        out = np.zeros((n, SALTS, bins + 1))
        for salt in range(SALTS):
            low, high = lo[source, salt], hi[source, salt]
            first = np.floor(np.minimum(cap, rate * low) + u[:, salt])
            np.add.at(out, (source, salt, 0), tokens * first)
            more = np.floor(np.minimum(cap, rate * high) + u[:, salt]) - first
            for m in range(1, int(more.max(initial=0)) + 1):
                at = np.flatnonzero(more >= m)
                scale = (first[at] + m - u[at, salt]) / rate[at]
                place = np.clip(np.ceil((scale - low[at]) / (high - low)[at] * bins), 1, bins).astype(int)
                np.add.at(out, (source[at], salt, place), tokens[at])
        return out

    for _ in range(2):
        reached = _sums(rated, steps, (n, SALTS, bins + 1)).cumsum(axis=2)
        off = np.abs(reached - target[:, None, None])
        j = off.argmin(axis=2)
        best = np.take_along_axis(off, j[:, :, None], 2)[:, :, 0]
        width = (hi - lo) / bins
        scale = lo + width * j
        # The next pass looks at the bins on both sides of the best one.
        lo, hi = lo + width * np.maximum(j - 1, 0), lo + width * np.minimum(j + 1, bins)
    salt = best.argmin(axis=1)
    return scale[np.arange(n), salt], salt


def _mix(documents: DataFrame, targets: DataFrame, tokenizer: str) -> tuple[DataFrame, list[str], np.ndarray, np.ndarray] | None:
    """(doc_id, source, tokens, repeats, member) of the mix, the names of its sources, their targets and the fit's totals."""
    listed = _names(documents, targets)
    if not listed:
        return None
    names = [s for s, _, _ in listed]
    docs = cut(scored(documents, names, _ranks(tokenizer)))
    classes = cut(docs.groupBy("source", "member").agg(F.sum("tokens").alias("tokens")))
    rates, target, expected = fitted(classes, listed)
    # (sources x combinations of STEPS steps) rows at most, however many documents there are; few in fact.
    rated = docs.join(maybe_broadcast(cut(rates)), ["source", "member"])
    draws = F.array(*[_bits("doc_id", 7 + i, 40) / F.lit(float(1 << 40)) for i in range(SALTS)])
    rated = cut(rated.where("rate > 0").select("source", "tokens", "cap", "rate", draws.alias("draws"), "doc_id", "member"))
    scale, salt = rounded(rated.select("source", "tokens", "cap", "rate", "draws"), names, target)
    by_source = lambda values: F.create_map(*[x for s, y in zip(names, values) for x in (F.lit(s), F.lit(y))])[F.col("source")]
    u = F.element_at("draws", by_source([int(x) + 1 for x in salt]))
    repeats = F.floor(F.least(F.col("cap"), F.col("rate") * by_source([float(x) for x in scale])) + u).cast("int")
    return rated.withColumn("repeats", repeats).where("repeats > 0").select("doc_id", "source", "tokens", "repeats", "member"), names, target, expected


def mixed(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens, repeats): the documents of the mix; repeats is at least 1."""
    spark: SparkSession = documents.sparkSession
    mix = _mix(documents, targets, tokenizer)
    if mix is None:
        return spark.createDataFrame([], "doc_id long, source string, tokens long, repeats int")
    return mix[0].drop("member")


def shares(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, target_share, max_repeats, documents, most_repeats, tokens, share, domain_share, fit_error): what each
    listed source reached.

    share is that of all tokens of documents with the label, domain_share that expected by the posteriors. fit_error is by
    how much the fitted rates miss the target of the domain, as a share of it; 0 where nothing was fitted.
    """
    made = _mix(documents, targets, tokenizer)
    listed = targets.where("source IS NOT NULL").select("source", "target_share", "max_repeats")
    if made is None:
        return listed.select("*", F.lit(0).cast("long").alias("documents"), F.lit(0).alias("most_repeats"), F.lit(0).cast("long").alias("tokens"), *[F.lit(0.0).alias(c) for c in ("share", "domain_share", "fit_error")])
    mix, names, target, expected = made
    mix = cut(mix)
    used = F.col("tokens") * F.col("repeats")
    per = mix.groupBy("source").agg(F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"), F.sum(used).alias("tokens"))
    total = mix.agg(F.sum(used)).first()[0] or 1
    parts = mix.select(used.alias("used"), F.posexplode("member").alias("i", "m")).groupBy("i").agg(F.sum(F.col("used") * F.col("m") / STEPS).alias("expected"))
    domain = parts.select(F.element_at(F.array(*[F.lit(s) for s in names]), F.col("i") + 1).alias("source"), (F.col("expected") / total).alias("domain_share"))
    errors = documents.sparkSession.createDataFrame([(s, float(expected[i] / target[i] - 1)) for i, s in enumerate(names)], "source string, fit_error double")
    zero = lambda c, t: F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c)
    out = listed.join(per, "source", "left").join(F.broadcast(domain), "source", "left").join(F.broadcast(errors), "source", "left")
    return out.select("source", "target_share", "max_repeats", zero("documents", "long"), zero("most_repeats", "int"), zero("tokens", "long"), F.coalesce(F.col("tokens") / total, F.lit(0.0)).alias("share"), zero("domain_share", "double"), zero("fit_error", "double"))
