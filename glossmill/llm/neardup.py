"""Problem 1: near-duplicate records with small edits, by fast similarity sketching, banding and exact verification.

Each distinct word set is sketched in BANDS * ROWS coordinates. Round i throws every element into a bin: in the first t
rounds into a random one, in round t + b into bin b, so that every coordinate is filled after 2t rounds at the latest;
a coordinate keeps the element of the earliest round and least hash. Two sets agree in a coordinate with their
similarity as probability. Sets that agree in a whole band are candidates; candidates are verified on the whole sets.

A pair of similarity s is missed with probability (1 - s**ROWS) ** BANDS: 1e-3 at 0.7, 1e-4 at 0.75.

Each row of a bucket carries a signature: the parity of the set's words in each of BITS classes, and the size of the
set. Sets of similarity t differ in at most (1 - t) / (1 + t) * (|A| + |B|) words, and their signatures in no more bits,
so most candidates that share only template words end where they arise, and no similar pair does.

Buckets of more than BUCKET sets are not paired as they are but split, which loses no pair:

1. by one word of the sets' prefixes. In a common order of the words, frequent ones last, a similar pair shares a word
   that is among the first |A| - ceil(t |A|) + 1 of the larger set A and among the first |B| - ceil(2t / (1 + t) |B|) + 1
   of the smaller one B; so a word that all sets of a template have, but late, pairs none of them;
2. those that are still too large, by two words of prefixes that are longer by one;
3. those that are too large even then, by blocks of ids: each block meets each other one in a task of its own. Such sets
   have a band and two rare words in common, so nearly all of their pairs are results.

Definitions with one word set are sketched once, and copies are grouped before they are paired, so a group of copies may
hold a third of all rows.

Null definitions and those without a word belong to no pair. Repeated deliveries of an id count once; if an id came with
different texts, the one of the least hash counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.formatdup import LABELLED, parts_key
from glossmill.llm.normalize import consistent_col
from glossmill.operators.graph import components
from glossmill.operators.skew import attach
from glossmill.session import cut, maybe_broadcast

THRESHOLD = 0.7
ROWS = 4
BANDS = 24
#: Words in at least this share of the sets of large buckets come last in prefixes; there are at most (words a set) / COMMON of them.
COMMON = 0.002
#: Sets in a bucket that are paired at once.
BUCKET = 1024
#: Sets in a block of a bucket that words do not split.
BLOCK = 2048
#: Sets that are sketched at once.
SLICE = 2048

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 over an array of uint64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def sketch(elements: np.ndarray, owner: np.ndarray, sets: int, t: int) -> np.ndarray:
    """Fast similarity sketches (sets x t) of sets given as element hashes and the number of the set that owns each.

    Every set needs an element. Coordinates hold the round in the upper and a hash in the lower 40 bits.
    """
    empty = np.iinfo(np.uint64).max
    out = np.full(sets * t, empty, np.uint64)
    base = owner.astype(np.int64) * t
    e = elements
    for i in range(2 * t):
        # Elements are well mixed already, so a short hash does for each round.
        h = (e ^ _U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(32))) * _U(0x94D049BB133111EB)
        b = ((h >> _U(40)) * _U(t) >> _U(24)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, base + b, (h & _U(0xFFFFFFFFFF)) | _U(i << 40))
        if i % 8 == 7:
            todo = (out.reshape(sets, t) == empty).any(axis=1)
            if not todo.any():
                break
            keep = todo[base // t]
            if keep.mean() < 0.7:
                e, base = e[keep], base[keep]
    return out.reshape(sets, t)


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    n, t = sketches.shape
    s = mix(sketches.reshape(n, t // rows, rows))
    odd = mix(np.arange(1, rows + 1, dtype=np.uint64)) | _U(1)
    band = mix(np.arange(1, t // rows + 1, dtype=np.uint64) << _U(20))
    return mix((s * odd).sum(axis=2, dtype=np.uint64) + band).view(np.int64)


#: Two hashes each, together a key of 128 bits: of a whole word set, and of a definition's letters as copies are told by.
SET = ("s1", "s2")
COPY = ("c1", "c2")


def word_sets(rows: DataFrame, text: str, row_id: str) -> DataFrame:
    """(id, s1, s2, c1, c2, words): the distinct words of each text as sorted 64-bit hashes, and keys of set and letters."""
    form = rows.where(F.col(text).isNotNull() & F.col(row_id).isNotNull()).select(F.col(row_id).cast("long").alias("id"), consistent_col(F.col(text)).alias("form")).where(F.col("form").rlike(r"[\p{L}\p{N}]"))
    found = F.regexp_extract_all(F.lower("form"), F.lit(r"[\p{L}\p{N}]+"), 0)
    # The letters of a text are its words written together; only labelled definitions are read again.
    out = form.select("id", found.alias("found"), F.when(F.col("form").rlike(LABELLED), parts_key(F.col("form"))).alias("parts"))
    out = out.select("id", F.coalesce("parts", F.array_join("found", "")).alias("letters"), F.sort_array(F.array_distinct(F.transform("found", lambda w: F.xxhash64(w)))).alias("words"))
    key = lambda c, names: [F.xxhash64(c).alias(names[0]), F.xxhash64(F.lit(1), c).alias(names[1])]
    return out.select("id", *key("words", SET), *key("letters", COPY), "words")


#: Bits of a signature's parities; the 8 bits above hold the size of the set, OPEN for one too large to be told.
BITS = 40
OPEN = 255


def signatures(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The signature of each of several sets of word hashes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bits = np.zeros(len(sizes), np.uint64)
    np.bitwise_xor.at(bits, owner, _U(1) << (mix(words.view(np.uint64) + _U(0x51)) % _U(BITS)))
    return (bits | (np.minimum(sizes, OPEN).astype(np.uint64) << _U(BITS))).view(np.int64)


def sizes_of(sig: np.ndarray) -> np.ndarray:
    return sig >> BITS


def may_be_similar(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of those signatures can be so similar."""
    m, n = sizes_of(a), sizes_of(b)
    apart = np.bitwise_count((a ^ b).view(np.uint64) & _U((1 << BITS) - 1))
    fits = (apart <= (1 - threshold) / (1 + threshold) * (m + n) + 1e-9) & (np.minimum(m, n) >= threshold * np.maximum(m, n) - 1e-9)
    return fits | (np.maximum(m, n) >= OPEN)


def bucketed(sets: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(key, set_id, sig): the bands of each set. sets: set_id, words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                lists = batch.column(1)
                words = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(lists.offsets.to_numpy())
                keys = band_keys(sketch(mix(words.view(np.uint64)), np.repeat(np.arange(len(batch)), sizes), len(batch), rows * bands), rows)
                ids, sig = np.repeat(batch.column(0).to_numpy(), bands), np.repeat(signatures(words, sizes), bands)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids), pa.array(sig)], names=["key", "set_id", "sig"])

    return sets.select("set_id", "words").mapInArrow(of, "key long, set_id long, sig long")


#: Roles of a row in a bucket: its word is in the short prefix, too; and of two blocks, which one it is of.
SHORT, LEFT, RIGHT = 1, 2, 4
ANY = SHORT | LEFT | RIGHT


def run_pairs(rows: DataFrame, most: int | None, threshold: float) -> DataFrame:
    """(a, b, hot) from (key, set_id, sig) and perhaps role: the pairs a < b of each key that may be similar, hot false.

    A key with more than `most` sets gives no pairs but its rows, as a = key and b = set_id, hot true; most None: none
    is too large. Rows stream through sorted by key, so no group is held in memory but one of up to `most` sets.
    With roles, the smaller set of a pair must be SHORT, and the two must be of different blocks or of a block that is
    both LEFT and RIGHT.
    """
    columns = ["key", "set_id", "sig", *(["role"] if "role" in rows.columns else [])]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        hot = None

        def out(a: np.ndarray, b: np.ndarray, mark: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), mark))], names=["a", "b", "hot"])

        def close(k: np.ndarray, x: np.ndarray, g: np.ndarray, r: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
            size = np.diff(np.r_[start, len(k)])
            if most is not None and len(k) and (big := np.repeat(size > most, size)).any():
                yield out(k[big], x[big], True)
            left = np.repeat(start + size, size) - np.arange(len(k))
            at = np.flatnonzero((left > 1) & (np.repeat(size <= most, size) if most is not None else True))
            for s in range(1, len(k)):
                at = at[left[at] > s]
                if not len(at):
                    break
                ok = at[may_be_similar(g[at], g[at + s], threshold)]
                if r is not None:
                    m, n = sizes_of(g[ok]), sizes_of(g[ok + s])
                    first = (m < n) | ((m == n) & (x[ok] < x[ok + s]))
                    # Sizes that are not told may be in either order.
                    open_ = (m == OPEN) & (n == OPEN)
                    short = np.where(first, r[ok], r[ok + s]) | np.where(open_, r[ok] | r[ok + s], 0)
                    apart = ((r[ok] & LEFT) > 0) & ((r[ok + s] & RIGHT) > 0) | ((r[ok] & RIGHT) > 0) & ((r[ok + s] & LEFT) > 0)
                    ok = ok[((short & SHORT) > 0) & apart]
                a, b = x[ok], x[ok + s]
                a, b = np.minimum(a, b), np.maximum(a, b)
                if (differ := a < b).any():
                    yield out(a[differ], b[differ], False)

        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(len(columns))]
            if hot is not None:
                n = int(np.searchsorted(new[0], hot, "right"))
                if n:
                    yield out(new[0][:n], new[1][:n], True)
                if n == len(new[0]):
                    continue
                new, hot = [c[n:] for c in new], None
            held = new if held is None else [np.concatenate(c) for c in zip(held, new)]
            last = int(np.searchsorted(held[0], held[0][-1], "left")) if len(held[0]) else 0
            yield from close(*[c[:last] for c in held])
            held = [c[last:] for c in held]
            if most is not None and len(held[0]) > max(most, 50_000):
                hot = held[0][0]
                yield out(held[0], held[1], True)
                held = [c[:0] for c in held]
        if held is not None:
            yield from close(*held)

    return rows.select(*columns).repartition("key").sortWithinPartitions("key").mapInArrow(of, "a long, b long, hot boolean")


def prefixed(hot: DataFrame, order: dict[int, int], tokens: int, threshold: float) -> DataFrame:
    """(key, set_id, sig, role): members (key, set_id, words) of hot buckets by one or two words of their prefixes."""
    frequent = sorted(order, key=lambda w: (order[w], w))
    shared = hot.sparkSession.sparkContext.broadcast(np.array(frequent, np.int64))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        by_word = np.argsort(late)
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column(2)
            words, n = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(n)), n)
            key, ids, sig = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(), signatures(words, n)
            # Words that are not frequent come first, in the order of their hashes.
            rank = np.zeros(len(words), np.int64)
            if len(late):
                at = np.minimum(np.searchsorted(late, words, sorter=by_word), len(late) - 1)
                rank = np.where(late[by_word[at]] == words, by_word[at] + 1, 0)
            words = words[np.lexsort((words, rank, owner))]
            place = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
            long = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            short = n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9).astype(np.int64) + 1
            hashes = mix(words.view(np.uint64))
            chosen = place < long[owner]
            if tokens > 1:
                chosen &= (threshold * n <= 1)[owner]  # only such small sets may be similar by one word
            who = owner[chosen]
            out = [(mix(hashes[chosen] + key[who] + _U(7)), who, np.where(place[chosen] < short[who], ANY, ANY - SHORT))]
            if tokens > 1:
                begin = np.cumsum(n) - n
                for o in range(len(n)):
                    w = hashes[begin[o] : begin[o] + min(long[o] + 1, n[o])]
                    i, j = np.triu_indices(len(w), 1)
                    out.append((mix(w[j] + mix(w[i]) + key[o]), np.full(len(i), o), np.where(j < short[o] + 1, ANY, ANY - SHORT)))
            made, who, role = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(made.view(np.int64)), pa.array(ids[who]), pa.array(sig[who]), pa.array(role.astype(np.int32))], names=["key", "set_id", "sig", "role"])

    return hot.select("key", "set_id", "words").mapInArrow(of, "key long, set_id long, sig long, role int")


def blocked(hot: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, set_id, sig, role): members (key, set_id) of hot buckets in pairs of blocks of about `block` sets."""
    hot = cut(hot)
    n = hot.groupBy("key").agg(F.count("*").alias("n"))
    many = attach(hot, n, ["key"], "n").join(sets, "set_id").withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    mine = F.pmod(F.xxhash64("set_id", F.lit(5)), F.col("blocks")).cast("int")
    met = many.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    role = F.when(F.col("mine") == F.col("other"), ANY).when(F.col("mine") < F.col("other"), SHORT | LEFT).otherwise(SHORT | RIGHT)
    met = met.select(key.alias("key"), "set_id", "words", role.cast("int").alias("role"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = signatures(b.column(2).flatten().to_numpy(), np.diff(b.column(2).offsets.to_numpy()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sig), b.column(3)], names=["key", "set_id", "sig", "role"])

    return met.mapInArrow(of, "key long, set_id long, sig long, role int")


def similar_sets(sets: DataFrame, threshold: float = THRESHOLD, bucket: int | None = None, block: int | None = None) -> DataFrame:
    """(a, b): all pairs of sets (a < b) of at least that similarity. sets: set_id, words (distinct hashes, sorted)."""
    bucket, block = bucket or BUCKET, block or BLOCK
    found = cut(run_pairs(bucketed(sets), bucket, threshold))
    parts, hot = [found.where("NOT hot")], found.where("hot")
    with_words = lambda df: sets.join(maybe_broadcast(df.select(F.col("a").alias("key"), F.col("b").alias("set_id"))), "set_id").select("key", "set_id", "words")
    if not hot.isEmpty():
        members = cut(with_words(hot))
        least = max(2, int(np.ceil(COMMON * members.count())))
        order = {r[0]: r[1] for r in members.select(F.explode("words").alias("w")).groupBy("w").count().where(F.col("count") >= least).collect()}
        for tokens in (1, 2):
            one = cut(run_pairs(prefixed(members, order, tokens, threshold), bucket, threshold))
            parts.append(one.where("NOT hot"))
            hot = one.where("hot")
            if hot.isEmpty():
                break
            # A key of a round stands for a bucket and its words, so the next one asks for one word more of its members.
            members = cut(with_words(hot)) if tokens == 1 else members
        else:
            parts.append(run_pairs(blocked(hot.select(F.col("a").alias("key"), F.col("b").alias("set_id")).distinct(), sets, block), None, threshold))
    pairs = parts[0].select("a", "b")
    for p in parts[1:]:
        pairs = pairs.union(p.select("a", "b"))
    pairs = cut(pairs.distinct())
    # Only sets that are in a candidate take part in the verification.
    named = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    involved = cut(sets.join(maybe_broadcast(named), "set_id", "left_semi"))
    side = lambda c: involved.select(F.col("set_id").alias(c), F.col("words").alias(f"w{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common_words = F.size(F.array_intersect("wa", "wb"))
    return both.withColumn("i", common_words).where(F.col("i") / (F.size("wa") + F.size("wb") - F.col("i")) >= threshold).select("a", "b").distinct()


def _linked(parsed: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each definition's keys (id, s1, s2, c1, c2), the sets (s1, s2, set_id, set_n) and the links (a, b) between sets.

    A set's id is that of its least definition; set_n: how many it has. The words are neither grouped nor joined: the rows
    whose definition does not stand for its set are taken out by key.
    """
    rows = cut(word_sets(parsed, "definition", "dictionary_entry_parsed_id").withColumn("t", F.xxhash64(*SET, *COPY)))
    one = cut(rows.groupBy("id").agg(*[F.min_by(c, "t").alias(c) for c in (*SET, *COPY)], F.min("t").alias("t"), F.max("t").alias("last")))
    sets = cut(one.groupBy(*SET).agg(F.min("id").alias("set_id"), F.count("*").alias("set_n")))
    others = attach(one.select("id", *SET), cut(sets.where("set_n > 1")), list(SET), "set_n").where("id <> set_id").select("id")
    alone = rows.join(maybe_broadcast(cut(others)), "id", "left_anti")
    twice = one.where("last <> t").select("id", F.col("t").alias("chosen"))
    if not twice.isEmpty():
        alone = alone.join(maybe_broadcast(twice), "id", "left").where("chosen IS NULL OR chosen = t")
    return one.select("id", *SET, *COPY), sets, cut(similar_sets(alone.select(F.col("id").alias("set_id"), "words"), threshold))


def _ends(links: DataFrame) -> DataFrame:
    return cut(links.select(F.explode(F.array("a", "b")).alias("set_id")).distinct())


def _members(one: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, set_id, c1, c2, set_n) of each definition of those sets."""
    return cut(attach(one, sets, list(SET), "set_n").select("id", "set_id", *COPY, "set_n"))


def _classes(members: DataFrame) -> DataFrame:
    """(set_id, c1, c2, class_id, n, set_n): the groups of copies and how many definitions each has; its id is the least one."""
    return cut(members.groupBy("set_id", *COPY).agg(F.min("id").alias("class_id"), F.count("*").alias("n"), F.max("set_n").alias("set_n")))


def _class_pairs(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(ca, na, cb, nb): the pairs of classes whose sets are similar or the same, each once."""
    linked = cut(classes.join(maybe_broadcast(_ends(links)), "set_id", "left_semi"))
    side = lambda df, c: df.select(F.col("set_id").alias(c), *[F.col(k).alias(f"{k}{c}") for k in COPY], F.col("class_id").alias(f"c{c}"), F.col("n").alias(f"n{c}"))
    across = links.join(side(linked, "a"), "a").join(side(linked, "b"), "b").where("c1a <> c1b OR c2a <> c2b")
    # A class smaller than its set is one of several.
    several = classes.where("n < set_n")
    inside = side(several, "a").join(side(several, "b"), F.col("a") == F.col("b")).where("ca < cb")
    return across.select("ca", "na", "cb", "nb").union(inside.select("ca", "na", "cb", "nb"))


def found(parsed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id_a, id_b): the pairs of definitions of at least that similarity that aren't copies, each once, id_a < id_b."""
    one, sets, links = _linked(parsed, threshold)
    # Sets of one definition without a link are in no pair.
    linked = sets.join(maybe_broadcast(_ends(links).withColumn("linked", F.lit(True))), "set_id", "left").where("set_n > 1 OR linked").drop("linked")
    members = _members(one, cut(linked))
    classes = _classes(members)
    pairs = cut(_class_pairs(classes, links))
    # A class of one definition bears its id; others are expanded, without bringing a large class to one task.
    out = pairs.where("na = 1 AND nb = 1").select(F.col("ca").alias("x"), F.col("cb").alias("y"))
    grown = pairs.where("na > 1 OR nb > 1")
    if not grown.isEmpty():
        named = grown.select(F.explode(F.array("ca", "cb")).alias("class_id")).distinct()
        needed = cut(classes.where("n > 1").join(maybe_broadcast(cut(named)), "class_id", "left_semi").select("set_id", *COPY, "class_id", "n"))
        who = cut(attach(members, needed, ["set_id", *COPY], "n").select("class_id", F.col("id").alias("one")))
        for c, n in (("ca", "na"), ("cb", "nb")):
            many = cut(grown.where(f"{n} > 1").withColumnRenamed(c, "class_id"))
            more = attach(who, many, ["class_id"], n).withColumn(c, F.col("one")).drop("class_id", "one")
            grown = grown.where(f"{n} = 1").unionByName(more.select(*grown.columns))
        out = out.union(grown.select("ca", "cb"))
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def links(parsed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(dictionary_entry_parsed_id, class_id, links): each definition with a word, its group of copies, and how many other
    groups are similar to that one. class_id is the least id of the group."""
    one, sets, linked = _linked(parsed, threshold)
    members = _members(one, sets)
    classes = _classes(members)
    n = _class_pairs(classes, linked).select(F.explode(F.array("ca", "cb")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("links"))
    counted = cut(classes.join(n, "class_id", "left").select("set_id", *COPY, "class_id", "n", F.coalesce("links", F.lit(0).cast("long")).alias("links")))
    return attach(members, counted, ["set_id", *COPY], "n").select(F.col("id").alias("dictionary_entry_parsed_id"), "class_id", "links")


def groups(parsed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(dictionary_entry_parsed_id, group_id, members): the definitions that belong together by chains of links.

    Copies and definitions of one word set belong together too. group_id is the least id of the group; definitions that
    belong to no other have no row.
    """
    one, sets, linked = _linked(parsed, threshold)
    members = _members(one, sets)
    joined = components(linked).select(F.col("id").alias("set_id"), "component")
    sets = members.select("set_id", "set_n").distinct().join(joined, "set_id", "left").select("set_id", "set_n", F.coalesce("component", "set_id").alias("group_id"))
    sets = cut(sets)
    size = sets.groupBy("group_id").agg(F.sum("set_n").alias("members")).where("members > 1")
    grouped = cut(sets.join(size, "group_id"))
    return attach(members.drop("set_n"), grouped, ["set_id"], "set_n").select(F.col("id").alias("dictionary_entry_parsed_id"), "group_id", "members")
