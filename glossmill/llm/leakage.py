"""Problem 6: evaluation texts leaking into training text, by spaced-seed hashing.

A seed is a mask over up to SPAN consecutive words; the words at its open positions are hashed, those at its other
positions are ignored. Equal hashes of an item and a document are hits. Around each hit the two texts are compared along
their diagonal, which gives the longest run of equal words and the best overlap with substitutions (a match counts 1, a
substitution -1, and an overlap ends where it falls below 0 or more than DROP below its own peak; of several on one
diagonal the one of the highest score counts, the first among equals). Any run of SPAN equal words is hit by every seed,
so no exact leak is missed. An overlap counts with a run of SPAN words; or else with SPAN matches, at most one substitution
for each RATIO of them, and OWN matches that are not words of a template, which many items have.

The masks were chosen one after the other so that together they hit most random overlaps of 16 to 40 words. Measured
recall of overlaps with at least SPAN matches and no run of SPAN words (tests/llm/test_llm.py): at 10 % substituted words
0.96, 0.98 and 0.99 for 16, 24 and 40 words, at 20 % 0.90, 0.83 and 0.80.

The items are the stated query set: they are broadcast in blocks of at most BLOCK words, each block against all
documents, whole texts, without a shuffle. A hash that many items share is compared in steps of STEP hits, so memory
stays bounded and no hit is left out. Null texts and items of fewer than SPAN words give nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.neardup import mix
from glossmill.llm.normalize import words

SPAN = 12
#: Masks: x is hashed, - is ignored.
SEEDS = ("xxx-x-xxxx", "xxxxx--x--xx", "x-x--xxx-xxx", "xxx-xx---xxx", "xx-xxxx-x-x", "x-xxx-xx-xx", "xxx---x-xxxx", "xx--x-xx-xxx")
DROP = 4
#: Matches for each substitution of an overlap without a run of SPAN words.
RATIO = 3
#: Words in at least this share of the items, and in FEW of them, are those of templates; an overlap needs OWN others.
COMMON, FEW, OWN = 0.05, 3, 3
#: Words of items that are broadcast at once.
BLOCK = 1_000_000
#: Documents that a task compares at once, and hits that it holds at once.
SLICE = 256
STEP = 200_000
#: Bits of the table that tells most hashes of documents from those of items.
BITS = 22

_U = np.uint64


class Index:
    """The seeds of a block of items."""

    def __init__(self, items: list[tuple[int, list[str]]], common: frozenset[str] = frozenset()) -> None:
        self.vocabulary: dict[str, int] = {}
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws] for _, ws in items]
        self.item_ids = np.array([i for i, _ in items], np.int64)
        self.flat = np.array([x for ws in ids for x in ws], np.int64)
        self.start = np.cumsum([0, *map(len, ids)])
        self.owner = np.repeat(np.arange(len(ids)), np.diff(self.start))
        # Whether a word is an item's own; the last one is that of words no item has.
        self.own = np.array([w not in common for w in self.vocabulary] + [False], bool)
        # A number for each word; the last one is that of words no item has.
        self.numbers = mix(np.arange(1, len(self.vocabulary) + 2, dtype=np.uint64))
        self.seeds = []
        for s, seed in enumerate(SEEDS):
            places, h = self.windows(self.flat, self.owner, s)
            order = np.argsort(h, kind="stable")
            known = np.zeros(1 << BITS, bool)
            known[h >> _U(64 - BITS)] = True
            self.seeds.append((known, h[order], places[order]))

    def windows(self, flat: np.ndarray, owner: np.ndarray, s: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The places where a seed lies within one text, and its hashes there; with `known`, only those that it has."""
        seed = SEEDS[s]
        n = len(flat) - len(seed) + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        numbers, h = self.numbers[flat], np.zeros(n, np.uint64)
        for k in [k for k, c in enumerate(seed) if c == "x"]:
            h += numbers[k : k + n] * _U((0x9E3779B97F4A7C15 * (2 * (k + 16 * s) + 3) | 1) & 0xFFFFFFFFFFFFFFFF)
        at = np.flatnonzero(known[h >> _U(64 - BITS)]) if known is not None else np.arange(n)
        at = at[owner[at] == owner[at + len(seed) - 1]]
        return at, h[at]

    def hits(self, flat: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
        """(document number, item number, place in flat minus place in the item) of each diagonal with a hit."""
        out = []
        for s, (known, hashes, places) in enumerate(self.seeds):
            at, h = self.windows(flat, doc, s, known)
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            some = hi > lo
            at, lo, n = at[some], lo[some], (hi - lo)[some]
            end = np.cumsum(n)
            for begin in range(0, int(end[-1]) if len(end) else 0, STEP):
                nth = np.arange(begin, min(begin + STEP, int(end[-1])))
                who = np.searchsorted(end, nth, "right")
                out.append(self.near(flat, doc, at[who], places[lo[who] + nth - (end - n)[who]]))
        return [tuple(r) for r in np.unique(np.concatenate(out), axis=0).tolist()] if out else []

    def near(self, flat: np.ndarray, doc: np.ndarray, here: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of hits those with a run of SPAN equal words close by, or with SPAN equal ones of which OWN are no template's, as
        the diagonals of hits()."""
        item = self.owner[place]
        run, longest, equal, own = (np.zeros(len(here), np.int16) for _ in range(4))
        for o in range(-SPAN, 2 * SPAN):
            x, y = here + o, place + o
            inside = (x >= 0) & (x < len(flat)) & (y >= self.start[item]) & (y < self.start[item + 1])
            x, y = np.where(inside, x, 0), np.where(inside, y, 0)
            same = inside & (flat[x] == self.flat[y]) & (doc[x] == doc[here])
            run = (run + 1) * same
            longest = np.maximum(longest, run)
            equal += same
            own += same & self.own[flat[x]]
        close = (longest >= SPAN) | ((equal >= SPAN) & (own >= OWN))
        here, place, item = here[close], place[close], item[close]
        return np.unique(np.stack([doc[here], item, here - (place - self.start[item])], axis=1), axis=0)

    def overlap(self, flat: np.ndarray, lo: int, hi: int, item: int, diagonal: int) -> tuple[int, int, int, int]:
        """(longest run, matches, substitutions, matches that are no template's) along a diagonal; lo and hi bound the document in flat."""
        a, b = int(self.start[item]), int(self.start[item + 1])
        first = max(lo, diagonal)
        last = min(hi, diagonal + b - a)
        same = flat[first:last] == self.flat[a + first - diagonal : a + last - diagonal]
        run = longest = score = peak = best = begun = 0
        span = (0, 0)
        for n, x in enumerate(same.tolist(), 1):
            run = run + 1 if x else 0
            longest = max(longest, run)
            score += 1 if x else -1
            if score < 0 or score < peak - DROP:
                score, peak, begun = 0, 0, n
            elif x and score >= peak:
                # Equal scores: the longer one of one beginning, else the first.
                peak = score
                if score > best or (score == best and span[0] == begun):
                    best, span = score, (begun, n)
        best_part = same[span[0] : span[1]]
        matches, own = int(best_part.sum()), int((best_part & self.own[flat[first:last][span[0] : span[1]]]).sum())
        return longest, matches, span[1] - span[0] - matches, own


def counts(run: int, matches: int, substitutions: int, own: int) -> bool:
    """Whether an overlap counts."""
    return run >= SPAN or (matches >= max(SPAN, RATIO * substitutions) and own >= OWN)


def overlaps(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, run, matches, substitutions): the best overlap of each document and item.

    run: the longest run of equal words; matches and substitutions: those of the best overlap.
    """
    blocks: list[list[tuple[int, list[str]]]] = [[]]
    held, n, seen = 0, 0, Counter()
    for r in items.where("item_id IS NOT NULL AND item_text IS NOT NULL").select("item_id", "item_text").distinct().toLocalIterator():
        ws = words(r.item_text)
        n += 1
        seen.update(set(ws))
        if len(ws) < SPAN:
            continue
        if held + len(ws) > BLOCK and blocks[-1]:
            blocks.append([])
            held = 0
        blocks[-1].append((r.item_id, ws))
        held += len(ws)
    common = frozenset(w for w, k in seen.items() if k >= max(FEW, COMMON * n))
    out = None
    for block in blocks:
        one = _against(documents, block, common)
        out = one if out is None else out.unionByName(one)
    best = F.max(F.struct("run", "matches", (-F.col("substitutions")).alias("less"))).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.run", "m.matches", (-F.col("m.less")).alias("substitutions"))


def _against(documents: DataFrame, block: list[tuple[int, list[str]]], common: frozenset[str]) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast((block, common))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        get = index.vocabulary.get
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                ids = whole.column(0)[at : at + SLICE].to_pylist()
                per = [[get(w, -1) for w in words(x)] for x in whole.column(1)[at : at + SLICE].to_pylist()]
                ends = np.cumsum([0, *map(len, per)])
                flat = np.fromiter((x for ws in per for x in ws), np.int64, int(ends[-1]))
                doc = np.repeat(np.arange(len(per)), np.diff(ends))
                rows = [(d, i, index.overlap(flat, int(ends[d]), int(ends[d + 1]), i, diagonal)) for d, i, diagonal in index.hits(flat, doc)]
                rows = [(ids[d], int(index.item_ids[i]), *r[:3]) for d, i, r in rows if counts(*r)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["doc_id", "item_id", "run", "matches", "substitutions"])

    return documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(of, "doc_id long, item_id long, run int, matches int, substitutions int")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) where the document holds at least SPAN consecutive words of the item."""
    return overlaps(documents, items).where(F.col("run") >= SPAN).select("doc_id", "item_id")


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, suite, documents, partly): in how many documents each item stands with a run of SPAN words, and in how
    many only with substitutions. Items found nowhere have 0 and 0."""
    n = overlaps(documents, items).groupBy("item_id").agg(F.count_if(F.col("run") >= SPAN).alias("documents"), F.count_if(F.col("run") < SPAN).alias("partly"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return items.where("item_id IS NOT NULL").select("item_id", "suite").distinct().join(n, "item_id", "left").select("item_id", "suite", zero("documents"), zero("partly"))
