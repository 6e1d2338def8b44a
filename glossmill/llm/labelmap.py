"""Problem 4: mapping free-entered values to a canonical list with a BK-tree.

A value is compared by its letters (consistent form, lower case; `b, a` is read as `a b`), as a whole and without the
words that the values themselves show to be mere dressing: leading or trailing words that occur round at least LEAST
labels of the catalogue (`esp. law`, `law, etc.`) are learned from all values first. It means the label

1. whose letters are the same, best with the same blanks between them (`in formal` is `formal`, not `informal`);
2. of which it is an abbreviation: each label is in the tree also by its beginnings of at least MIN_PREFIX letters, which
   count without any edit and if they begin one label only;
3. that a BK-tree under the Damerau-Levenshtein distance (unrestricted, a true metric) finds nearest, within MAX_EDITS
   edits, or one edit for labels of up to SHORT letters. Equally near labels: that of the whole value, then the smallest
   label_id.

Otherwise it means none (label_id 0). Null values and those of spaces only are no cases, nor are values written exactly
like a label of their kind. An empty catalogue maps every value to 0. A value with one word is never taken for dressing.

The distinct values are looked up once and, if they are few, broadcast to the rows; else rows are mapped where they are,
each task looking up each distinct value of a batch once. Either way rows are not shuffled, so a value that a third of all
rows hold costs nothing extra. A catalogue of more than TREE_LABELS labels is
cut into shards: each shard's tree in turn meets the distinct values, tells the best label and up to two owners of an
abbreviation, and what a value means is decided from what all shards told. The answers are the same.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.normalize import consistent
from glossmill.session import cut, maybe_broadcast, small, spread

MIN_PREFIX = 3
MAX_EDITS = 2
SHORT = 4
#: Labels round which a learned affix occurs at least, words it has at most, and affixes there may be in all.
LEAST = 3
AFFIX_WORDS = 3
AFFIXES = 100_000
#: Labels up to which the catalogue is broadcast as one tree, and labels in a shard beyond.
TREE_LABELS = 50_000
#: Values whose labels a task remembers.
MEMO = 100_000

_WORD = re.compile(r"[^\W_]+")


def distance(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance without restriction on repeated edits (a metric); most + 1 if it is above most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = len(a) + len(b)
    last: dict[str, int] = {}
    rows = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, match = [far, i], 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), match
            if x == y:
                match = j
            row.append(min(rows[i][j] + (x != y), rows[i][j + 1] + 1, row[j] + 1, rows[k][m] + (i - k - 1) + 1 + (j - m - 1)))
        last[x] = i
        rows.append(row)
    return min(rows[-1][-1], most + 1)


class BKTree:
    """Burkhard-Keller tree: the child at edge d of a node holds the words at distance d from the node's word."""

    def __init__(self, words: list[str]) -> None:
        self.root: tuple[str, dict] | None = None
        for w in dict.fromkeys(words):
            self._add(w)

    def _add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node = self.root
        while (d := distance(word, node[0], len(word) + len(node[0]))) in node[1]:
            node = node[1][d]
        if d:
            node[1][d] = (word, {})

    def within(self, word: str, most: int) -> list[tuple[int, str]]:
        """All (distance, word) within most; by the triangle inequality only edges d - most to d + most are followed."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            w, children = todo.pop()
            d = distance(word, w, most + max(children, default=0))
            if d <= most:
                out.append((d, w))
            todo += [c for e, c in children.items() if d - most <= e <= d + most]
        return out


def spelling(text: str) -> str:
    """The words of a consistent form in lower case, one blank between them."""
    if text.count(",") == 1:
        b, a = text.split(",")
        if _WORD.search(a) and _WORD.search(b):
            text = f"{a} {b}"
    return " ".join(_WORD.findall(text))


def letters(text: str) -> str:
    """The letters of a consistent form in lower case."""
    return spelling(text).replace(" ", "")


def lowered(value: str) -> str:
    return consistent(value).strip().lower()


def parts(text: str) -> Iterator[tuple[str, str, str]]:
    """(side, affix, letters of the rest) of each way to take a few leading or trailing words off a text."""
    at = [m.span() for m in _WORD.finditer(text)]
    words = [text[i:j] for i, j in at]
    for n in range(min(AFFIX_WORDS, len(words) - 1), 0, -1):
        yield "before", " ".join(words[:n]), letters(text[at[n][0] :])
        yield "after", " ".join(words[-n:]), letters(text[: at[-n - 1][1]])


def undressed(text: str, affixes: frozenset[tuple[str, str]]) -> str:
    """A text without learned affixes, longest ones first, as long as a word is left."""
    while affixes:
        at = [m.span() for m in _WORD.finditer(text)]
        words = [text[i:j] for i, j in at]
        for n in range(min(AFFIX_WORDS, len(words) - 1), 0, -1):
            if ("before", " ".join(words[:n])) in affixes:
                text = text[at[n][0] :]
                break
            if ("after", " ".join(words[-n:])) in affixes:
                text = text[: at[-n - 1][1]]
                break
        else:
            break
    return text


def forms(value: str, affixes: frozenset[tuple[str, str]]) -> list[str]:
    """The spellings by which a value is compared, that of the whole value first."""
    text = lowered(value)
    return [w for w in dict.fromkeys((spelling(text), spelling(undressed(text, affixes)))) if w]


class Catalogue:
    """Labels of one kind, or a shard of them."""

    def __init__(self, labels: list[tuple[int, str]]) -> None:
        self.exact = {str(x) for _, x in labels}
        #: Of each label's letters the smallest id, and that of each of its spellings.
        self.ids: dict[str, int] = {}
        self.spelt: dict[str, int] = {}
        for i, x in sorted(labels):
            self.ids.setdefault(letters(lowered(x)), i)
            self.spelt.setdefault(spelling(lowered(x)), i)
        self.ids.pop("", None)
        self.owners: dict[str, list[str]] = {}
        for w in self.ids:
            for n in range(MIN_PREFIX, len(w)):
                self.owners.setdefault(w[:n], []).append(w)
        self.tree, self.short = BKTree(list(self.ids)), BKTree(list(self.owners))

    def told(self, form: str) -> tuple[tuple[int, int, int] | None, list[tuple[str, int]]]:
        """(edits, whether the blanks differ, label_id) of the nearest label, and up to two (letters, label_id) of those a form abbreviates."""
        w = form.replace(" ", "")
        near = [(d, 0 if d else 1, self.ids[x]) for d, x in self.tree.within(w, MAX_EDITS) if d <= (1 if len(x) <= SHORT else MAX_EDITS)]
        if form in self.spelt:
            near.append((0, 0, self.spelt[form]))
        owners = [x for _, y in self.short.within(w, 0) for x in self.owners[y][:2]]
        return min(near, default=None), [(x, self.ids[x]) for x in owners]

    def label_of(self, forms: list[str]) -> int:
        """The label that a value of these forms means, 0 for none."""
        ranks = []
        for n, form in enumerate(forms):
            near, owners = self.told(form)
            if near:
                ranks.append((0, near[1], n, near[2]) if near[0] == 0 else (2, near[0], n, near[2]))
            if len(owners) == 1:
                ranks.append((1, n, 0, owners[0][1]))
        return min(ranks)[3] if ranks else 0


class _Memo(OrderedDict):
    """The labels of the last values."""

    def get_or(self, value: str, make) -> object:  # noqa: ANN001
        if value in self:
            self.move_to_end(value)
            return self[value]
        self[value] = made = make(value)
        if len(self) > MEMO:
            self.popitem(last=False)
        return made


def _values(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(kind, value): the distinct values of each kind."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f).alias("value")) for f, k in fields.items()])
    return rows.select(F.explode(pairs).alias("x")).select("x.kind", "x.value").where("value IS NOT NULL AND trim(value) <> ''").distinct()


def learned(values: DataFrame, labels: DataFrame) -> frozenset[tuple[str, str]]:
    """(side, affix): the words that values (kind, value) have before or after at least LEAST labels (label_kind, canonical_label)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *p) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p in parts(lowered(v))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["kind", "side", "affix", "rest"])

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([letters(lowered(x)) for x in b.column(1).to_pylist()], pa.string())], names=["kind", "rest"])

    known = labels.select("label_kind", "canonical_label").mapInArrow(spelt, "kind string, rest string").where("rest <> ''").distinct()
    seen = values.mapInArrow(split, "kind string, side string, affix string, rest string").join(maybe_broadcast(cut(known)), ["kind", "rest"])
    often = seen.groupBy("side", "affix").agg(F.countDistinct("kind", "rest").alias("n")).where(F.col("n") >= LEAST).select("side", "affix").limit(AFFIXES + 1).collect()
    if len(often) > AFFIXES:
        raise ValueError(f"more than {AFFIXES} affixes occur round {LEAST} labels; set LEAST higher")
    return frozenset((r.side, r.affix) for r in often)


def mapped(rows: DataFrame, row_id: str, fields: dict[str, str], catalogue: DataFrame) -> DataFrame:
    """(field, row_id, label_id) for each case of rows. fields: column -> label_kind."""
    out = f"field string, {row_id} long, label_id int"
    labels = catalogue.where(F.col("label_kind").isin(*fields.values()) & F.col("canonical_label").isNotNull() & F.col("label_id").isNotNull()).select("label_kind", "label_id", "canonical_label").distinct()
    known = labels.limit(TREE_LABELS + 1).collect()
    if len(known) > TREE_LABELS:
        return _sharded(rows, row_id, fields, labels)
    by_kind = {k: [(r.label_id, r.canonical_label) for r in known if r.label_kind == k] for k in fields.values()}
    values = cut(_values(rows, fields))
    shared = rows.sparkSession.sparkContext.broadcast((by_kind, learned(values, labels)))
    if small(values):
        return _cases(rows, row_id, fields).join(F.broadcast(cut(_meant(spread(values), shared))), ["kind", "value"]).select("field", row_id, "label_id")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        affixes = shared.value[1]
        cats = {k: Catalogue(v) for k, v in shared.value[0].items()}
        memos = {k: _Memo() for k in cats}
        for batch in batches:
            ids = batch.column(0)
            for n, (field, kind) in enumerate(fields.items(), 1):
                cat, memo = cats[kind], memos[kind]
                d = batch.column(n).dictionary_encode()
                meant = [None if v is None or not v.strip(" ") or v in cat.exact else memo.get_or(v, lambda v, c=cat: c.label_of(forms(v, affixes))) for v in d.dictionary.to_pylist()]
                label = pa.array(meant, pa.int32()).take(d.indices)
                keep = label.is_valid()
                if (m := keep.true_count) and len(batch):
                    yield pa.RecordBatch.from_arrays([pa.array([field]).take(pa.array([0] * m)), ids.filter(keep).cast(pa.int64()), label.filter(keep)], names=["field", row_id, "label_id"])

    return rows.select(row_id, *fields).where(" OR ".join(f"{f} IS NOT NULL" for f in fields)).mapInArrow(of, out)


def _meant(values: DataFrame, shared) -> DataFrame:  # noqa: ANN001
    """(kind, value, label_id) of values (kind, value) that are not written like a label."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        affixes = shared.value[1]
        cats = {k: Catalogue(v) for k, v in shared.value[0].items()}
        for b in batches:
            rows = [(k, v, cats[k].label_of(forms(v, affixes))) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if v not in cats[k].exact]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32()))], names=["kind", "value", "label_id"])

    return values.mapInArrow(of, "kind string, value string, label_id int")


def _cases(rows: DataFrame, row_id: str, fields: dict[str, str]) -> DataFrame:
    """(row_id, field, kind, value) of each value that is neither null nor only spaces."""
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind"), F.col(f).alias("value")) for f, k in fields.items()])
    return rows.select(F.col(row_id).cast("long").alias(row_id), F.explode(parts).alias("x")).select(row_id, "x.field", "x.kind", "x.value").where("value IS NOT NULL AND trim(value) <> ''")


def _sharded(rows: DataFrame, row_id: str, fields: dict[str, str], labels: DataFrame) -> DataFrame:
    """The same for a catalogue of any size: one pass over the distinct values for each shard of it."""
    spark = rows.sparkSession
    exact = cut(labels.select(F.col("label_kind").alias("kind"), F.col("canonical_label").alias("value")).distinct())
    values = cut(_values(rows, fields).join(exact, ["kind", "value"], "left_anti"))
    affixes = spark.sparkContext.broadcast(learned(values, labels))
    shards = max(1, -(-labels.count() // max(1, TREE_LABELS // 2)))
    numbered = cut(labels.withColumn("shard", F.pmod(F.xxhash64("canonical_label"), F.lit(shards)).cast("int")))
    told = None
    for n in range(shards):
        by_kind: dict[str, list[tuple[int, str]]] = {k: [] for k in fields.values()}
        for r in numbered.where(F.col("shard") == n).toLocalIterator():
            by_kind[r.label_kind].append((r.label_id, r.canonical_label))
        shared = spark.sparkContext.broadcast(by_kind)

        def of(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            cats = {k: Catalogue(v) for k, v in shared.value.items()}
            for b in batches:
                got = []
                for kind, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for f, form in enumerate(forms(value, affixes.value)):
                        near, owners = cats[kind].told(form)
                        got += [(kind, value, f, *near, None)] if near else []
                        got += [(kind, value, f, -1, 0, i, w) for w, i in owners]
                if got:
                    types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names=["kind", "value", "form", "edits", "spaced", "label_id", "owner"])

        one = cut(values.mapInArrow(of, "kind string, value string, form int, edits int, spaced int, label_id int, owner string"))
        told = one if told is None else told.union(one)
    per = told.groupBy("kind", "value", "form").agg(
        F.min(F.when(F.col("edits") >= 0, F.struct("edits", "spaced", "label_id"))).alias("near"),
        F.min(F.when(F.col("edits") < 0, F.struct("owner", "label_id"))).alias("first"),
        F.max("owner").alias("last"),
    )
    rank = lambda a, b, c, label: F.struct(*[x.cast("int").alias(n) for n, x in (("a", a), ("b", b), ("c", c), ("label_id", label))])
    near, form, zero = F.col("near.edits"), F.col("form"), F.lit(0)
    full = F.when(near == 0, rank(zero, F.col("near.spaced"), form, F.col("near.label_id"))).when(near > 0, rank(F.lit(2), near, form, F.col("near.label_id")))
    short = F.when(F.col("first.owner") == F.col("last"), rank(F.lit(1), form, zero, F.col("first.label_id")))
    best = cut(per.groupBy("kind", "value").agg(F.min(F.least(full, short)).alias("m")).select("kind", "value", F.col("m.label_id").alias("label_id")).where("label_id IS NOT NULL"))
    cases = _cases(rows, row_id, fields)
    cases = cases.join(maybe_broadcast(exact), ["kind", "value"], "left_anti")
    # A value that many rows hold is looked up in a broadcast, or its rows are shuffled by value and split where they are skewed.
    return cases.join(maybe_broadcast(best), ["kind", "value"], "left").select("field", row_id, F.coalesce("label_id", F.lit(0)).alias("label_id"))


def found(parsed: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(field, dictionary_entry_parsed_id, label_id); repeated deliveries count once."""
    return mapped(parsed.where("dictionary_entry_parsed_id IS NOT NULL"), "dictionary_entry_parsed_id", {"domain": "domain", "usage_label": "usage_label"}, catalogue).distinct()


def report(parsed: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(field, label_id, canonical_label, cases): how many rows mean each label; label 0 for the unmatched ones."""
    n = found(parsed, catalogue).groupBy("field", "label_id").agg(F.count("*").alias("cases"))
    return n.join(catalogue.select("label_id", "canonical_label"), "label_id", "left").select("field", "label_id", F.coalesce("canonical_label", F.lit("(none)")).alias("canonical_label"), "cases")
