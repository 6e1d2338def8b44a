"""Problem 2: references to records that do not exist, no longer exist or do not exist yet.

All three fields of an edge are references: endpoints to nodes or labels, and the relation to the vocabulary. What exists
is one table of spans; a label or a relation has a span without beginning or end.

References are pre-aggregated per key and period (month of created_utc): their number, first and last time. Heavy keys
are few: their aggregates are checked against the spans that a broadcast of those keys finds. The remaining aggregates and
spans meet by one shuffle on the key, where keys without a span are anti-joined; the counts of both are united. A period
is resolved if spans that began before it last beyond it, orphan if no span touches it, and mixed otherwise; this is told
by a running maximum over the months of a key, so there is no row for each pair of a month and a span.

References in mixed periods are looked at again by the hour: the spans of earlier hours enter as one number, and a running
maximum goes over the sorted times of one key and hour. So no task holds a hot key's references of more than an hour, and
the work is linear in the rows.

A null reference is no case. A reference that was created at an unknown time does not resolve to a node, nor does a node
without created_utc exist. Repeated deliveries count once. Values are compared exactly as written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.operators.skew import HEAVY, HEAVY_KEYS, attach
from glossmill.session import cut, maybe_broadcast, small

# The fields of an edge that refer to something, and the values that refer to labels.
FIELDS = ("from_node_id", "to_node_id", "relation_type")
LABEL = r"^(Domain|Language):[0-9]+\z"
#: What a reference is looked up in.
NODES, RELATIONS = 0, 1
FOREVER = "9999-12-31 00:00:00"


def _month(t: str | Column) -> Column:
    return F.coalesce(F.date_format(t, "yyyy-MM"), F.lit("unknown"))


def references(edges: DataFrame) -> DataFrame:
    """(edge_id, field, space, ref, at): the fields of each edge that are not null; field is their number in FIELDS."""
    fields = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(RELATIONS if f == "relation_type" else NODES).alias("space"), F.col(f).alias("ref")) for n, f in enumerate(FIELDS)])
    out = edges.select("edge_id", F.explode(fields).alias("r"), F.col("created_utc").cast("timestamp_ntz").alias("at"))
    return out.select("edge_id", "r.field", "r.space", "r.ref", "at").where("ref IS NOT NULL")


def spans(nodes: DataFrame, relations: DataFrame, labels: DataFrame) -> DataFrame:
    """(space, ref, since, until): when each key exists; since is null for what always has. Never-deleted rows of a node are one span."""
    end = F.lit(FOREVER).cast("timestamp_ntz")
    until = F.coalesce(F.col("deleted_utc").cast("timestamp_ntz"), end)
    node = nodes.where(F.col("node_id").isNotNull() & F.col("created_utc").isNotNull() & ~F.col("node_id").rlike(LABEL))
    node = node.select(F.col("node_id").alias("ref"), F.col("created_utc").cast("timestamp_ntz").alias("since"), until.alias("until"))
    node = node.groupBy("ref", "until").agg(F.min("since").alias("since")).select(F.lit(NODES).alias("space"), "ref", "since", "until")
    always = lambda df, space, ref: df.select(F.lit(space).alias("space"), ref.alias("ref"), F.lit(None).cast("timestamp_ntz").alias("since"), end.alias("until"))
    label = always(labels.where(F.col("label_kind").isin("domain", "language") & F.col("label_id").isNotNull()), NODES, F.concat(F.initcap("label_kind"), F.lit(":"), F.col("label_id").cast("string")))
    relation = always(relations.where("relation_type IS NOT NULL"), RELATIONS, F.col("relation_type"))
    return node.unionByName(label.distinct()).unionByName(relation.distinct())


KEY = ("space", "ref")


def _verdicts(per: DataFrame, exists: DataFrame) -> DataFrame:
    """(space, ref, period, n, verdict) of each aggregate (space, ref, period, n, lo, hi), by the spans of its key."""
    t = F.lit(None).cast("timestamp_ntz")
    begun = exists.select(*KEY, F.when(F.col("since").isNull(), "").otherwise(_month("since")).alias("period"), "since", "until")
    # The last end of the spans that begin in a month, the beginning of the first, and the end of one that begins then.
    begun = begun.groupBy(*KEY, "period").agg(F.min("since").alias("since"), F.max("until").alias("until"), F.min_by("until", "since").alias("first"))
    rows = per.select(*KEY, "period", "n", "lo", "hi", t.alias("since"), t.alias("until"), t.alias("first"))
    rows = rows.unionByName(begun.select(*KEY, "period", F.lit(None).cast("long").alias("n"), t.alias("lo"), t.alias("hi"), "since", "until", "first"))
    # "" comes before all months, "unknown" after them; a month's references come before the spans that begin in it.
    line = Window.partitionBy(*KEY).orderBy("period", F.col("n").isNull())
    past = line.rowsBetween(Window.unboundedPreceding, -1)
    next_ = lambda c: F.when(F.lead("period").over(line) == F.col("period"), F.lead(c).over(line))
    rows = rows.select("*", F.max(F.col("period") == "").over(past).alias("always"), F.max("until").over(past).alias("before"), next_("since").alias("s"), next_("first").alias("f")).where("n IS NOT NULL")
    verdict = (
        F.when(F.col("always"), "resolved").when(F.col("lo").isNull(), "orphan").when(F.col("before") > F.col("hi"), "resolved")
        .when((F.col("s") <= F.col("lo")) & (F.col("f") > F.col("hi")), "resolved")
        .when((F.col("before") > F.col("lo")) | (F.col("s") <= F.col("hi")), "mixed").otherwise("orphan")
    )
    return rows.select(*KEY, "period", "n", verdict.alias("verdict"))


def _late(times: DataFrame, exists: DataFrame) -> DataFrame:
    """(space, ref, at): the times of references (space, ref, at) that no span of their key covers. Each key has spans."""
    hour = lambda t: F.date_trunc("hour", t).cast("timestamp_ntz")
    keys = times.select(*KEY).distinct()
    mine = cut(exists.join(maybe_broadcast(keys), list(KEY), "left_semi").select(*KEY, hour("since").alias("hour"), "since", "until"))
    hours = times.select(*KEY, hour("at").alias("hour"), F.lit(None).cast("timestamp_ntz").alias("until")).distinct().unionByName(mine.groupBy(*KEY, "hour").agg(F.max("until").alias("until")))
    # One row a key and hour; what began in earlier hours becomes one time.
    w = Window.partitionBy(*KEY).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    carried = hours.groupBy(*KEY, "hour").agg(F.max("until").alias("until")).select(*KEY, "hour", F.max("until").over(w).alias("until"))
    line = times.select(*KEY, hour("at").alias("hour"), F.col("at").alias("t"), F.lit(None).cast("timestamp_ntz").alias("until"), F.lit(1).alias("order"))
    line = line.unionByName(mine.select(*KEY, "hour", F.col("since").alias("t"), "until", F.lit(0).alias("order")))
    line = line.unionByName(carried.where("until IS NOT NULL").select(*KEY, "hour", F.lit(None).cast("timestamp_ntz").alias("t"), "until", F.lit(0).alias("order")))
    w = Window.partitionBy(*KEY, "hour").orderBy(F.col("t").asc_nulls_first(), "order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line.withColumn("reach", F.max("until").over(w)).where("order = 1 AND (reach IS NULL OR reach <= t)").select(*KEY, F.col("t").alias("at"))


def orphans(refs: DataFrame, exists: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """The rows of refs (space, ref, at and others) that no span (space, ref, since, until) of `exists` covers."""
    period = _month("at").alias("period")
    per = cut(refs.select(*KEY, period, "at").groupBy(*KEY, "period").agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")))
    exists = cut(exists)
    hot = cut(per.groupBy(*KEY).agg(F.sum("n").alias("n")).where(F.col("n") >= heavy).select(*KEY))
    if hot.isEmpty() or not small(hot, HEAVY_KEYS):
        told = _verdicts(per, exists)
    else:
        hot = F.broadcast(hot)
        of = lambda df, how: df.join(hot, list(KEY), how)
        told = _verdicts(of(per, "left_semi"), of(exists, "left_semi")).unionByName(_verdicts(of(per, "left_anti"), of(exists, "left_anti")))
    broken = cut(told.where("verdict <> 'resolved'"))
    found = attach(refs.withColumn("period", period), broken, [*KEY, "period"], "n", heavy).drop("n")
    if broken.where("verdict = 'mixed'").isEmpty():
        return found.drop("verdict")
    found = cut(found)
    mixed = found.where("verdict = 'mixed'").drop("verdict")
    times = cut(mixed.groupBy(*KEY, "at").agg(F.count("*").alias("n")))
    late = cut(_late(times.select(*KEY, "at"), exists).join(times, [*KEY, "at"]))
    return found.where("verdict = 'orphan'").drop("verdict").unionByName(attach(mixed, late, [*KEY, "at"], "n", heavy).drop("n"))


def broken(edges: DataFrame, nodes: DataFrame, relations: DataFrame, labels: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(edge_id, ref_field, value, period): each broken reference of each edge, repeated deliveries once."""
    lost = orphans(references(edges), spans(nodes, relations, labels), heavy)
    field = F.element_at(F.array(*[F.lit(f) for f in FIELDS]), F.col("field") + 1)
    return lost.select("edge_id", field.alias("ref_field"), F.col("ref").alias("value"), "period").distinct()


def found(edges: DataFrame, nodes: DataFrame, relations: DataFrame, labels: DataFrame) -> DataFrame:
    """(edge_id, ref_field) of each broken reference."""
    return broken(edges, nodes, relations, labels).select("edge_id", "ref_field").distinct()


def report(edges: DataFrame, nodes: DataFrame, relations: DataFrame, labels: DataFrame) -> DataFrame:
    """(ref_field, kind, period, broken): counts per field, kind of node (relation for relation_type) and month."""
    kind = F.when(F.col("ref_field") == "relation_type", "relation").when(F.col("value").contains(":"), F.substring_index("value", ":", 1)).otherwise("other")
    return broken(edges, nodes, relations, labels).groupBy("ref_field", kind.alias("kind"), "period").agg(F.count("*").alias("broken"))
