"""Mixing sources to target weights by thresholds on a hash.

Every document has a 60-bit hash.  A source takes whole copies of all its
documents as often as its target allows, and of what is then left it takes the
documents whose hash is below a threshold.  The threshold is found from
histograms of words by source and leading bits of the hash: the bucket in which
the running sum crosses the budget is cut again by the next bits, three times,
and only the documents of the last such bucket are looked at one by one.  Each
histogram after the first reads only the rows of the bucket before.
Nothing is sorted, and reruns take the same documents.  Budgets nest: with a
smaller target a source takes a part of what it took before.

Targets share out all words by the sources' weights, but no source gets more
than ``times`` its own words; the excess goes to the others by weight.

Defined cases: a null text has size 0; null is a source of its own, the last;
null and repeated ids are told apart by the text; identical rows share a hash
and are counted off in the last bucket, in LANES lanes; sources without words get
target 0; an empty table gives no rows.  What a source is has one row in every
table of sources, so their windows hold a row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightvault.llm.common import WORD, small, stash, table

WEIGHTS, TIMES = (1, 2, 3), 3
#: Bits of the hash that each histogram adds.
STEP, STEPS, BITS = 12, 3, 60
#: Lanes in which rows of the last bucket that are the same are counted off.
LANES = 1024


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES) -> DataFrame:
    """``source, source_size`` (a row each) with ``target``, ``base`` whole copies and ``rest`` words.

    Sources that reach their bound do so in the order of bound to weight; the
    level of the others follows from what those leave.  One row per source.
    """
    known = [F.col("source").isNull(), F.col("source")]
    nth = F.row_number().over(Window.orderBy(*known)) - 1
    w = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(nth, F.lit(len(weights))).cast("int") + 1).cast("long"))
    w = w.withColumn("most", F.col("source_size") * times).withColumn("ratio", F.col("most") / F.col("w"))
    every, before = Window.partitionBy(), Window.orderBy("ratio", *known).rowsBetween(Window.unboundedPreceding, -1)
    share = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    w = w.withColumn("share", share)
    first = F.min(F.when(F.col("share") < F.col("ratio"), F.struct("ratio", "share"))).over(every)
    w = w.withColumn("target", F.least(F.col("most").cast("double"), F.coalesce(first["share"] * F.col("w"), F.col("most"))))
    w = w.withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    return w.select("source", "source_size", "target", "base", (F.col("target") - F.col("base") * F.col("source_size")).alias("rest"))


def key_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The hash of a document."""
    named = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, BITS // 4), 16, 10).cast("long")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, source`` to doc_id, source, size in words, key and lane, written."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    lane = F.pmod(F.monotonically_increasing_id(), F.lit(LANES))
    return stash(docs.select("doc_id", "source", size.alias("size"), key_of().alias("key"), lane.alias("lane")), "keys")


def prefix(steps: int) -> Column:
    """The leading bits of the hash after so many histograms."""
    return F.shiftright("key", BITS - STEP * steps)


def of_source(rows: DataFrame, facts: DataFrame) -> DataFrame:
    facts = facts.withColumnRenamed("source", "of")
    return rows.join(small(facts, 96), F.col("source").eqNullSafe(F.col("of"))).drop("of")


def thresholds(keyed: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES) -> tuple[DataFrame, DataFrame]:
    """Per source its target, ``base``, ``rest``, and the bucket (``edge``) where the sum of
    words, ``below`` before it, crosses the rest; and the rows of these buckets."""
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    facts = stash(targets(sizes, weights, times).withColumns({"edge": F.lit(0).cast("long"), "below": F.lit(0).cast("long")}), "targets")
    rows = keyed
    for step in range(1, STEPS + 1):
        counted = rows.groupBy("source", prefix(step).alias("bucket")).agg(F.sum("size").alias("words"))
        counted = of_source(counted, facts.select("source", "below", "rest"))
        before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        crossed = counted.withColumn("before", F.col("below") + before).where("before < rest")
        edges = crossed.groupBy("source").agg(F.max(F.struct("bucket", "before")).alias("e")).select(F.col("source").alias("s"), F.col("e.bucket").alias("e"), F.col("e.before").alias("b"))
        nothing = F.lit(-1).cast("long")
        facts = facts.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "base", "rest", F.coalesce("e", nothing).alias("edge"), F.coalesce("b", F.lit(0)).cast("long").alias("below"))
        facts = stash(facts, "edges")
        rows = stash(of_source(rows, facts.select("source", "edge")).where(prefix(step) == F.col("edge")).select(*keyed.columns), "bucket")
    return facts, rows


def counted_off(last: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows of the last buckets with ``extra``: 1 for those that the rest of the budget still takes.

    The bucket holds a document or a few, and any number of rows that are the same: words
    are summed over groups of same rows by lane, and rows are numbered within a lane.
    """
    same = ["source", "key", "size", "lane"]
    groups = of_source(last.groupBy(*same).agg(F.count(F.lit(1)).alias("n")), facts.select("source", "below", "rest"))
    order = Window.partitionBy("source").orderBy("key", "size", "lane").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.col("below") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0)))
    groups = groups.select(F.col("source").alias("of"), *same[1:], "before", "rest")
    numbered = last.withColumn("nr", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64(*[c for c in last.columns if c not in same]))) - 1)
    on = [numbered[c] == groups[c] for c in same[1:]]
    joined = numbered.join(groups, [numbered["source"].eqNullSafe(groups["of"]), *on])
    before = F.col("before") + F.col("nr") * numbered["size"]
    return joined.select(*[numbered[c] for c in last.columns], F.when(2 * before + numbered["size"] < 2 * F.col("rest"), 1).otherwise(0).alias("extra"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, times: int = TIMES) -> DataFrame:
    """``doc_id, text, source`` to doc_id, source, size, source_size, target, copies, taken."""
    keyed = keyed_rows(docs)
    facts, last = thresholds(keyed, weights, times)
    names = ("doc_id", "source", "size", "source_size", "target", "copies")
    rows = of_source(keyed, facts)
    clear = rows.where(prefix(STEPS) != F.col("edge")).withColumn("copies", F.col("base") + F.when(prefix(STEPS) < F.col("edge"), 1).otherwise(0))
    edge = of_source(counted_off(last, facts), facts.select("source", "source_size", "target", "base")).withColumn("copies", F.col("base") + F.col("extra"))
    return clear.select(*names).unionByName(edge.select(*names)).withColumn("taken", F.col("size") * F.col("copies"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it.

    Texts stay where they are, but for the document or the few of the last bucket of a source.
    """
    facts, _ = thresholds(keyed_rows(docs.select("doc_id", "text", "source")))
    facts = facts.drop("source_size", "target")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", key_of().alias("key"))
    wide = of_source(wide, facts.select("source", "edge", "base"))
    clear = wide.where(prefix(STEPS) != F.col("edge")).select("row", (F.col("base") + F.when(prefix(STEPS) < F.col("edge"), 1).otherwise(0)).alias("copies"))
    lane, size = F.pmod(F.monotonically_increasing_id(), F.lit(LANES)), F.regexp_count(F.coalesce("row.text", F.lit("")), F.lit(WORD)).cast("long")
    last = stash(wide.where(prefix(STEPS) == F.col("edge")).withColumns({"lane": lane, "size": size}), "last")
    edge = counted_off(last, facts).select("row", (F.col("base") + F.col("extra")).alias("copies"))
    taken = clear.unionByName(edge).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w FROM s),
o AS (SELECT *, most::DOUBLE / w AS ratio, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS share
      FROM w WINDOW b AS (ORDER BY most::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(share, ratio) AS level FROM o WHERE share < ratio),
t AS (SELECT source, source_size, least(most::DOUBLE, coalesce(level * w, most)) AS target FROM o, l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base FROM t),
r AS (SELECT d.doc_id, size, source_size, target, base, target - base * source_size AS rest,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (size * (base + (2 * before + size < 2 * rest)::INT))::BIGINT AS taken FROM r
"""
