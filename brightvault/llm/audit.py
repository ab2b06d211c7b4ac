"""How filters act together: what each removes in every order of five of them.

Each document fails some of five filters.  Four of them look at its text alone;
the fifth, E, asks whether the table has the same text under a smaller id.  Its
ids come from a left-semi join of the table with itself, on hash, exact text and
smaller id, and are put together with the ids that fail the others: a
combination of five bits per document.  What any order of the filters keeps and
removes follows from the number of documents of each combination, 32 a part at most.

The other side of the semi join is made smaller first: of a hash, the distinct texts
with the least id of each, merged where they lie.  Where a hash has one text, the
bytes are settled by that, and its rows join on hash and smaller id without their
texts, by broadcast if the hash is hot.  Where texts collide, the rows bring theirs.

Defined cases: a null text is an empty one, it fails ``A`` and, if not the first, ``E``;
a null lang is the part ''; a row without an id is never smaller and never fails E;
rows that repeat an id count each, and E asks for a smaller id; of several labels of an id any counts;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import json
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import facts_of, small, small_batches, stash, table

#: The filters by letter; bit i belongs to filter i.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 200, 50, 3
ODD = b"#$%&*|"
COUNTS = ("n", "good", "toxic")
STEP = ("filter_order", "step", "before", "own")


def text_bits(text: str) -> int:
    """The bits of A to D."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * int(seen[65:91].sum()) > MAX_UPPER * len(text),
        bool(seen[list(ODD)].any()),
    )
    return sum(bad << i for i, bad in enumerate(fails))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def judged(docs: DataFrame, of=digest) -> DataFrame:
    """``doc_id, lang, text`` to doc_id, part, the text's hash ``h`` and the ``bits`` of A to D, written."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def bits(texts: pd.Series) -> pd.Series:
        return texts.map(text_bits).astype("int64")

    text = F.coalesce("text", F.lit(""))
    return stash(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), of(text).alias("h"), bits(text).alias("bits")), "judged")


def copies(rows: DataFrame, docs: DataFrame, of=digest) -> DataFrame:
    """Of ``rows``, as :func:`judged` gives them, those whose text stands under a smaller id: doc_id, part, h."""
    repeated = stash(rows.groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("h"), "repeated")
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), of(text).alias("h"), text.alias("text")).join(small(repeated, 64), "h", "left_semi")
    first = stash(texts.groupBy("h", "text").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "first")
    by_hash = first.groupBy("h").agg(F.count(F.lit(1)).alias("texts"), F.min("least").alias("least"), F.sum("n").alias("n"))
    by_hash = stash(by_hash, "texts-of-hash")
    # One text a hash: equal hashes are equal texts, and the least id is all that the rows must meet.
    alone = facts_of(rows.select("doc_id", "part", "h"), by_hash.where("texts = 1").select("h", "least", "n"), "h")
    found = alone.where("least < doc_id").select("doc_id", "part", "h")
    collided = by_hash.where("texts > 1").select("h")
    if collided.isEmpty():
        return found
    there = first.join(small(collided, 64), "h", "left_semi").select(F.col("h").alias("h2"), F.col("text").alias("text2"), "least")
    here = texts.join(small(collided, 64), "h", "left_semi")
    semi = here.join(there, (here["h"] == there["h2"]) & (here["text"] == there["text2"]) & (there["least"] < here["doc_id"]), "left_semi")
    return found.unionByName(semi.select("doc_id", "part", "h"))


def combinations(rows: DataFrame, copied: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and combination of failed filters: documents, those of quality 1 and toxic ones."""
    ids = rows.select("doc_id", "part", "h", "bits", F.lit(1).alias("one")).unionByName(copied.select("doc_id", "part", "h", F.lit(COPY).cast("long").alias("bits"), F.lit(0).alias("one")))
    whole = ids.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("one").alias("n"))
    # At most 32 rows of an id and part go on, however often it is repeated.
    whole = whole.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    each = whole.join(known, "doc_id", "left")
    of = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return stash(each.groupBy("part", "bits").agg(F.sum("n").alias("n"), of("good"), of("toxic")), "combinations")


def interactions(found: DataFrame, filters: str = FILTERS) -> DataFrame:
    """:func:`combinations` to a row per part, order of the filters and step."""
    orders = ["".join(p) for p in permutations(filters)]
    steps = [(o, i + 1, sum(1 << filters.index(x) for x in o[:i]), 1 << filters.index(x)) for o in orders for i, x in enumerate(o)]
    plan = F.from_json(F.lit(json.dumps([dict(zip(STEP, s, strict=True)) for s in steps])), "array<struct<filter_order: string, step: int, before: long, own: long>>")
    each = found.select("part", "bits", *COUNTS, F.explode(plan).alias("s")).select("part", "bits", *COUNTS, "s.*")
    failed, earlier = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    total = lambda when, c="n": F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    lost = failed & ~earlier
    share = F.when(failed, F.col("n") * F.lit(len(orders)) / F.bit_count("bits")).otherwise(0)
    return each.groupBy("part", "filter_order", "step").agg(
        total(~failed & ~earlier).alias("kept"), total(lost).alias("removed"), total(failed & earlier).alias("redundant"), total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(lost, "good").alias("good_lost"), total(lost, "toxic").alias("toxic_lost"), F.sum(share).cast("long").alias("shapley"),
    )


def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = judged(docs)
    return interactions(combinations(rows, copies(rows, docs), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
f AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
w AS (SELECT d.*, least, regexp_extract_all(d.text, '[^\x20\x09-\x0D]+') AS ws FROM d JOIN f USING (text)),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
b AS (SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
      {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws), 'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
       'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(least < doc_id, false)} AS x FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, x.A::INT AS "A", x.B::INT AS "B", x.C::INT AS "C", x.D::INT AS "D", x.E::INT AS "E", count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM b GROUP BY ALL),
k(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT k1.c || k2.c || k3.c || k4.c || k5.c AS filter_order FROM k k1, k k2, k k3, k k4, k k5 WHERE len(list_distinct([k1.c, k2.c, k3.c, k4.c, k5.c])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
m AS (SELECT part, filter_order, step, n, good, toxic, list_filter([CASE WHEN "A" = 1 THEN 'A' END, CASE WHEN "B" = 1 THEN 'B' END, CASE WHEN "C" = 1 THEN 'C' END, CASE WHEN "D" = 1 THEN 'D' END, CASE WHEN "E" = 1 THEN 'E' END], lambda c: c IS NOT NULL) AS fails, filter_order[step] AS own, filter_order[:step - 1] AS before FROM g, s),
e AS (SELECT *, list_contains(fails, own) AS failed, len(list_filter(fails, lambda c: contains(before, c))) > 0 AS earlier FROM m),
r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT failed AND NOT earlier), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (failed AND NOT earlier), 0)::BIGINT AS removed,
      coalesce(sum(n) FILTER (failed AND earlier), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (failed AND len(fails) = 1), 0)::BIGINT AS unique_fails,
      coalesce(sum(good) FILTER (failed AND NOT earlier), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (failed AND NOT earlier), 0)::BIGINT AS toxic_lost FROM e GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""
