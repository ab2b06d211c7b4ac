"""How far the sources of a language lie apart, and by which terms.

Every partition folds whole documents into stripes: for each term of a language its
number of documents and its occurrences by source.  A task whose stripes grow beyond
``SPILL`` entries sends them off and starts anew.  Stripes are merged by key, and terms
in fewer than ``MIN_DOCS`` documents of the language go.

Shares are whole numbers, smoothed by one occurrence a term: p = 1 + floor(10^9 (n + 1) / (N + V)).
The divergence of p from q is floor((p - q)^2 / q).  Against its language, a source
shows its ``TOP`` terms.  Against another source it has the sum over all V terms.  That
sum needs no row for a term that neither has: with p0 the share of a term that a source lacks,

    sum = V f(p0, q0) + [terms of the one] f(p, q0) - f(p0, q0) + [terms of the other] f(p0, q) - f(p0, q0)
          + [terms of both] f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0).

The brackets on one source follow from how many of its terms have which share; the last
one is folded from the merged stripes into a table of sources by sources, as large as its result.

Defined cases: null text, lang and source are ''; a text without terms still shows its source;
a language without kept terms gives pairs of value 0 and no terms; repeated rows count each;
equal values rank by the bytes of the item; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightvault.llm.common import facts_of, small_batches, stash, table

MIN_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
#: Entries of the stripes that a task holds (about 150 bytes each), and sources that a task's table has on a side.
SPILL, SIDE = 400_000, 1_024
#: Bytes of a term as they are, A-Z as a-z; all others are blanks.
LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
STRIPE = "lang string, term string, source string, n long, docs long"


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(LETTERS).split()


def folded(docs: DataFrame, spill: int = SPILL) -> DataFrame:
    """``lang, source, text`` to stripes, an entry a row; the term '' stands for the source itself."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stripes: dict[tuple[str, str], dict[bytes, list[int]]] = {}  # by (lang, source): term to occurrences and documents
        held = 0

        def sent() -> pd.DataFrame:
            cols: dict[str, list] = {c: [] for c in ("lang", "term", "source", "n", "docs")}
            for (lang, source), of in stripes.items():
                cols["lang"] += [lang] * len(of)
                cols["source"] += [source] * len(of)
                cols["term"] += [t.decode("utf-8", "replace") for t in of]
                cols["n"] += [v[0] for v in of.values()]
                cols["docs"] += [v[1] for v in of.values()]
            return pd.DataFrame(cols)

        for batch in batches:
            for lang, source, text in batch.itertuples(index=False):
                mine = stripes.setdefault((lang, source), {b"": [0, 0]})
                before = len(mine)
                for t, n in Counter(terms(text)).items():
                    at = mine.get(t)
                    if at is None:
                        mine[t] = [n, 1]
                    else:
                        at[0] += n
                        at[1] += 1
                held += len(mine) - before
                if held >= spill:
                    yield sent()
                    stripes, held = {}, 0
        if stripes:
            yield sent()

    small_batches(docs.sparkSession)
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text")).mapInPandas(fold, STRIPE)


def counted(stripes: DataFrame) -> DataFrame:
    """The stripes merged by language, term and source, written."""
    return stash(stripes.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "stripes")


def share(n: str, of: str) -> str:
    return f"CAST(1 + CAST({UNIT} AS DECIMAL(38, 0)) * ({n} + 1) DIV ({of}) AS BIGINT)"


def f(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) DIV {q}"


def rated(counts: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """Terms of sources (lang, term, source, p, p0, q) and the sources (lang, source, v, p0), both written.

    p is the term's share in the source, q in the language, and p0 that of a term the source lacks.
    """
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("stripe"))
    kept = stash(kept.where(F.col("docs") >= min_docs).drop("docs"), "kept")
    each = kept.select("lang", "term", "total", F.explode("stripe").alias("s")).select("lang", "term", "total", F.col("s.source").alias("source"), F.col("s.n").alias("c"))
    sums = each.groupBy("lang", "source").agg(F.sum("c").alias("size"), F.count(F.lit(1)).alias("n"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    groups = counts.where("term = ''").select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all", F.lit(0)).alias("all"))
    groups = stash(groups.withColumn("p0", F.expr(f"CASE WHEN v > 0 THEN {share('0', 'size + v')} END")), "groups")
    key = F.struct("lang", "source").alias("key")
    met = facts_of(each.select("*", key), groups.select(key, "size", "v", "all", "p0", "n"), "key")
    met = met.select("lang", "term", "source", F.expr(share("c", "size + v")).alias("p"), "p0", F.expr(share("total", "all + v")).alias("q"))
    return stash(met, "rated"), groups.select("lang", "source", "v", "p0")


def both(found: DataFrame, side: int = SIDE) -> DataFrame:
    """lang, a, b, value: what the terms that both sources have add to the divergence of a from b."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: dict[tuple[str, str], int] = {}
        sums = np.zeros((side, side), np.int64)

        def sent() -> pd.DataFrame:
            names = list(at)
            rows = [(*names[i], names[j][1], int(sums[i, j])) for i, j in np.argwhere(sums) if i != j]
            return pd.DataFrame(rows, columns=["lang", "a", "b", "value"])

        def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            d = p[:, None] - q[None, :]
            return d * d // q[None, :]

        for batch in batches:
            for lang, sources, p, p0 in batch.itertuples(index=False):
                keys = [(lang, s) for s in sources]
                blocks = [slice(i, i + side // 2) for i in range(0, len(keys), side // 2)]
                for x in blocks:
                    for y in blocks:
                        mine = dict.fromkeys(keys[x] + keys[y])
                        if len(at) + sum(k not in at for k in mine) > side:
                            yield sent()
                            at.clear()
                            sums[:] = 0
                        for k in mine:
                            at.setdefault(k, len(at))
                        i, j = [at[k] for k in keys[x]], [at[k] for k in keys[y]]
                        sums[np.ix_(i, j)] += far(p[x], p[y]) - far(p[x], p0[y]) - far(p0[x], p[y]) + far(p0[x], p0[y])
        yield sent()

    stripes = found.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("stripe"))
    return stripes.where(F.size("stripe") > 1).select("lang", "stripe.source", "stripe.p", "stripe.p0").mapInPandas(fold, "lang string, a string, b string, value long")


def pairs(found: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the divergence of each source from each other one of its language."""
    exact = lambda e: F.expr(e).cast("decimal(38, 0)").alias("value")
    a, b = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("pa"), "v"), groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    other = stash(a.join(b, "lang").where("a <> b"), "pairs")  # the pairs that the result lists
    shares = found.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    one = shares.withColumnRenamed("source", "a").join(other, ["lang", "a"]).select("lang", "a", "b", exact(f"m * ({f('p', 'pb')} - {f('pa', 'pb')})"))
    two = shares.withColumnRenamed("source", "b").join(other, ["lang", "b"]).select("lang", "a", "b", exact(f"m * ({f('pa', 'p')} - {f('pa', 'pb')})"))
    none = other.select("lang", "a", "b", exact(f"coalesce(v * ({f('pa', 'pb')}), 0)"))
    rows = none.unionByName(one).unionByName(two).unionByName(both(found).withColumn("value", F.col("value").cast("decimal(38, 0)")))
    return rows.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").cast("long").alias("value"))


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, spill: int = SPILL) -> DataFrame:
    """``lang, source, text`` to lang, source, part, item, value, rank."""
    found, groups = rated(counted(folded(docs, spill)), min_docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    told = found.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(f("p", "q")).alias("value"))
    # Spark keeps the first ``top`` of each group before it shuffles.
    told = told.withColumn("rank", rank).where(F.col("rank") <= top)
    apart = pairs(found, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", rank)
    return told.unionByName(apart)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT lang, source, rid, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
n AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS size FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS size FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (SELECT s.lang, s.source, k.term, coalesce(n.c, 0) AS c, 1 + 1000000000 * (coalesce(n.c, 0) + 1) // (s.size + v.v) AS p, 1 + 1000000000 * (k.total + 1) // (v.size + v.v) AS q
      FROM s JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON s.lang = n.lang AND s.source = n.source AND k.term = n.term),
a AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
o AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0)::BIGINT AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o QUALIFY part = 'pair' OR rank <= 200
"""
