"""Boilerplate lines, found by the number of distinct sites that print them.

A line's sites and the texts that hold it go into two HyperLogLog sketches per
line hash, merged by aggregation.  A line goes if it stands on ``sites`` sites
or more, in as many different texts: copies of one document are one text, so
that a document that is copied everywhere doesn't lose its lines.  What stands
around a line doesn't count.  Lines whose estimates are
within ``band`` of the threshold get exact distinct counts instead.  Lines
under ``words`` words stay: one by default, so only blank lines do.

Lines are compared without the white space around them.  The hashes of the lines
that go are few beside the texts: up to ``BAD`` of them are sent to all tasks and
texts are cut where they lie; beyond that each text is joined with a list of its own.

Defined cases: a null text stays null; a null source is a site of its own;
lines without a word always stay; a text that was boilerplate only becomes
empty; repeated rows are changed alike; an empty table gives no rows; the count
of removed lines takes the first free name of n_removed, n_removed_, ...
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm import common
from brightvault.llm.common import BLANKS, WORD, small, small_batches, stash, table, unused

#: Sites and texts of a boilerplate line; words that it has at least; where estimates are near the threshold; size of a sketch.
SITES, WORDS, BAND, LOG_K = 10, 1, 0.2, 10
#: Hashes of boilerplate lines (8 bytes each) that are sent to all tasks.
BAD = 2_000_000
#: Lanes of a text with many copies, where lists are joined.
LANES = 64


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def placed_lines(docs: DataFrame, words: int) -> DataFrame:
    """A row per line of enough words: text key, site, line hash."""
    cut = docs.select(
        F.md5("text").alias("text_key"),
        F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source"))).alias("site"),
        F.transform(F.split("text", "\n"), bare).alias("lines"),
    ).where("text_key IS NOT NULL")
    rows = cut.select("text_key", "site", F.explode("lines").alias("line")).where(F.regexp_count("line", F.lit(WORD)) >= words)
    return rows.select("text_key", "site", F.xxhash64("line").alias("h"))


def boilerplate(lines: DataFrame, sites: int = SITES, band: float = BAND, log_k: int = LOG_K) -> DataFrame:
    """Hashes ``h`` of lines on ``sites`` sites in ``sites`` texts."""
    sketch = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(log_k)))
    about = lines.groupBy("h").agg(sketch("site").alias("n_sites"), sketch("text_key").alias("n_texts"))
    low, high = sites * (1 - band), sites * (1 + band)
    about = stash(about.where((F.col("n_sites") >= low) & (F.col("n_texts") >= low)).withColumn("sure", (F.col("n_sites") > high) & (F.col("n_texts") > high)), "spread")
    near = about.where("NOT sure").select("h")
    exact = lines.join(small(near), "h", "left_semi").groupBy("h").agg(F.count_distinct("site").alias("s"), F.count_distinct("text_key").alias("t"))
    return about.where("sure").select("h").unionByName(exact.where((F.col("s") >= sites) & (F.col("t") >= sites)).select("h"))


def cut_in_place(docs: DataFrame, bad: DataFrame, removed: str) -> DataFrame:
    """Each text cut by the broadcast hashes, which Spark and the worker compute alike (XXH64, seed 42)."""
    small_batches(docs.sparkSession)
    hashes = np.append(np.sort(bad.select("h").toArrow().column("h").to_numpy()), np.iinfo(np.int64).max)  # BAD at most, and an end
    last = bool((hashes[:-1] == hashes[-1]).any())  # a line may have the end's hash
    sent = docs.sparkSession.sparkContext.broadcast(hashes)
    blanks = BLANKS.encode()

    @F.pandas_udf("text string, gone long")
    def cut(texts: pd.Series) -> pd.DataFrame:
        known, out = sent.value, []
        for text in texts:
            lines = [] if text is None else text.split("\n")
            h = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "replace").strip(blanks), 42) for x in lines], np.uint64).view(np.int64)
            gone = (known[np.searchsorted(known, h)] == h) & (last | (h != known[-1]))
            kept = [x for x, bad in zip(lines, gone.tolist(), strict=True) if not bad]
            out.append((text if len(kept) == len(lines) else "\n".join(kept), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "gone"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wide = docs.select(row.alias("row"), cut("text").alias("cut"))
    return wide.select(*[F.col("cut.text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns], F.col("cut.gone").alias(removed))


def cut_by_lists(docs: DataFrame, bad: DataFrame, lines: DataFrame, removed: str) -> DataFrame:
    """Each text joined with the list of its own lines that go."""
    lists = lines.select("text_key", "h").join(bad, "h", "left_semi").groupBy("text_key").agg(F.collect_set("h").alias("bad"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wide = docs.select(row.alias("row"), F.md5("text").alias("text_key"))
    # A text with many copies, and the null text, meet their list in several lanes.
    many = stash(wide.groupBy("text_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common.FEW).select("text_key", F.lit(LANES).alias("lanes")), "many")
    of_row = F.pmod(F.monotonically_increasing_id(), F.coalesce("lanes", F.lit(1))).cast("int").alias("lane")
    wide = wide.join(small(many, 40), F.coalesce(wide["text_key"], F.lit("")) == F.coalesce(many["text_key"], F.lit("")), "left").select("row", F.coalesce(wide["text_key"], F.lit("")).alias("text_key"), of_row)
    lists = lists.join(small(many, 40), "text_key", "left").select("text_key", "bad", F.explode(F.sequence(F.lit(0), F.coalesce("lanes", F.lit(1)) - 1)).alias("lane"))
    wide = wide.join(lists, ["text_key", "lane"], "left")
    parts = F.split("row.text", "\n")
    good = F.filter(parts, lambda x: ~F.array_contains("bad", F.xxhash64(bare(x))))
    cut = F.col("bad").isNotNull()
    wide = wide.select("row", F.when(cut, good).alias("good"), F.when(cut, F.size(parts)).otherwise(0).alias("n"), cut.alias("cut"))
    text = F.when(F.col("cut"), F.array_join("good", "\n")).otherwise(F.col("row.text"))
    gone = F.when(F.col("cut"), F.col("n") - F.size("good")).otherwise(0).cast("long")
    return wide.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns], gone.alias(removed))


def without_boilerplate(docs: DataFrame, sites: int = SITES, words: int = WORDS) -> DataFrame:
    """``docs`` (with text and source) with its texts cut, and the count of lines that went."""
    removed = unused("n_removed", docs.columns)
    lines = stash(placed_lines(docs.select("text", "source"), words), "lines")
    bad = stash(boilerplate(lines, sites), "boilerplate")
    return cut_in_place(docs, bad, removed) if bad.count() <= BAD else cut_by_lists(docs, bad, lines, removed)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the texts without boilerplate, n_chars counted anew."""
    out = without_boilerplate(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT rid, md5(text) AS whole, coalesce('+' || source, '-') AS site, x.p AS p, x.line AS line, x.i AS i
      FROM (SELECT rid, source, text, unnest([{'p': p, 'line': trim(p, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'i': j} FOR p, j IN parts]) AS x FROM d)),
b AS (SELECT line FROM l WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 1 GROUP BY line HAVING count(DISTINCT site) >= 10 AND count(DISTINCT whole) >= 10),
k AS (SELECT rid, string_agg(p, chr(10) ORDER BY i) AS text, count(*) AS n FROM l WHERE line NOT IN (SELECT line FROM b) GROUP BY rid)
SELECT doc_id, source, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(len(parts) - coalesce(n, 0), 0)::BIGINT AS n_removed FROM d LEFT JOIN k USING (rid)
"""
