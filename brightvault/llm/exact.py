"""Exact duplicates by an extendible-hash index on shared files.

The index holds each 64-bit hash of a normalised text once, with the number of its
rows.  A bucket is a range of hashes, told by leading bits.  The directory starts
with one bucket and doubles while a bucket holds more than ``capacity`` hashes,
which splits that bucket by one more bit, up to ``depth`` bits.  Runs of buckets
are dealt to owner tasks, each of which writes its key range as a file of the index,
in the order of bucket and hash.

A hash with one row is settled by the index alone.  The rows of the others form
chains: their texts are fetched, copies are merged where they lie, and what is left
goes to the owner of the bucket, which compares the bytes: equal bytes are one entry
of the chain, a collision makes one more.  A group that holds a third of all rows
costs its owner one entry for each of ``LANES`` lanes.  All of it is DataFrame work.

Defined cases: a null text is an empty one; null doc_ids sort last among equals;
of rows that repeat id and text exactly one is kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightvault.llm.common import BLANKS, facts_of, met, stash, table

#: Hashes of a bucket, and bits of the directory at most (2^20 cells are 40 MB); buckets of an owner.
CAPACITY, DEPTH, OWNED = 8_192, 20, 4
#: Lanes in which the copies of a chain are merged before they go to its owner.
LANES = 16


def cell(bits: int) -> Column:
    """The leading bits of a hash."""
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def directory(hashes: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> tuple[DataFrame, int]:
    """Cells with their bucket (``bits``, ``bucket``, ``first``, its first cell) and ``owner``; and the bits of a cell.

    The directory doubles while a bucket is overfull; a cell belongs to the shortest prefix
    that isn't.  An owner has a run of buckets with OWNED hashes or so.
    """
    bits = 0
    while bits < depth and not hashes.groupBy(cell(bits).alias("bucket")).count().where(F.col("count") > capacity).isEmpty():
        bits += 1
    cells = stash(hashes.groupBy(cell(bits).alias("cell")).count(), "cells")
    levels = cells.select("cell", "count", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("bits"))
    levels = levels.withColumn("bucket", F.expr(f"shiftright(cell, {bits} - bits)"))
    full = levels.groupBy("bits", "bucket").agg(F.sum("count").alias("n"))
    fits = levels.join(full, ["bits", "bucket"]).where((F.col("n") <= capacity) | (F.col("bits") == bits))
    found = fits.groupBy("cell").agg(F.min(F.struct("bits", "bucket")).alias("b"), F.first("count").alias("count"))
    found = found.select("cell", "b.bits", "b.bucket", F.expr(f"shiftleft(b.bucket, {bits} - b.bits)").alias("first"), "count")
    # 2^depth rows at most in this window.
    ahead = Window.orderBy("first").rangeBetween(Window.unboundedPreceding, -1)
    owner = F.floor(F.coalesce(F.sum("count").over(ahead), F.lit(0)) / (OWNED * capacity)).cast("int")
    return stash(found.withColumn("owner", owner).drop("count"), "directory"), bits


def index(keys: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """The index files: owner, bits, bucket, first (the bucket's first cell), h, n_rows (that have the hash).

    A task owns the key ranges of its file: no bucket lies in two files.
    """
    hashes = stash(keys.groupBy("h").agg(F.count(F.lit(1)).alias("n_rows")), "hashes")
    cells, bits = directory(hashes, capacity, depth)
    placed = hashes.withColumn("cell", cell(bits)).join(F.broadcast(cells), "cell")  # 2^depth rows at most
    placed = placed.select("owner", "bits", "bucket", "first", "h", "n_rows")
    return stash(placed.repartition("owner").sortWithinPartitions("first", "h"), "index")


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """``doc_id, text`` to doc_id, keep_id, group_size, kept, text_sha256, n_points."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.translate(text, BLANKS, "").alias("norm"))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_points"), F.xxhash64("norm").alias("h"), "norm")
    keys = stash(rows.select("doc_id", "n_points", "h", F.sha2("norm", 256).alias("sha")), "keys")
    files = index(keys, capacity, depth)
    chained = stash(files.where("n_rows > 1").select("h", "owner", F.col("n_rows").alias("n")), "chained")
    alone = met(keys, chained, "h", "left_anti").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "n_points")

    members = met(rows, chained, "h").select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "n_points", "h", "owner", F.sha2("norm", 256).alias("sha"), "norm")
    members = stash(members, "members")
    order = F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row_no").alias("row"))
    merged = members.groupBy("owner", "h", "norm", F.pmod("row_no", F.lit(LANES)).alias("lane")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best"), F.first("sha").alias("sha"))
    entries = merged.repartition("owner").groupBy("owner", "h", "norm").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"), F.first("sha").alias("sha"))
    link = F.concat_ws(":", "h", "sha")
    entries = stash(entries.select(link.alias("link"), "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), F.col("group_size").alias("n")), "entries")
    found = facts_of(members.drop("norm").withColumn("link", link), entries, "link")
    found = found.select("doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), "n_points")
    return alone.unionByName(found)


def op2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""
