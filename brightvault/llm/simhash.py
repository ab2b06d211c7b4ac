"""SimHash near-duplicates: fingerprints, and the links between them by BK-trees.

Two fingerprints with at most four differing bits agree on two of six bit
blocks at least.  Each of the 15 pairs of blocks cuts the fingerprints into
shards by the value of those 21 or so bits; a shard is a BK-tree, whose
children are keyed by their Hamming distance to the parent.  A shard's tree
goes to every block of queries that has the same key, and a query follows
only edges within the radius of its own distance.  The members of shards beyond
``SHARD`` are cut anew, by seven blocks of which such pairs agree on three.  What is still beyond it
is split, and each part's tree meets the whole shard's
queries in blocks, so that a tree has a fixed size whatever the input.

Documents with equal fingerprints are one node.  A shard gives a spanning
forest of its links instead of all pairs; components are joined by Spark.

Defined cases: a null, empty or blank text has fingerprint zero and links like
any other; a null doc_id keeps its row, and counts for component_id only if no
document of its component has an id (then component_id is null); repeated rows
come out as often as they went in; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import facts_of, met, small, small_batches, stash, table
from brightvault.llm.graph import components

SEED, RADIUS, SHINGLE = 42, 4, 4
#: (shift, width) of the six bit blocks.
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: The same of seven, for the members of crowded shards.
SEVENS = ((0, 10), (10, 9), (19, 9), (28, 9), (37, 9), (46, 9), (55, 9))
#: Members of a tree. Queries come in blocks of QUERIES.
SHARD, QUERIES = 4096, 2048


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``width`` words, lower-cased in A-Z, repeats included."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    flat, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([h(flat, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.fromiter((h(flat[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, len(words) - width + 1)


def fingerprint(text: str | None) -> int:
    """The SimHash as a signed 64-bit number."""
    h = shingle_hashes(text)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 16384):
        ones += np.unpackbits(h[i : i + 16384].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprint_col(text: Column | str) -> Column:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return prints(text)


class Forest:
    """BK-trees over many shards at once, held as sorted arrays: (parent, distance) -> child."""

    def __init__(self, shard: np.ndarray, prints: np.ndarray):
        self.prints = prints
        self.shards, first, inv = np.unique(shard, return_index=True, return_inverse=True)
        self.roots = first
        edges, at = [], first[inv]
        left = np.flatnonzero(at != np.arange(len(prints)))
        while len(left):  # a level of all trees
            key = at[left] * 65 + np.bitwise_count(prints[left] ^ prints[at[left]])
            keys, first, inv = np.unique(key, return_index=True, return_inverse=True)
            edges.append((keys, left[first]))
            child = left[first][inv]
            at[left] = child
            left = left[child != left]
        self.keys, self.child = (np.concatenate(x) for x in zip(*edges, strict=True)) if edges else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.child = self.keys[order], self.child[order]

    def near(self, shard: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) index arrays of what is within the radius."""
        at = np.searchsorted(self.shards, shard)
        query = np.arange(len(prints))
        node = self.roots[at]
        while len(query):
            gap = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
            hit = gap <= radius
            if hit.any():
                yield query[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(gap - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(gap + radius, 64), "right")
            n = hi - lo
            query, pos = np.repeat(query, n), np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            node = self.child[pos]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: each node points at the least node that it reaches."""
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not (label == (up := label[label])).all():
            label = up


def asked(forest: Forest, group: np.ndarray, fp: np.ndarray, member: np.ndarray, radius: int) -> pd.DataFrame:
    """Links that join each of ``fp`` with what it reaches in its group's tree; ``member`` places the trees' members in ``fp``."""
    label = np.arange(len(fp))
    asks = np.flatnonzero(np.isin(group, forest.shards))
    for i in range(0, len(asks), QUERIES):
        block = asks[i : i + QUERIES]
        for q, m in forest.near(group[block], fp[block], radius):
            label = joined(label, block[q], member[m])
    far = fp != fp[label]
    return pd.DataFrame({"a": fp[far].view(np.int64), "b": fp[label][far].view(np.int64)})


def shard_links(radius: int):
    """A task's work: rows (shard, part, query, fp) in that order to links (a, b).

    A shard's members come before its queries.  Members of the last shard of a batch wait until
    all are there; its tree then serves all batches of queries that follow.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, key, tree = None, None, None
        for rows in batches:
            if tree is not None:
                ahead = ((rows["shard"] == key[0]) & (rows["part"] == key[1])).to_numpy()
                fp = rows["fp"].to_numpy(np.int64).view(np.uint64)[ahead]
                both = np.concatenate((tree.prints, fp))
                yield asked(tree, np.zeros(len(both), np.int64), both, np.arange(len(tree.prints)), radius)
                rows = rows[~ahead]
                if not len(rows):
                    continue
            rows = rows if waiting is None else pd.concat([waiting, rows], ignore_index=True)
            key = (rows["shard"].iloc[-1], rows["part"].iloc[-1])
            last = ((rows["shard"] == key[0]) & (rows["part"] == key[1])).to_numpy()
            member = ~rows["query"].to_numpy(bool)
            waiting = tree = None
            if member[last].all():
                waiting, rows, member = rows[last], rows[~last], member[~last]
            elif member[last].any():
                tree = Forest(np.zeros(int((last & member).sum()), np.int64), rows["fp"].to_numpy(np.int64).view(np.uint64)[last & member])
            if len(rows):
                yield whole(rows, member)
        if waiting is not None:
            yield whole(waiting, np.ones(len(waiting), bool))

    def whole(rows: pd.DataFrame, member: np.ndarray) -> pd.DataFrame:
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        group = np.cumsum((rows["shard"].diff().ne(0) | rows["part"].diff().ne(0)).to_numpy())
        place = np.flatnonzero(member)
        return asked(Forest(group[place], fp[place]), group, fp, place, radius)

    return run


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Distinct ``fp`` to links (a, b) that join what is reachable within ``radius`` bits."""
    if radius > len(BLOCKS) - 2:
        raise ValueError("two equal blocks of six are certain for a radius of four at most")
    bits = lambda blocks: [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).cast("long") for s, w in blocks]
    two, three = bits(BLOCKS), bits(SEVENS)
    keys = [F.lit(n << 24) + F.shiftleft(two[i], 12) + two[j] for n, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    finer = [F.lit((16 + n) << 30) + F.shiftleft(three[i], 20) + F.shiftleft(three[j], 10) + three[k] for n, (i, j, k) in enumerate(combinations(range(len(SEVENS)), 3))]
    by = lambda of, keys: of.select("fp", F.explode(F.array(*[k.cast("long") for k in keys])).alias("shard"))
    sizes = lambda of: of.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard)
    dealt = by(prints, keys)
    crowded = stash(sizes(dealt), "crowded")
    if not crowded.isEmpty():
        again = stash(met(dealt, crowded, "shard").select("fp").distinct(), "again")
        dealt = met(dealt, crowded, "shard", "left_anti").unionByName(by(again, finer))
    hot = stash(sizes(dealt).select("shard", F.ceil(F.col("n") / shard).cast("int").alias("parts")), "hot")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    rows = (
        dealt.join(small(hot), "shard", "left")
        .withColumn("own", own)
        .select("shard", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("part"))
        .select("shard", "part", (F.col("part") != F.col("own")).alias("query"), "fp")
    )
    return rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "query").mapInPandas(shard_links(radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, extra: list[str] | None = None) -> DataFrame:
    """``doc_id, text`` (and ``extra`` columns) to ``doc_id, extra, fp, root, component_id``.

    ``root`` is a fingerprint that stands for the component.
    """
    small_batches(docs.sparkSession)
    kept = ["doc_id", *(extra or [])]
    found = stash(docs.select(*kept, fingerprint_col("text").alias("fp")), "prints")
    least = found.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"))
    tied = components(links(least.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = stash(least.join(tied, "fp", "left").select("fp", "least", "docs", F.coalesce("root", "fp").alias("root")), "roots")
    ids = stash(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "components")
    named = stash(facts_of(rooted, ids, "root").select("fp", "root", "component_id", F.col("docs").alias("n")), "named")
    return facts_of(found, named, "fp").select(*kept, "fp", "root", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the row with the least doc_id (then least text hash) stays.

    Rows without an id stay only where none of their component has one; of rows
    that repeat both id and text, one stays.  Texts are not shuffled while the
    ids to drop can be broadcast.
    """
    found = stash(near_duplicates(docs.select("doc_id", "text", F.xxhash64("text").alias("h")), extra=["h"]), "members")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("h").alias("h"))
    best = stash(found.groupBy("root").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")), "best")
    judged = facts_of(found, best, "root").select(F.col("doc_id").alias("id"), "h", (order == F.col("best")).alias("stays"))
    judged = stash(judged.groupBy("id", "h", "stays").count(), "judged")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("h"))

    def those(keys: DataFrame, how: str, of: DataFrame) -> DataFrame:
        keys = small(stash(keys.select("id", F.col("h").alias("k")), "keys"))
        return of.join(keys, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("k")), how)

    kept = those(judged.where("NOT stays"), "left_anti", wide)
    again = judged.where("stays AND count > 1")
    if not again.isEmpty():
        kept = those(again, "left_anti", kept).unionByName(those(again, "left_semi", kept).dropDuplicates(["doc_id", "h"]))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
