"""SimHash against brute force over all pairs of fingerprints."""

import random

import numpy as np
import pytest
import xxhash

from brightvault.llm import simhash


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, min(len(words), 1)))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def slow_components(rows):
    """rows: (doc_id, fingerprint) to {fingerprint: least id that can be reached}."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for d, p in rows:
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return {p: least.get(find(p)) for p in prints}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    prints = [(d, slow_print(t)) for d, t in rows]
    comp = slow_components(prints)
    assert got == sorted(((d, p, comp[p]) for d, p in prints), key=str)


def test_edge_cases(spark):
    long = " ".join(random.Random(1).choice("abcdefgh") * 3 for _ in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two THREE"), (5, "one\x0btwo three"), (6, "É a b c d"), (6, "É a b c d"), (None, "é a b c d"), (None, "x y z w v"), (7, long), (8, long + " tail")]
    check(spark, rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


@pytest.mark.parametrize("shard", [3, 4096])
def test_links_join_the_same_components(spark, shard):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {s for s in seeds}
    for s in seeds:
        for _ in range(12):
            p = s
            for _ in range(rng.randint(1, 6)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    signed = [(int(np.array([p], np.uint64).view(np.int64)[0]),) for _, p in rows]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), shard=shard)
    from brightvault.llm.graph import components

    root = {r.node & (2**64 - 1): r.root for r in components(edges).collect()}
    want = slow_components(rows)
    groups = {}
    for i, p in rows:
        groups.setdefault(root.get(p, ("alone", p)), set()).add(want[p])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_trees_serve_all_batches(spark, monkeypatch):
    """Small trees and batches of few rows: shards whose members and queries span many of both."""
    import pandas as pd

    rng = random.Random(4)
    rows = []
    for shard in range(6):
        for part in range(2):
            base = rng.getrandbits(64)
            fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(rng.choice([1, 5, 40]))})
            asks = [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(rng.choice([0, 3, 60]))]
            rows += [(shard, part, False, f) for f in fps] + [(shard, part, True, f) for f in asks]
    table = pd.DataFrame(rows, columns=["shard", "part", "query", "fp"])
    table["fp"] = np.array(table["fp"].tolist(), np.uint64).view(np.int64)

    def components_of(size):
        root = {}

        def find(p):
            while root.setdefault(p, p) != p:
                p = root[p]
            return p

        for out in simhash.shard_links(4)(iter([table[i : i + size].reset_index(drop=True) for i in range(0, len(table), size)])):
            for a, b in out.itertuples(index=False):
                assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
                root[find(a)] = find(b)
        groups = {}
        for p in root:
            groups.setdefault(find(p), set()).add(p)
        return {frozenset(g) for g in groups.values()}

    want = components_of(10**6)
    assert all(components_of(n) == want for n in (1, 3, 7, 50))


def test_one_of_each(spark):
    rows = [(1, "a b c d e f g", 9), (2, "a b c d e f g", 8), (2, "a b c d e f g", 7), (3, "q r s t u v", 1), (3, "q r s t u v", 1), (None, "q r s t u v", 2), (4, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long").selectExpr("*", "'x' AS __h", "'y' AS h", "'z' AS row", "1 AS id")
    got = simhash.one_of_each(spark, docs, "")
    assert got.columns == docs.columns and got.where("__h = 'x' AND h = 'y'").count() == 3
    got = [(r.doc_id, r.fp) for r in got.collect()]
    assert sorted(got) == [(1, 9), (3, 1), (4, 3)]
