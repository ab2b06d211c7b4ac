"""A text, a hub and a component that hold a third of all rows, with nothing small enough for a broadcast."""

import collections
import hashlib

import pytest

from brightvault.llm import common, exact, graph, lines, simhash


@pytest.fixture
def tight(monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(common, "FEW", 4)


def test_exact_groups_of_a_hot_text(spark, tight):
    rows = [(i, "hot text " * (1 + i % 2)) for i in range(0, 300, 3)] + [(i, f"own {i}") for i in range(1, 300, 3)] + [(i, f"twice {i // 6}") for i in range(2, 300, 3)] + [(None, "hot text "), (7, None)]
    got = collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), capacity=8, depth=8).collect())
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups["".join((t or "").split())].append((-len(t or ""), d is None, d or 0, d))
    want = collections.Counter()
    for norm, members in groups.items():
        members.sort()
        for i, m in enumerate(members):
            want[m[3], members[0][3], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert got == want


def plain_components(edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    groups = collections.defaultdict(set)
    for n, root in label.items():
        groups[root].add(n)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_components_of_a_hub_and_of_a_long_chain(spark, tight):
    edges = [(0, i) for i in range(1, 150)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000 + 2 * i, 2001 + 2 * i) for i in range(60)] + [(149, 1000), (5, 5), (3, 0)]
    got = collections.defaultdict(set)
    for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect():
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == plain_components([e for e in edges if e[0] != e[1]])


def test_near_duplicates_of_a_crowd(spark, tight):
    """Fingerprints that agree on most blocks crowd all shards; they are cut anew and lose no link."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(0, 400, 7)] + ["far " + " ".join(f"f{j}{i}" for i in range(100)) for j in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500 + i, texts[0]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {t: simhash.fingerprint(t) for t in texts}
    edges = [(a, b) for a in set(prints.values()) for b in set(prints.values()) if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    of = {f: min(g) for g in plain_components(edges) for f in g} if edges else {}
    least = collections.defaultdict(lambda: 10**9)
    for d, t in rows:
        root = of.get(prints[t], prints[t])
        least[root] = min(least[root], d)
    links = simhash.components(simhash.links(docs.select(simhash.fingerprint_col("text").alias("fp")).distinct(), shard=4))
    got = collections.defaultdict(set)
    for r in links.collect():
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == plain_components(edges) and edges
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == {d: least[of.get(prints[t], prints[t])] for d, t in rows}


def test_copies_of_a_text_are_cut_in_lanes(spark, tight, monkeypatch):
    monkeypatch.setattr(lines, "BAD", 0)
    rows = [(i, f"s{i}", f"own line {i}\ncookie notice\n") for i in range(12)] + [(i, "s0", "copied text here\ncookie notice") for i in range(20, 60)] + [(i, "s1", None) for i in range(60, 90)] + [(90, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.without_boilerplate(docs).collect()}
    want = {d: (None if t is None else "\n".join(x for x in t.split("\n") if x != "cookie notice"), int("cookie" in (t or ""))) for d, _, t in rows}
    assert got == want
