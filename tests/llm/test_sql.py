"""The SQL of the operators against Spark on rows with every kind of blank, nulls, ties and repeats."""

import random

import duckdb
import pytest

from brightvault.llm import registry

BLANKS = [" ", " ", "\n", "\n", "\t", "\r\n", "\x0b", "\x0c", "\r", "  \n", " ", "\x1c", " "]
WORDS = ["a", "b", "Ünï", "#x", "***", "LOUD", "lower", "😀", "w1", "a|b"]
LINES = ["one line of many", "two lines are more", "a third\vline here", "short", "", " one line of many\r"]


def odd_text(rng):
    kind = rng.random()
    if kind < 0.05:
        return None
    if kind < 0.1:
        return rng.choice(["", " ", "\n\t", "\x0b\r"])
    if kind < 0.5:
        return "\n".join(rng.choice(LINES) if rng.random() < 0.6 else f"line {rng.randrange(10**6)} own" for _ in range(rng.randint(1, 6)))
    return "".join(rng.choice(WORDS) + rng.choice(BLANKS) for _ in range(rng.randint(1, 120)))


def odd_url(rng):
    if rng.random() < 0.1:
        return rng.choice([None, "", "://", "no scheme/", "http://", "x://y://z/es/"])
    host = rng.choice(["example.org", "m.Example.ORG", "com", "x.com", "notexample.org", "u@x.com:80", "my-pills.net", "spam-farm.x.net", "a.casino", "docs.x.net", "ads.x.net", "ÜN.net", ""])
    return rng.choice(["http", "HTTPS", ""]) + "://" + host + "".join(rng.choice(["/es/", "/en/1", "/fr/", "/de/x", "/FR/", "?q=/de/", "#/es/", "/cgi-bin/", "/search", "/research", "/wiki/Ü", "/a.exe", "\n/track", "//"]) for _ in range(rng.randrange(4)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, where = random.Random(9), tmp_path_factory.mktemp("odd")
    docs = [(rng.choice([i, i, i, i - 1, None]), odd_text(rng), rng.choice(["en", None]), rng.choice([None, *(f"s{n}" for n in range(13))]), 0) for i in range(700)]
    docs += rng.choices(docs, k=60)
    turns = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(0, 1500, 7)]), rng.choice(["ann", "bob", "system", None, "assistant"]), odd_text(rng)) for _ in range(300)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{where}/conversations.parquet")
    labels = [(rng.choice([i, i, None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 700, 3)] + [(5, 1, 0), (5, 0, 1)]
    pages = [(rng.choice([i, i - 1, None]), odd_url(rng)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{where}/pages.parquet")
    return str(where)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_gives_the_same_rows(spark, tables, name):
    got = registry.QUERIES[name](spark, tables)
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    asked = con.sql(registry.ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(asked.columns)
    at = [asked.columns.index(n) for n in names]
    rows = lambda of: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in of), key=repr)
    # Of rows that repeat id and text it is open which one an exact deduplication keeps, not how many.
    assert rows(got.select(*names).collect()) == rows(tuple(r[i] for i in at) for r in asked.fetchall())
