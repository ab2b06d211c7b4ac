"""Filter interactions, URL rules and divergences against plain Python, on odd rows and with small bounds."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from brightvault.llm import audit, common, divergence, urls

LONG = " ".join(random.Random(3).choice(["alpha", "Beta", "gamma", "x1", "Ünï"]) for _ in range(30_000))
DOCS = "doc_id long, lang string, text string"


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd_documents(seed=4):
    rng = random.Random(seed)
    texts = [None, "", " \t", "a b", "A B # c", LONG, "w " * 300, " ".join(f"w{i}" for i in range(250)), "LOUD " * 210, "x|y " + " ".join(f"q{i}" for i in range(220))]
    rows = [(rng.choice([i, i, i - 1, None]), rng.choice(["en", "de", None, ""]), rng.choice(texts) if rng.random() < 0.8 else f"own {i}") for i in range(160)]
    return rows + rng.choices(rows, k=30)


def plain_interactions(docs, labels):
    """Per part, order and step by the words of the contract."""
    least = {}
    for d, _, t in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, lang, t in docs:
        t = t or ""
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", t) if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": d is not None and least[t] < d,
        }
        known = [x for x in labels if x[0] == d and d is not None]
        rows.append((lang or "", fails, any(q == 1 for _, q, _ in known), any(x == 1 for _, _, x in known)))
    out, shapley = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, c in enumerate(order, 1):
                lost = [r for r in left if r[1][c]]
                redundant = sum(r[1][c] for r in gone)
                left = [r for r in left if not r[1][c]]
                gone += lost
                unique = sum(r[1][c] and sum(r[1].values()) == 1 for r in rows if r[0] == part)
                out[part, order, step] = (len(left), len(lost), redundant, unique, sum(r[2] for r in lost), sum(r[3] for r in lost))
                shapley[part, c] += len(lost)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("weak", [False, True])
def test_interactions_against_a_walk_through_all_orders(spark, weak):
    """Also with a hash on which all texts collide, so that only their bytes tell them apart."""
    docs = odd_documents()
    if weak:  # ids tell rows apart where hashes don't
        docs = [(i, lang, t) for i, (_, lang, t) in enumerate(docs)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, 1), (None, 1, 1), (9, 1, 1), (9, 1, 1), (10_000, 1, 1)]
    of = (lambda text: F.lit(b"x")) if weak else audit.digest
    df = documents(spark, docs)
    rows = audit.judged(df, of)
    found = audit.combinations(rows, audit.copies(rows, df, of), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.count() <= 32 * 4
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in audit.interactions(found).collect()}
    assert got == plain_interactions(docs, labels)


def test_interactions_of_nothing_and_with_clashing_columns(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents(spark, [])
    rows = audit.judged(df)
    assert audit.interactions(audit.combinations(rows, audit.copies(rows, df), labels)).count() == 0
    df = documents(spark, [(1, "en", "a"), (2, "en", "a")]).selectExpr("*", "0 AS H", "'x' AS part", "1 AS n", "7 AS bits", "true AS least")
    rows = audit.judged(df)
    assert [r.doc_id for r in audit.copies(rows, df).collect()] == [2]


def test_a_text_that_holds_a_third_of_the_rows(spark, monkeypatch):
    """Hot hashes meet their least id by broadcast; all but the first are copies."""
    monkeypatch.setattr(common, "FEW", 8)
    docs = [(i, "en", "hot text") for i in range(0, 900, 3)] + [(i, "en", f"own {i}") for i in range(1, 900, 3)] + [(i, "en", f"twice {i // 6}") for i in range(2, 900, 3)]
    df = documents(spark, docs)
    first = {}
    for d, _, t in sorted(docs):
        first.setdefault(t, d)
    rows = audit.judged(df)
    assert sorted(r.doc_id for r in audit.copies(rows, df).collect()) == sorted(d for d, _, t in docs if first[t] < d)


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http://Org/", "http://a.ORG/x?y://z", "http://org", "http://xorg/", "https://Example.org/es/1", "https://m.example.org/es", "https://m.example.org/en/12#x/", "https://notexample.org/en/12",
    "https://example.org/en/2", "https://x.com/fr/", "https://x.com/FR/", "https://com/de/?q", "http://u@x.com:80/de/", "http://x.com?/de/", "http://spam-farm.x.net/a/b", "http://my-pills.net", "http://a.casino", "http://a.casino/x", "http://a.casinos/x",
    "http://docs.x.net/search", "http://x.net/search/cgi-bin/", "http://x.net/research", "http://x.net/a.exe", "http://ads.x.net/wiki/", "http://xads.x.net/", "http://x.net/a\nb/track", "http://ÜN.net/wiki/Ü", "http://x.net/" + "a/" * 5000 + "track",
]


def regex_of(pattern):
    body = pattern.removeprefix("||")
    inner = "".join(".*" if c == "*" else r"(?:[^A-Za-z0-9]|\Z)" if c == "^" else re.escape(c) for c in body)
    return re.compile((r"\A(?:[^/]*\.)?" if pattern.startswith("||") else "") + inner, re.S)


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match("[^/?#]*", rest)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    path = re.match("[^?#]*", rest[len(raw):])[0]
    fit = [r for r in rules if regex_of(r[4]).search(host + path)]
    best = max(fit, key=lambda r: (r[0], len(r[2]), r[3], r[1] == "block", r[2]), default=None)
    return host, path, best[2] if best and best[0] == 1 else None, best[2] if best and best[0] == 0 else None, best[1] if best else "allow"


EXTRA = [("block", "*"), ("allow", "^"), ("block", "a"), ("allow", "||net^"), ("block", "||x.net/a.*e"), ("allow", "/search^*bin/"), ("block", "x.net/search^")]


@pytest.mark.parametrize(("patterns", "limit"), [(urls.PATTERNS, None), (EXTRA + list(urls.PATTERNS), None), (EXTRA + list(urls.PATTERNS), 0), ([], None)])
def test_url_rules_against_trying_every_rule(spark, monkeypatch, patterns, limit):
    """Rules with and without tokens, by broadcast and by lanes of hot tokens."""
    if limit is not None:
        monkeypatch.setattr(urls, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(urls, "FEW", 3)
    pages = [(i % 31 if i % 7 else None, u) for i, u in enumerate(ODD_URLS * 3 + ["http://hot.net/x"] * 40)]
    rules = urls.rule_table(spark, patterns=patterns)
    table = [tuple(r) for r in rules.collect()]
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' AS place", "1 AS n", "2 AS host")
    got = collections.Counter((r.page_id, r.host, r.path, r.rule, r.pattern, r.verdict) for r in urls.filtered(df, rules).collect())
    assert got == collections.Counter((p, *plain_verdict(u, table)) for p, u in pages)
    assert urls.filtered(df.limit(0), rules).count() == 0


def test_a_rule_is_listed_once_under_its_rarest_token(spark):
    places = spark.createDataFrame([("a.example.org/en/1",), ("b.example.org/x",), ("c.example.com/en/2",)], "place string")
    tokens = places.select("place", F.explode(urls.tokens_of("place")).alias("token"))
    index, _ = urls.listed(urls.compiled(urls.rule_table(spark, patterns=[("block", "*x*"), ("block", "/nowhere/en/")])), tokens)
    got = {r.name: r.token for r in index.collect()}
    assert got == {"org/": "org", "example.org/es/": "es", "example.org/en/1": "en", "com/fr/": "fr", "com/de/": "de", "*x*": "", "/nowhere/en/": "nowhere"}


def plain_divergences(docs, min_docs, top):
    counts, holders, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups.add((lang, source))
        counts[lang, source].update(found)
        holders[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)
        p = {}
        for s in [*sources, None]:
            of = counts[lang, s] if s is not None else sum((counts[lang, x] for x in sources), collections.Counter())
            total = sum(of[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (of[t] + 1) // (total + len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pair = [(-sum(f(p[s][t], p[r][t]) for t in kept), r.encode(), r) for r in sources if r != s]
            term = [(-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            for part, rows, most in (("pair", pair, None), ("term", term, top)):
                out |= {(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(sorted(rows)[:most], 1)}
    return out


@pytest.mark.parametrize(("spill", "side", "few"), [(divergence.SPILL, divergence.SIDE, 2048), (5, 4, 2), (1, 2, 2)])
def test_divergences_against_plain_sums(spark, monkeypatch, spill, side, few):
    """With stripes sent off after a few entries, sources folded in small blocks, and hot sources by broadcast."""
    monkeypatch.setattr(common, "FEW", few)
    monkeypatch.setattr(divergence.both, "__defaults__", (side,))
    rng = random.Random(8)
    words = ["a", "B", "b", "Ünï", "é", "日本", "x1y", "don't", "zz", "A_b", "ſ", "K", *(f"w{'abcdefgh'[i % 8] * (i // 8 + 1)}" for i in range(40))]
    docs = [(rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s2", "s3", "S", None, "é", "𝒳", "\uffff"]), " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for _ in range(150)]
    docs += [("en", "s1", LONG), ("fr", "only", "never thrice"), ("fr", "other", None), ("it", "silent", "123"), ("en", "mute", "--"), *[docs[0]] * 5]
    df = spark.createDataFrame(docs, "lang string, source string, text string").selectExpr("*", "1 AS term", "2 AS n", "3 AS p").repartition(3)
    got = [tuple(r) for r in divergence.divergences(df.select("lang", "source", "text"), top=7, spill=spill).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_divergences(docs, 3, 7)
    assert divergence.divergences(df.limit(0)).count() == 0


def test_a_tokenizer_file_of_another_kind_is_refused():
    import public_tokenizers

    from brightvault.llm import tokens

    with pytest.raises(ValueError, match="not built"):
        tokens.load(public_tokenizers.path("word_bpe_49k.json"))


def test_a_labelled_row_that_is_a_third_of_all_teaches_once(spark):
    from brightvault.llm import langid

    rng = random.Random(2)
    words = {"xx": ["abra", "kadabra", "simsala"], "yy": ["ollo", "pollo", "mollo"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)), lang) for i in range(0, 120) for lang in words]
    twice = next(r for r in rows if (r[0], r[2]) == (1, "xx"))
    ddl = "doc_id long, text string, lang string"
    once = langid.train(spark.createDataFrame(rows, ddl), per_lang=10**6, per_family=10**9)
    often = langid.train(spark.createDataFrame(rows + [twice] * 120, ddl), per_lang=10**6, per_family=10**9)
    for text in ("abra ollo", "kadabra abra", "mollo"):
        a, b = once.predict(text), often.predict(text)
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-9
