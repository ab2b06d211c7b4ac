"""URL filters: pattern rules indexed by their rarest literal token.

A rule says allow or block for the places (host and path of a URL) that its pattern
fits.  In a pattern ``||`` at the start stands for the start of the host or of one of
its parent domains, ``*`` for any characters, ``^`` for a character that is neither
letter nor digit or the end; the rest stands for itself, at any place unless it starts with ``||``.
A literal token is a run of letters and digits that the pattern closes on both sides,
so every place that the pattern fits has it whole.  Each rule is listed under the one of its
tokens that is rarest in the places at hand, and rules without a token under none.
The tokens of a place fetch its candidate rules, and only those run their regular expression.

Each different place is judged once, with the number of its pages.  The rules go to the
places by broadcast if they are small; beyond that by shuffle, where the rules of hot
tokens are repeated for ``SALTS`` lanes.  Of the fitting rules the one of the highest tier, then
the longest, wins; of equally long ones the one with the longer host, then block, then the first by name.

Defined cases: a null url, or one without ``://``, has an empty host and path, which no rule with a
host fits; hosts keep their port and user; only A-Z are lower-cased, in the host alone; repeated pages
are judged alike; an empty table gives no rows; other columns are not looked at.  All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import BROADCAST_BYTES, FEW, HOT, facts_of, stash, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts with the start of their paths; they fit the host and all its subdomains.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: What decides where no rule of RULES fits: signs of spam, scripts and pages without text.
PATTERNS = (
    ("block", "spam-farm.*/"), ("block", "-pills."), ("block", ".casino^"), ("block", "/wp-login.php"), ("block", "/cgi-bin/"), ("block", "/cart/"), ("block", "/search^"),
    ("block", "||ads."), ("block", "/track^"), ("block", ".exe^"), ("allow", "||docs."), ("allow", "/wiki/"),
)
#: Lanes among which the places of a hot token are dealt where rules aren't broadcast.
SALTS = 64
TOKEN = "[a-z0-9]+"
RULE = "tier int, verdict string, name string, host_length int, pattern string"


def lower(c: Column | str) -> Column:
    return F.translate(c, UPPER, LOWER)


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host and path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    return lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES, patterns=PATTERNS) -> DataFrame:
    """Host rules of tier 1 and patterns of tier 0 as one table."""
    rows = [(1, v, host + path, len(host), f"||{host}{path}") for v, host, path in rules] + [(0, v, p, 0, p) for v, p in patterns]
    return spark.createDataFrame(rows, RULE)


def compiled(rules: DataFrame) -> DataFrame:
    """``rules`` with their regular expression and literal tokens."""
    body = F.regexp_replace("pattern", r"^\|\|", "")
    plain = F.regexp_replace(body, r"([\\.\[\]{}()+?$|\-&])", r"\\$1")
    plain = F.replace(F.replace(plain, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit(r"(?:[^A-Za-z0-9]|\z)"))
    start = F.when(F.col("pattern").startswith("||"), r"(?s)\A(?:[^/]*\.)?").otherwise("(?s)")
    tokens = F.regexp_extract_all(lower("pattern"), F.lit(r"(?:(?<=^\|\|)|(?<=[^a-z0-9*]))(?<!\*)[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0))
    return rules.withColumns({"regex": F.concat(start, plain), "tokens": F.array_distinct(tokens)})


def tokens_of(place: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower(place), F.lit(TOKEN), F.lit(0)))


def fits_broadcast(df: DataFrame, width: int) -> bool:
    return df.count() * width <= BROADCAST_BYTES


def by_token(rows: DataFrame, index: DataFrame, counts: DataFrame, width: int = 512) -> DataFrame:
    """``rows`` (with ``token``) joined with the rules listed under it; ``counts``: rows of each token."""
    if fits_broadcast(index, width):
        return rows.join(F.broadcast(index), "token")
    most = max(FEW, (counts.agg(F.sum("n")).collect()[0][0] or 0) // HOT)
    hot = F.broadcast(counts.where(F.col("n") > most).select("token", F.lit(SALTS).alias("lanes")))  # HOT tokens at most
    lanes = F.coalesce("lanes", F.lit(1))
    dealt = rows.join(hot, "token", "left").withColumn("lane", F.pmod(F.xxhash64("place"), lanes).cast("int")).drop("lanes")
    spread = index.join(hot, "token", "left").withColumn("lane", F.explode(F.sequence(F.lit(0), lanes - 1))).drop("lanes")
    return dealt.join(spread, ["token", "lane"]).drop("lane")


def listed(rules: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each rule under its rarest token ('' if it has none); and how many ``rows`` have each token of a rule."""
    own = rules.select("tier", "name", F.explode("tokens").alias("token"))
    wanted = own.select("token").distinct()
    wanted = F.broadcast(wanted) if fits_broadcast(own, 64) else wanted
    counts = stash(rows.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n")), "tokens")
    ranked = own.join(counts, "token", "left").groupBy("tier", "name").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
    index = rules.join(ranked, ["tier", "name"], "left").withColumn("token", F.coalesce("rarest.token", F.lit("")))
    return stash(index.drop("rarest", "tokens"), "rules"), counts


def judged_places(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``place, n`` (each place once) with the winning rule: place, n, best (null where none fits), written."""
    rules = compiled(rules)
    tokens = places.select("place", F.explode(tokens_of("place")).alias("token"))
    index, counts = listed(rules, tokens)
    if not index.where("token = ''").isEmpty():  # rules that every place must try
        every = places.select("place", F.lit("").alias("token"))
        tokens, counts = tokens.unionByName(every), counts.unionByName(every.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    candidates = by_token(tokens, index, counts)
    rank = F.struct("tier", F.char_length("name").alias("length"), "host_length", (F.col("verdict") == "block").alias("blocks"), "name", "verdict")
    hits = candidates.where("place RLIKE regex").select("place", F.lit(0).cast("long").alias("n"), rank.alias("best"))
    none = F.lit(None).cast(dict(hits.dtypes)["best"])
    return stash(places.select("place", "n", none.alias("best")).unionByName(hits).groupBy("place").agg(F.sum("n").alias("n"), F.max("best").alias("best")), "places")


def filtered(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, url`` to page_id, host, path, rule, pattern, verdict."""
    host, path = parts()
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("place", F.concat("host", "path"))
    places = stash(rows.groupBy("place").agg(F.count(F.lit(1)).alias("n")), "distinct-places")
    facts = judged_places(places, rules).select(
        "place", F.when(F.col("best.tier") == 1, F.col("best.name")).alias("rule"), F.when(F.col("best.tier") == 0, F.col("best.name")).alias("pattern"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), "n",
    )
    return facts_of(rows, facts, "place").select("page_id", "host", "path", "rule", "pattern", "verdict")


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(table(spark, sf_dir, "pages").select("page_id", "url"), rule_table(spark))


OP12_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
d AS (SELECT DISTINCT host, path FROM p),
b AS (SELECT d.host, d.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
      FROM d JOIN r ON (d.host = r.host OR ends_with(d.host, '.' || r.host)) AND starts_with(d.path, r.path) GROUP BY d.host, d.path),
m(verdict, pattern, re) AS (VALUES
  ('block', 'spam-farm.*/', '(?s)spam-farm\..*/'), ('block', '-pills.', '-pills\.'), ('block', '.casino^', '\.casino([^A-Za-z0-9]|\z)'), ('block', '/wp-login.php', '/wp-login\.php'), ('block', '/cgi-bin/', '/cgi-bin/'),
  ('block', '/cart/', '/cart/'), ('block', '/search^', '/search([^A-Za-z0-9]|\z)'), ('block', '||ads.', '\A([^/]*\.)?ads\.'), ('block', '/track^', '/track([^A-Za-z0-9]|\z)'), ('block', '.exe^', '\.exe([^A-Za-z0-9]|\z)'),
  ('allow', '||docs.', '\A([^/]*\.)?docs\.'), ('allow', '/wiki/', '/wiki/')),
n AS (SELECT d.host, d.path, max({'length': length(pattern), 'blocks': m.verdict = 'block', 'pattern': pattern, 'verdict': m.verdict}) AS best FROM d JOIN m ON regexp_matches(d.host || d.path, re) GROUP BY d.host, d.path)
SELECT page_id, p.host, p.path, rule, CASE WHEN rule IS NULL THEN best.pattern END AS pattern, coalesce(b.verdict, best.verdict, 'allow') AS verdict
FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path LEFT JOIN n ON p.host = n.host AND p.path = n.path
"""
