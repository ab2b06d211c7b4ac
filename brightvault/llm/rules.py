"""Quality rules as a ledger of failure bits.

Each rule is evaluated once per document; its bit is set where the document
fails it, and the measurements are stored beside the bits, as a table in the
shared folder.  A policy is a version of the set of rules that reject.  Applying
one, or finding what each rule alone removes, reads that table and never the texts.

Defined cases: a null text has no words; empty and blank texts fail ``few_words``;
a null doc_id is kept as it is; repeated rows get a ledger row each.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import small_batches, stash, table

#: Name and failing condition over the measurements; bit i belongs to rule i.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    ("capitals", "n_upper > n_lower"),
)
BASE = 0b11
#: Versions of the policy: which rules reject.
POLICIES = {"base": BASE, "v1": 0b000111, "v2": 0b111111}
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, n_upper long, n_lower long"
SYMBOLS = re.compile(r"[#*$%&|<>]")


def repeated(words: list) -> int:
    """Words within a window of three that the list has twice or more."""
    if len(words) < 4:
        return 0
    ids: dict = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = np.unique(x[:-1] * len(ids) + x[1:], return_inverse=True)[1]
    _, inv, count = np.unique(pair[:-1] * np.int64(len(ids)) + x[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inv] > 1)
    hit = np.zeros(len(words), bool)
    for i in range(3):
        hit[at + i] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    raw = (text or "").encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    chars = len(raw) - seen[0x80:0xC0].sum() - seen[9:14].sum() - seen[32]
    return len(words), int(chars), int(seen[list(b"#*$%&|<>")].sum()), len(lines), len(lines) - len(set(lines)), repeated(words), int(seen[65:91].sum()), int(seen[97:123].sum())


def measures_col(text: Column | str) -> Column:
    @F.pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=[c.split()[0] for c in MEASURES.split(", ")], dtype="int64")

    return of(text)


def ledger(docs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``doc_id, text`` to doc_id, measurements and ``fail_bits``, written."""
    small_batches(docs.sparkSession)
    measured = docs.select("doc_id", measures_col("text").alias("m")).select("doc_id", "m.*")
    bits = sum((F.when(F.expr(fails), F.lit(1 << i)).otherwise(0) for i, (_, fails) in enumerate(rules)), F.lit(0))
    return stash(measured.withColumn("fail_bits", bits.cast("long")), "ledger")


def apply_policy(of: DataFrame, mask: int) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy fails."""
    return of.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0)


def ablations(of: DataFrame, mask: int, rules: tuple = RULES) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that only it removes."""
    sets = of.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).count()
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (n, _) in enumerate(rules) if mask >> i & 1]))
    return (
        sets.select("bits", "count", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("only_here"),
        )
    )


def op5_rules(spark: SparkSession, sf_dir: str, policy: str = "v2") -> DataFrame:
    found = apply_policy(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), POLICIES[policy] | BASE)
    return found.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits"
    )


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each policy and each of its rules: documents the rule fails, and those that it alone removes."""
    found = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    each = [ablations(found, mask | BASE).select(F.lit(name).alias("policy"), "rule", "fails", "only_here") for name, mask in POLICIES.items()]
    return reduce(DataFrame.unionByName, each)


LEDGER_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
p AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n > 1),
rw AS (SELECT rid, count(DISTINCT i) AS n FROM (SELECT rid, i FROM r UNION ALL SELECT rid, i + 1 FROM r UNION ALL SELECT rid, i + 2 FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup FROM (SELECT rid, unnest(string_split(text, chr(10))) AS x FROM d)
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
      coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
      length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper, length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower
      FROM d JOIN w USING (rid) LEFT JOIN l USING (rid) LEFT JOIN rw USING (rid)),
f AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 30 * n_words)::INT
      + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars > 15 * n_words OR word_chars < 2 * n_words)::INT + 32 * (n_upper > n_lower)::INT)::BIGINT AS fail_bits FROM m)
"""
OP5_SQL = LEDGER_SQL + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f"
ABLATION_SQL = (
    LEDGER_SQL
    + ", versions(policy, mask) AS (VALUES ('base', 3), ('v1', 7), ('v2', 63)), named(rule, bit) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8), ('word_length', 16), ('capitals', 32))"
    " SELECT policy, rule, count(*) FILTER (fail_bits & bit <> 0) AS fails, count(*) FILTER (fail_bits & mask = bit) AS only_here FROM versions JOIN named ON mask & bit <> 0 CROSS JOIN f GROUP BY policy, rule"
)
