"""Language identification in two steps: family first, then pairs of relatives.

Features are counts of hashed byte trigrams of the whole lower-cased text
(square roots, unit length).  A linear support vector machine per family
against the rest picks the family; within it, one machine for each pair of
languages votes, and the sum of margins breaks ties.

The machines learn from at most ``per_lang`` texts a language, picked by a hash
of the id; those of families from at most ``PER_FAMILY`` texts in all.  Each is
fitted in a task of its own, and only weights come back to the driver.
Languages without a family of their own form one together.

Defined cases: a null text, or one without a letter (Unicode class L), is ``und``
with score 0; rows whose lang is null teach nothing, and rows that repeat id, lang and text teach once; when nothing can be learned
every document is ``und``; with one language only, each lettered text has it.
The new columns take the first free names of lang_pred and score (then lang_pred_, ...).
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import held_out, small_batches, spread, stash, table, unused

DIMS, PER_LANG, PER_FAMILY = 4096, 800, 6400
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
LETTER = regex.compile(r"\p{L}")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), "other")


def trigrams(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed trigram counts."""
    raw = np.frombuffer(b" " + text.encode("utf-8", "replace").translate(LOWER) + b" ", np.uint8)
    seen = np.zeros(DIMS)
    for i in range(0, len(raw), 1 << 20):
        x = raw[i : i + (1 << 20) + 2].astype(np.uint32)
        code = (x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)
        seen += np.bincount(code >> np.uint32(20), minlength=DIMS)
    seen = np.sqrt(seen)
    return (seen / max(np.linalg.norm(seen), 1e-9)).astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Linear machine on squared hinge loss, by accelerated gradient descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)
    cost = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    for t in range(steps):
        slack = np.maximum(1 - y * (x @ v), 0)
        new = v - np.float32(0.25) * (np.float32(ridge) * v - 2 * ((cost * y * slack) @ x))
        v, w = new + np.float32(t / (t + 3)) * (new - w), new
    return w


def machines(langs: list[str]) -> dict[tuple, tuple[set[str], set[str]]]:
    """What is to be told apart: a machine's name, the languages it says yes to and those it says no to."""
    members: dict[str, list[str]] = {}
    for lang in sorted(langs):
        members.setdefault(family(lang), []).append(lang)
    out: dict[tuple, tuple[set[str], set[str]]] = {}
    if len(members) > 1:
        out |= {("family", f): (set(own), set(langs) - set(own)) for f, own in sorted(members.items())}
    for f, own in sorted(members.items()):
        out |= {(f, a, b): ({a}, {b}) for a, b in combinations(own, 2)}
    return out


class Model:
    def __init__(self, langs: list[str], weights: dict[tuple, np.ndarray]):
        self.families = sorted({family(a) for a in langs})
        self.members = {f: sorted(a for a in langs if family(a) == f) for f in self.families}
        self.names = list(weights)
        self.weights = np.array(list(weights.values()), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not LETTER.search(text):
            return "und", 0.0
        margins = dict(zip(self.names, (self.weights @ np.append(trigrams(text), np.float32(1))).tolist(), strict=True)) if self.names else {}
        fam = max(self.families, key=lambda f: margins.get(("family", f), 0))
        sure = [margins[k] for k in margins if k == ("family", fam)]
        votes = dict.fromkeys(self.members[fam], (0, 0.0))
        for a, b in combinations(self.members[fam], 2):
            m = margins[fam, a, b]
            for lang, gap in ((a, m), (b, -m)):
                votes[lang] = (votes[lang][0] + (gap > 0), votes[lang][1] + gap)
        best = max(votes, key=votes.get)
        sure += [abs(margins[fam, a, b]) for a, b in combinations(self.members[fam], 2) if best in (a, b)]
        return best, 1 / (1 + math.exp(-2 * max(-100.0, min([*sure, 100.0]))))


def train(docs: DataFrame, per_lang: int = PER_LANG, per_family: int = PER_FAMILY) -> Model | None:
    """Learns from ``doc_id, text, lang`` of rows that are not held out."""
    small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & (F.col("lang") != "und") & F.col("text").isNotNull() & ~held_out("doc_id"))
    count = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not count:
        return None
    rate = F.coalesce(*[F.when(F.col("lang") == a, per_lang / n) for a, n in count.items()])

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([trigrams(t).tobytes() if LETTER.search(t) else None for t in texts])

    picked = known.withColumns({"turn": spread("doc_id", "text"), "rate": rate}).where("turn < rate")
    # A row that is repeated has one turn, and teaches once however often it stands there.
    picked = picked.withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "lang", "h"]).limit(2 * per_lang * len(count))
    # ``turn`` runs evenly up to ``rate``: its lower part is a sample of the sample.
    picked = picked.select("lang", (F.col("turn") / F.col("rate") * len(count) * per_lang < per_family).alias("few"), F.col("doc_id").cast("string").alias("id"), vector("text").alias("x"))
    picked = stash(picked.where("x IS NOT NULL"), "vectors")
    langs = sorted(r["lang"] for r in picked.select("lang").distinct().collect())
    if not langs:
        return None
    tests = machines(langs)
    roles = [("\n".join(name), lang, lang in yes, name[0] == "family") for name, (yes, no) in tests.items() for lang in yes | no]
    if not roles:
        return Model(langs, {})
    roles = docs.sparkSession.createDataFrame(roles, "machine string, lang string, yes boolean, wide boolean")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "id", "x"])
        x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1)
        return pd.DataFrame({"machine": [rows["machine"].iloc[0]], "w": [machine(x, np.where(rows["yes"], 1.0, -1.0)).tobytes()]})

    work = picked.join(F.broadcast(roles), "lang").where("few OR NOT wide").select("machine", "lang", "id", "yes", "x")
    fitted = {r["machine"]: np.frombuffer(r["w"], np.float32) for r in work.groupBy("machine").applyInPandas(fit, "machine string, w binary").collect()}
    return Model(langs, {name: fitted["\n".join(name)] for name in tests})


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) if model else ("und", 0.0) for t in texts], columns=["lang_pred", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.select(row.alias("row"), predicted("text").alias("p"))
    new = [F.col(f"p.{c}").alias(unused(c, docs.columns)) for c in ("lang_pred", "score")]
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *new)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
