"""Document quality by Bradley-Terry ranking.

A document's score is linear in features of its text.  Preference pairs
(a document labelled 1 over one labelled 0) give differences of features, on
which the logistic loss is least: the odds that one document beats another are
``exp(score_a - score_b)``.  The scores are then cut at a quantile: the share
of labelled documents that are labelled 0.  The cut becomes 0.7 on the 0..1
scale.

The model is fitted on at most ``sample`` labelled rows, picked by a hash of
the id, half of each label where there are enough.  The quantile is taken over all
labelled documents that are not held out, in Spark (exact up to ACCURACY of them,
beyond that within one in ACCURACY of the ranks); scoring covers every text.

Defined cases: a null text scores as an empty one; labels that are null or that
contradict one another for an id teach nothing; without both labels (or with
empty tables) every document scores 0.7.  Repeated rows score alike.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.llm.common import held_out, small, small_batches, spread, stash, table

SAMPLE, PAIRS, CUT, ACCURACY = 20_000, 200_000, 0.7, 1_000_000
#: Groups of ASCII characters that are counted, one feature each.
MARKS = (b"!", b"|", b"#*$%&<>~^", b".", b",;:", b"?", b"@", b"/\\", b"()[]{}", b"=+_`", b"'\"", b"-")


def features(text: str | None) -> np.ndarray:
    """Shares of characters, word shapes and repetition of the whole text."""
    raw = (text or "").encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower, digits = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
    wide = seen[0xC2:].sum()
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    rates = [seen[list(m)].sum() / n for m in MARKS]
    rates += [upper / max(upper + lower, 1), digits / size, wide / size, seen[:9].sum() / size, len(lines) / n]
    rates += [1 - len(set(lines)) / max(len(lines), 1), 1 - triples / max(len(words) - 2, 1), 1 - len(set(words)) / n]
    shape = [min(len(raw) / n, 40) / 10, math.log1p(len(words)), math.log1p(max(map(len, lines), default=0))]
    x = np.array(rates, np.float64)
    return np.concatenate([np.sqrt(x), np.minimum(x, 1), shape])


def features_col(text: Column | str) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return of(text)


class Model:
    """Weights over scaled features, and the score that is the cut."""

    def __init__(self, mean: np.ndarray, weights: np.ndarray, cut: float = 0.0):
        self.mean, self.weights, self.cut = mean, weights, cut

    def strength(self, x: np.ndarray) -> float:
        """The Bradley-Terry score, on its own scale."""
        return float((x - self.mean) @ self.weights)

    def score(self, x: np.ndarray) -> float:
        gap = self.strength(x) - self.cut + math.log(CUT / (1 - CUT))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, gap))))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3) -> Model:
    """Newton's method on the logistic loss of feature differences: of all pairs if they are few, else of ``pairs`` drawn."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z, rng = (x - mean) / scale, np.random.default_rng(0)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = min(pairs, len(good) * len(bad))
    first, second = (rng.choice(good, n), rng.choice(bad, n)) if n == pairs else (np.repeat(good, len(bad)), np.tile(bad, len(good)))
    d = z[first] - z[second]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        slope = d.T @ p / n - ridge * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w)), slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, w / scale)


def labelled(labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, y`` of the labels that may be learned from, written."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id"))
    return stash(known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").drop("top"), "labels")


def fit(docs: DataFrame, known: DataFrame, sample: int = SAMPLE) -> tuple[Model, float] | None:
    """The model without its cut, and the share of label 0."""
    small_batches(docs.sparkSession)
    count = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(count) < 2:
        return None
    # A little under the bound, so that the limit doesn't choose among the picked: reruns learn alike.
    half = 0.48 * sample
    rate = F.when(F.col("y") == 1, half / count[1]).otherwise(half / count[0])
    picked = known.where(spread("doc_id") < rate).limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "y", features_col("text").alias("x"))
    got = sorted(map(tuple, rows.groupBy("doc_id", "y").agg(F.min("x")).collect()))  # rows that repeat an id teach once
    y = np.array([r[1] for r in got])
    if len(set(y.tolist())) < 2:
        return None
    return fit_pairs(np.array([r[2] for r in got]), y), count[0] / (count[0] + count[1])


def strength_col(text: Column | str, model: Model) -> Column:
    @F.pandas_udf("double")
    def strength(texts: pd.Series) -> pd.Series:
        return pd.Series([model.strength(features(t)) for t in texts], dtype="float64")

    return strength(text)


def quantile(scores: DataFrame, share: float) -> float:
    """The ``s`` below which ``share`` of the rows lie: half-way between the two around it."""
    at = scores.agg(F.percentile_approx("s", share, ACCURACY)).collect()[0][0]
    above = scores.where(F.col("s") > at).agg(F.min("s")).collect()[0][0]
    return at if above is None else (at + above) / 2


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Learns from labelled rows that are not held out; only their texts are read for the cut."""
    known = labelled(labels, label)
    found = fit(docs, known, sample)
    if found is None:
        return None
    model, share = found
    rows = docs.select("doc_id", "text").join(small(known.select("doc_id")), "doc_id")
    model.cut = quantile(stash(rows.select(strength_col("text", model).alias("s")), "strengths"), share)
    return model


def scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text`` to ``doc_id, score``: each text is read once for its strength, from which cut and scores follow."""
    known = labelled(labels, label)
    found = fit(docs, known, sample)
    if found is None:
        return docs.select("doc_id", F.lit(CUT).alias("score"))
    model, share = found
    strengths = stash(docs.select("doc_id", strength_col("text", model).alias("s")), "strengths")
    cut = quantile(strengths.join(known, "doc_id"), share)
    gap = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("s") - cut + math.log(CUT / (1 - CUT))))
    return strengths.select("doc_id", (1 / (1 + F.exp(-gap))).alias("score"))


def score_col(text: Column | str, model: Model | None) -> Column:
    if model is None:
        return F.lit(CUT)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(features(t)) for t in texts], dtype="float64")

    return scored(text)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scores(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def good_ones(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents below the cut go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(score_col("text", model) >= CUT)
