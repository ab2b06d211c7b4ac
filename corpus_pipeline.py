"""A training corpus from raw documents: reject, clean, thin out, mix, tokenize.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brightvault.llm import lines, mixing, quality, simhash, tokens
from brightvault.llm.common import stash, table

STAGES = [
    ("quality classifier", quality.good_ones),
    ("line dedup", lines.clean_lines),
    ("simhash near-dedup", simhash.one_of_each),
    ("mixing", mixing.mixed),
    ("bpe", tokens.tokenize),
]

#: A trained classifier and SimHash have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
