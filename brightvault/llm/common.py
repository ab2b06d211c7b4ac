"""What the training-data operators share: scratch tables, word rules, splits.

Words are maximal runs of characters other than the six ASCII white-space
characters.  ``bytes.split()`` cuts at the same six, so Python and SQL agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.sources.shared import shared_dir

#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes up to which a side of a join may be broadcast.
BROADCAST_BYTES = 32 << 20
#: A key is hot if it holds more than one in so many of all rows, and FEW at least: so many keys can be hot at most.
HOT, FEW = 1 << 16, 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage.

    The table outlives any executor and goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def unlink(*tables: DataFrame) -> None:
    """Takes written tables away that nothing will read again: what followed from them is written itself."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


def small(df: DataFrame, width: int = 32) -> DataFrame:
    """``df``, a written table with rows of ``width`` bytes, marked for broadcast if all fit in
    BROADCAST_BYTES; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() * width <= BROADCAST_BYTES else df


def facts_of(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``facts``: a row per ``key``, whose ``n`` counts the rows that have it.

    Keys that hold a large share of the rows meet their facts by broadcast, so that no task
    gets all rows of one key; the others are dealt by key.  Both tables are written ones.
    """
    most = max(FEW, (facts.agg(F.sum("n")).collect()[0][0] or 0) // HOT)
    hot = F.broadcast(facts.where(F.col("n") > most))  # HOT rows at most
    cold = rows.join(hot.select(key), key, "left_anti").join(facts.where(F.col("n") <= most), key)
    return cold.unionByName(rows.join(hot, key)).drop("n")


def met(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner", width: int = 32) -> DataFrame:
    """``rows`` that have a fact (``inner``, with it) or have none (``left_anti``): by broadcast while all
    facts of ``width`` bytes fit, else only those of hot keys go by broadcast, and the others are dealt by key.

    ``facts`` is a written table, a row per ``key`` with the count ``n`` of the rows that have it.
    """
    if facts.count() * width <= BROADCAST_BYTES:
        return rows.join(F.broadcast(facts.drop("n")), key, how)
    if how == "inner":
        return facts_of(rows, facts, key)
    most = max(FEW, (facts.agg(F.sum("n")).collect()[0][0] or 0) // HOT)
    cold = rows.join(F.broadcast(facts.where(F.col("n") > most).select(key)), key, how)  # HOT rows at most
    return cold.join(facts.where(F.col("n") <= most).select(key), key, how)


def unused(name: str, columns: list[str]) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that no column has (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column | str) -> Column:
    """True for rows that no model may learn from: crc32 of the id as text, mod 4, is 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread(*cols: Column | str) -> Column:
    """A number in 0..1 that follows from the row's own values: picks samples alike on each run."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows a Python worker gets at once; long texts must not meet in one batch by the ten thousand.

    The setting is the session's: it is only lowered.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))
