"""Purged people and events: they leave the stored tables and don't come back.

A purge first adds tombstones (a person's hash or an event id).  From then on they are
left out when the landing table is read and when a batch lands, so an event that comes late, or again, stays out.
Then the partitions that hold their rows, and no others, are rewritten: the rows that
stay are written aside, a mark says that all of them are there, and each folder takes its partition's place.
A purge that broke is finished by calling ``settle``, or by the next purge.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.sources.shared import place
from brightvault.streaming import commits

TOMBSTONE = "kind string, key string"
#: Columns of the landing table by kind of tombstone.
KINDS = {"event": "event_id", "person": "subject_user_hash"}


def tombstones(spark: SparkSession, out: str) -> DataFrame | None:
    hadoop, system = place(spark, f"{out}/tombstones")
    return spark.read.schema(TOMBSTONE).parquet(f"{out}/tombstones").distinct() if system.exists(hadoop) else None


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    for kind, column in KINDS.items():
        rows = rows.join(gone.where(F.col("kind") == kind).select(F.col("key").alias(column)), column, "left_anti")
    return rows


def allowed(rows: DataFrame, out: str) -> DataFrame:
    """``rows`` (with event_id and subject_user_hash) that no tombstone names."""
    gone = tombstones(rows.sparkSession, out)
    return rows if gone is None else without(rows, gone).select(*rows.columns)


def purge(spark: SparkSession, out: str, gone: DataFrame) -> list[str]:
    """Takes what ``gone`` (kind, key) names out of the landed tables; the partitions that were rewritten."""
    from brightvault.streaming.ingest import LANDED_SCHEMA

    settle(spark, out)
    unknown = gone.where(~F.col("kind").isin(*KINDS)).limit(1).collect()
    if unknown:
        raise ValueError(f"no such kind of tombstone: {unknown[0]['kind']}")
    gone.select("kind", "key").distinct().write.mode("append").parquet(f"{out}/tombstones")
    rows = commits.committed(spark, out, "landing", f"{LANDED_SCHEMA}, batch long, reporting_date date")
    dead = tombstones(spark, out)
    hit = None
    for kind, column in KINDS.items():
        found = rows.join(dead.where(F.col("kind") == kind).select(F.col("key").alias(column)), column, "left_semi").select("batch", "reporting_date")
        hit = found if hit is None else hit.unionByName(found)
    parts = sorted((r["batch"], str(r["reporting_date"])) for r in hit.distinct().collect())  # partitions of the table at most
    if not parts:
        return []
    aside = f"{out}/purge/{uuid.uuid4().hex}"
    names = [f"batch={b}/reporting_date={d}" for b, d in parts]
    held = spark.read.schema(LANDED_SCHEMA + ", batch long, reporting_date date").option("basePath", f"{out}/landing").parquet(*[f"{out}/landing/{n}" for n in names])
    without(held, dead).select(*held.columns).write.partitionBy("batch", "reporting_date").parquet(f"{aside}/rows")
    commits._put(spark, f"{aside}/ready", "\n".join(names))
    settle(spark, out)
    return names


def settle(spark: SparkSession, out: str) -> None:
    """Puts the rows that finished purges wrote aside in place; what a broken one left unmarked goes."""
    root, system = place(spark, f"{out}/purge")
    if not system.exists(root):
        return
    for f in system.listStatus(root):
        aside = str(f.getPath())
        ready, _ = place(spark, f"{aside}/ready")
        if system.exists(ready):
            for name in spark.read.text(f"{aside}/ready", wholetext=True).collect()[0][0].split("\n"):
                (new, _), (old, _), (swap, _) = place(spark, f"{aside}/rows/{name}"), place(spark, f"{out}/landing/{name}"), place(spark, f"{aside}/done/{name}")
                if system.exists(swap):
                    continue
                system.delete(old, True)
                if system.exists(new):  # a partition of which nothing stays has no folder
                    system.rename(new, old)
                system.mkdirs(swap)
        system.delete(f.getPath(), True)
