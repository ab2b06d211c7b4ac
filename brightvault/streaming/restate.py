"""Daily tables that are restated for the days that a batch touches, and no others.

An event that arrives late belongs to the day it occurred on.  After new batches, the
days of their rows are found, the landing table is read for these days (Spark prunes its partitions by a
join with them), and the daily tables' partitions of these days are replaced.  Each
partition of a stored table is a folder of its own, and a manifest says which: a reader sees all
of a restatement or nothing of it, and other days keep their files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightvault.functions.dialect import ZONE
from brightvault.sources.shared import place
from brightvault.streaming import commits, purge


def reporting_date(column: str) -> Column:
    return F.to_date(F.from_utc_timestamp(column, ZONE))


class Partitioned:
    """A table in the shared folder, cut by one column, of which single partitions are replaced.

    The newest manifest maps each value of the column to a folder.
    """

    def __init__(self, spark: SparkSession, root: str, by: str) -> None:
        self.spark, self.root, self.by = spark, root, by

    def _manifest(self) -> dict:
        return commits.latest(self.spark, self.root) or {"batch": -1, "folders": {}, "schema": None, "seen": -1}

    @property
    def folders(self) -> dict[str, str]:
        return self._manifest()["folders"]

    @property
    def seen(self) -> int:
        """The last batch of the source that has gone in."""
        return self._manifest()["seen"]

    def read(self, values: Sequence[str] | None = None) -> DataFrame | None:
        """The rows, or those of some partitions; None for a table without any."""
        known = self._manifest()
        if known["schema"] is None:
            return None
        at = [f for v, f in known["folders"].items() if values is None or v in values]
        schema = StructType.fromJson(json.loads(known["schema"]))
        return self.spark.read.schema(schema).parquet(*at) if at else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, values: Sequence[str], seen: int | None = None) -> None:
        """Puts ``rows`` in the stead of the partitions ``values``, those that end up empty included."""
        last = self._manifest()
        bad = [v for v in values if not re.fullmatch(r"[A-Za-z0-9_.-]+", v)]
        if bad:
            raise ValueError(f"values of {self.by} must be plain words: {bad[:5]}")
        name, key = uuid.uuid4().hex, "__" + self.by
        at = f"{self.root}/data/{name}"
        rows.withColumn(key, F.col(self.by).cast("string")).repartition(key).write.partitionBy(key).parquet(at)
        folder, system = place(self.spark, at)
        names = [str(f.getPath().getName()) for f in system.listStatus(folder)]
        written = {n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}=")}
        if written - set(values):
            raise ValueError(f"rows of partitions that are not replaced: {sorted(written - set(values))[:5]}")
        folders = {v: f for v, f in last["folders"].items() if v not in set(values)} | {v: f"{self.root}/data/{name}/{key}={v}" for v in values if v in written}
        commits.commit(self.spark, self.root, last["batch"] + 1, folders=folders, schema=rows.schema.json(), seen=last["seen"] if seen is None else seen)
        commits.retire(self.spark, self.root, last["batch"] + 1, [f for v, f in last["folders"].items() if v in set(values)])


def _landed(spark: SparkSession, out: str) -> DataFrame:
    from brightvault.streaming.ingest import LANDED_SCHEMA

    return commits.committed(spark, out, "landing", f"{LANDED_SCHEMA}, batch long, reporting_date date")


def touched(spark: SparkSession, out: str, since: int) -> DataFrame:
    """Days of the rows that the batches after ``since`` have landed."""
    return _landed(spark, out).where(F.col("batch") > since).select("reporting_date").distinct()


def landing_of_days(spark: SparkSession, out: str, days: DataFrame) -> DataFrame:
    """The landing table of some days: the days prune its partitions before it is read."""
    return purge.allowed(_landed(spark, out).join(F.broadcast(days), "reporting_date", "left_semi"), out)


def restate(spark: SparkSession, out: str, root: str, models: Sequence[str]) -> list[date]:
    """Brings the daily tables ``models`` below ``root`` up to the last committed batch; the days that were restated."""
    from brightvault.plans.catalog import daily_frames

    last = commits.latest(spark, out)
    tables = {m: Partitioned(spark, f"{root}/{m}", "reporting_date") for m in models}
    since = min((t.seen for t in tables.values()), default=-1)
    if last is None or since >= last["batch"]:
        return []
    values = sorted(r[0] for r in touched(spark, out, since).collect())  # days
    if values:
        rows = landing_of_days(spark, out, touched(spark, out, since)).drop("batch", "reporting_date")
        for model, df in daily_frames(rows, models).items():
            tables[model].replace(df, [str(v) for v in values], last["batch"])
    return values


def upsert(table: Partitioned, rows: DataFrame, key: str, order: str) -> list[str]:
    """Merges ``rows`` into a stored table: of each key the row that is last by ``order``, new rows first on ties.

    A key keeps its partition.  Only partitions that ``rows`` has are read and replaced; their names.
    """
    values = sorted(str(r[0]) for r in rows.select(table.by).distinct().collect())  # partitions
    old = table.read(values)
    both = rows.withColumn("__new", F.lit(1))
    both = both if old is None else both.unionByName(old.withColumn("__new", F.lit(0)), allowMissingColumns=True)
    best = F.row_number().over(Window.partitionBy(table.by, key).orderBy(F.desc_nulls_last(order), F.desc("__new")))
    table.replace(both.withColumn("__n", best).where("__n = 1").drop("__n", "__new"), values)
    return values
