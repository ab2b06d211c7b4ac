"""Batches that appear whole or not at all.

A batch writes its tables below its own number and then one manifest, which is
written aside and renamed.  Readers take the newest manifest and see the batches up
to its number; what a batch without a manifest has written is invisible, and is
overwritten when the batch is replayed.  A manifest carries what the next batch
must know: where the state tables and the runs of the id index are.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from brightvault.sources.shared import place

#: Manifests that stay; a reader that began with an older one than the newest still finds its own.
KEPT = 20


def _put(spark: SparkSession, path: str, text: str) -> None:
    hadoop, system = place(spark, path)
    aside, _ = place(spark, f"{path}.writing")
    out = system.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not system.rename(aside, hadoop) and not system.exists(hadoop):
        raise OSError(f"{path} can't be written")


def _numbers(spark: SparkSession, out: str) -> list[int]:
    hadoop, system = place(spark, f"{out}/commits")
    if not system.exists(hadoop):
        return []
    names = [str(f.getPath().getName()) for f in system.listStatus(hadoop)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def latest(spark: SparkSession, out: str) -> dict[str, Any] | None:
    """The newest manifest; None before the first batch."""
    numbers = _numbers(spark, out)
    if not numbers:
        return None
    return json.loads(spark.read.text(f"{out}/commits/{numbers[-1]:012d}.json", wholetext=True).collect()[0][0])


def commit(spark: SparkSession, out: str, number: int, **facts: Any) -> None:
    """Makes batch ``number`` visible."""
    _put(spark, f"{out}/commits/{number:012d}.json", json.dumps({"batch": number} | facts))
    for old in _numbers(spark, out)[:-KEPT]:
        hadoop, system = place(spark, f"{out}/commits/{old:012d}.json")
        system.delete(hadoop, False)


def committed(spark: SparkSession, out: str, table: str, schema: str) -> DataFrame:
    """The rows of all committed batches, with their ``batch``; the number prunes the folders that are read."""
    last = latest(spark, out)
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out}/{table}").parquet(f"{out}/{table}").where(f"batch <= {last['batch']}")


def remove(spark: SparkSession, path: str) -> None:
    hadoop, system = place(spark, path)
    system.delete(hadoop, True)


def retire(spark: SparkSession, out: str, number: int, paths: list[str]) -> None:
    """Folders that no manifest after ``number`` names: they go when no reader can hold a manifest that does."""
    _put(spark, f"{out}/retired/{number:012d}.json", json.dumps(paths))
    hadoop, system = place(spark, f"{out}/retired")
    for f in system.listStatus(hadoop):
        name = str(f.getPath().getName())
        if name.endswith(".json") and int(name.removesuffix(".json")) <= number - KEPT:
            for path in json.loads(spark.read.text(str(f.getPath()), wholetext=True).collect()[0][0]):
                remove(spark, path)
            system.delete(f.getPath(), False)
