"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's. Only a local run may do without."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (path or "file:///tmp/checkpoints").rstrip("/")


def place(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/model-{name}-{uuid.uuid4().hex}"
    hadoop, system = place(spark, path)
    system.mkdirs(hadoop)
    system.deleteOnExit(hadoop)
    return path


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a parquet table, read again, and its path; it goes when the application ends."""
    path = f"{scratch(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def version(spark: SparkSession, path: str) -> str:
    """What tells a changed table from an unchanged one: names, sizes and times of its files, at any depth."""
    hadoop, system = place(spark, path)
    files, found = system.listFiles(hadoop, True), []
    while files.hasNext():
        f = files.next()
        found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
    found.sort()
    return uuid.uuid5(uuid.NAMESPACE_URL, str(found)).hex


#: Paths of tables that this application has written, by application, input, its version and name.
_stored: dict[tuple[str, str, str, str], str] = {}


#: Setting: a folder in which stored tables stay, for all applications; without it they go with the application.
TABLES = "spark.brightvault.tables"


def stored(spark: SparkSession, source: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table made once per version of its ``source``, then read: once for all applications where TABLES names
    a folder, which a job may fill ahead of them, else once per application."""
    now = version(spark, source)
    home = spark.conf.get(TABLES, None)
    if home:
        return kept(spark, f"{home.rstrip('/')}/{name}-{uuid.uuid5(uuid.NAMESPACE_URL, source).hex[:12]}", now, make)
    key = (spark.sparkContext.applicationId, source, now, name)
    path = _stored.get(key)
    if path:
        hadoop, system = place(spark, path)
        if system.exists(hadoop):
            return spark.read.parquet(path)
    table, _stored[key] = write_table(make(), name)
    return table


def kept(spark: SparkSession, root: str, now: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of version ``now`` below ``root``; it is written aside and renamed, so that it is there whole or not at all."""
    done, system = place(spark, f"{root}/{now}")
    if not system.exists(done):
        aside = f"{root}/.{uuid.uuid4().hex}"
        make().write.parquet(aside)
        if not system.rename(place(spark, aside)[0], done) or system.exists(place(spark, f"{root}/{now}/{aside.rsplit('/', 1)[1]}")[0]):
            # Another application was first: its table stands.
            system.delete(place(spark, aside)[0], True)
            system.delete(place(spark, f"{root}/{now}/{aside.rsplit('/', 1)[1]}")[0], True)
    return spark.read.parquet(f"{root}/{now}")
