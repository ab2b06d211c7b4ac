"""The index of landed event ids: sorted runs, each with a sketch, merged by size.

A batch adds a run of its new ids.  ``FAN`` runs of one level become one of the next, so
there are at most ``FAN`` times as many as the logarithm of the number of batches.  A run is cut into blocks by the
hash of its ids; a block has at most about ``IN_BLOCK`` ids and a Bloom sketch of 32,768 bits,
which is kept beside it as one row.  Blocks are put together to files of ``BLOCKS``.  A batch first meets the
sketches, by joins on the block, and opens only files in which a sketch has one of its ids.
All of this is DataFrame work; the driver holds the list of runs and of the files to open.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN, IN_BLOCK, BLOCKS, BITS, PROBES = 4, 2_000, 64, 32_768, 5
IDS, SKETCH = "event_id string, h long, block long", "block long, bits binary"


@dataclass(frozen=True)
class Run:
    """``name``: its folder. ``blocks``: how many hash blocks its ids are dealt to."""

    name: str
    level: int
    rows: int
    blocks: int


def hashed(ids: DataFrame) -> DataFrame:
    return ids.withColumn("h", F.xxhash64("event_id"))


def block(blocks: int) -> Column:
    return F.pmod(F.col("h"), F.lit(blocks))


def probes() -> Column:
    """The bits that an id sets in its block."""
    return F.array(*[F.pmod(F.xxhash64("h", F.lit(i)), F.lit(BITS)) for i in range(PROBES)])


def is_set(bits: str, position: Column) -> Column:
    byte = F.hex(F.substring(F.col(bits), (F.floor(position / 8) + 1).cast("int"), F.lit(1)))
    return F.getbit(F.conv(byte, 16, 10).cast("int"), F.pmod(position, F.lit(8)).cast("int")) == 1


def write_run(ids: DataFrame, root: str, name: str, level: int) -> Run:
    """``ids`` (event_id, h; written ones) as a run: files of blocks, and their sketches."""
    rows = ids.count()
    blocks = max(1, -(-rows // IN_BLOCK))
    placed = ids.select("event_id", "h", block(blocks).alias("block"))
    files = placed.withColumn("part", F.floor(F.col("block") / BLOCKS).cast("int"))
    files.repartition("part").sortWithinPartitions("part", "block", "h").write.mode("overwrite").partitionBy("part").parquet(f"{root}/{name}/ids")
    bits = placed.select("block", F.explode(probes()).alias("at")).groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits.write.mode("overwrite").parquet(f"{root}/{name}/sketch")
    return Run(name, level, rows, blocks)


def maybe(ids: DataFrame, root: str, runs: list[Run]) -> DataFrame:
    """Rows (event_id, h, run, part) of ``ids`` (event_id, h) whose sketch says that the run may have them."""
    spark = ids.sparkSession

    def of(run: Run) -> DataFrame:
        sketch = spark.read.schema(SKETCH).parquet(f"{root}/{run.name}/sketch")
        met = ids.withColumn("block", block(run.blocks)).join(sketch, "block")
        hit = reduce(Column.__and__, [is_set("bits", F.pmod(F.xxhash64("h", F.lit(i)), F.lit(BITS))) for i in range(PROBES)])
        return met.where(hit).select("event_id", "h", F.lit(run.name).alias("run"), F.floor(F.col("block") / BLOCKS).cast("int").alias("part"))

    return reduce(DataFrame.unionByName, [of(r) for r in runs if r.rows])


def known(ids: DataFrame, root: str, runs: list[Run]) -> tuple[DataFrame | None, list[str]]:
    """The ids of ``ids`` (event_id, h) that a run has, and the files opened to see that; None if no sketch hits."""
    if not any(r.rows for r in runs):
        return None, []
    spark = ids.sparkSession
    hits = maybe(ids, root, runs).persist()
    opened = [f"{root}/{r['run']}/ids/part={r['part']}" for r in hits.select("run", "part").distinct().collect()]  # files of the index at most
    if not opened:
        hits.unpersist()
        return None, []
    there = spark.read.schema(IDS).parquet(*opened).select("event_id")
    found = there.join(hits.select("event_id").distinct(), "event_id", "left_semi").distinct()
    return found, opened


def compacted(spark: SparkSession, root: str, runs: list[Run], name: str) -> tuple[list[Run], list[Run]]:
    """``runs`` with each level that has FAN of them merged into the next; and the runs that no one needs any more."""
    gone: list[Run] = []
    for level in range(64):
        full = [r for r in runs if r.level == level]
        if len(full) < FAN:
            continue
        ids = spark.read.schema(IDS).parquet(*[f"{root}/{r.name}/ids/part=*" for r in full if r.rows]).select("event_id", "h") if any(r.rows for r in full) else spark.createDataFrame([], "event_id string, h long")
        merged = write_run(ids, root, f"{name}-{level + 1}", level + 1)
        runs = [r for r in runs if r not in full] + [merged]
        gone += full
    return runs, gone


def to_json(runs: list[Run]) -> list[dict]:
    return [asdict(r) for r in runs]


def from_json(runs: list[dict]) -> list[Run]:
    return [Run(**r) for r in runs]
