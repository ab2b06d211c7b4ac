"""From raw records to landing, dead letters, checkpoints and counters; in batch and as a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from brightvault.streaming import commits, idindex, purge, rollup
from brightvault.streaming.restate import reporting_date
from brightvault.streaming.validate import validated

PLACE = ("source_topic", "source_partition", "source_offset")
LANDED = (
    "event_id event_name event_version occurred_at received_at producer privacy_class consent_scope subject subject_user_hash subject_session_id payload"
    " source_topic source_partition source_offset raw_record_sha256 raw_record_bytes payload_sha256"
).split()
LANDED_SCHEMA = (
    "event_id string, event_name string, event_version int, occurred_at timestamp, received_at timestamp, producer string, privacy_class string, consent_scope string, subject string, subject_user_hash string,"
    " subject_session_id string, payload string, source_topic string, source_partition int, source_offset long, raw_record_sha256 string, raw_record_bytes int, payload_sha256 string, landed_at timestamp"
)
DEAD_SCHEMA = "event_id string, event_name string, source_topic string, source_partition int, source_offset long, error_code string, error_message string, raw_record_sha256 string, raw_record_bytes int"
STATE_SCHEMA = "consumer_group string, source_topic string, source_partition int, accepted_count long, rejected_count long, landed_count long, last_offset long, last_lag long"
ENDS = "source_topic string, source_partition int, end_offset long"


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("error_code IS NULL").select(*LANDED)


def rejected(checked: DataFrame) -> DataFrame:
    """Dead letters: a safe identity, the place, the code and the size; never the body."""
    return checked.where("error_code IS NOT NULL").select(
        F.col("safe_event_id").alias("event_id"), F.col("safe_event_name").alias("event_name"), *PLACE, "error_code",
        F.substring(F.translate("error_code", "_", " "), 1, 500).alias("error_message"), "raw_record_sha256", "raw_record_bytes",
    )


def dlq_records(checked: DataFrame) -> DataFrame:
    """Messages for the dead-letter topic: keyed by event id or raw hash, compact JSON value."""
    dead = rejected(checked)
    body = F.to_json(F.struct(*PLACE, "event_id", "event_name", "error_code", "error_message", "raw_record_sha256", "raw_record_bytes"), {"ignoreNullFields": "false"})
    return dead.select(F.coalesce("event_id", "raw_record_sha256").alias("key"), body.alias("value"))


def first_arrivals(good: DataFrame) -> DataFrame:
    """Of each event id the record with the lowest (topic, partition, offset)."""
    order = Window.partitionBy("event_id").orderBy(*PLACE)
    return good.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def insert_if_absent(good: DataFrame, landing: DataFrame | None) -> DataFrame:
    """What a batch adds to the landing table: unknown event ids, first arrival each."""
    fresh = first_arrivals(good)
    return fresh if landing is None else fresh.join(landing.select("event_id"), "event_id", "left_anti")


def checkpoints(checked: DataFrame) -> DataFrame:
    return checked.groupBy("source_topic", "source_partition").agg(F.max("source_offset").alias("last_offset"))


def metrics(checked: DataFrame) -> DataFrame:
    """Counters per topic. A duplicate counts as accepted, and is shown beside."""
    last = F.max(F.struct("source_offset", "source_partition"))
    good = F.col("error_code").isNull()
    return checked.groupBy("source_topic").agg(
        F.count_if(good).alias("accepted_count"), F.count_if(~good).alias("rejected_count"), (F.count_if(good) - F.count_distinct(F.when(good, F.col("event_id")))).alias("duplicate_count"),
        last["source_partition"].alias("last_processed_partition"), last["source_offset"].alias("last_processed_offset"),
    )


def lag(raw: DataFrame) -> DataFrame:
    """Records of the partition behind each record, as far as the topic has been read."""
    end = raw.groupBy("source_topic", "source_partition").agg((F.max("source_offset") + 1).alias("end_offset"))
    joined = raw.join(end, ["source_topic", "source_partition"])
    return joined.select(*PLACE, F.greatest(F.lit(0), F.col("end_offset") - F.col("source_offset") - 1).cast("long").alias("last_lag"))


def source_ends(records: DataFrame) -> DataFrame:
    """Where each partition of a topic ends: topic, partition and the offset after its last record."""
    return records.groupBy("source_topic", "source_partition").agg((F.max("source_offset") + 1).alias("end_offset"))


class ProgressEnds(StreamingQueryListener):
    """End offsets as the progress of a query reports them; add it to ``spark.streams``, and pass ``frame`` as ``ends``."""

    def __init__(self) -> None:
        self.ends: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        for source in event.progress.sources:
            offsets = json.loads(source.latestOffset or "null")
            if isinstance(offsets, dict) and all(isinstance(o, dict) for o in offsets.values()):
                self.ends |= {(topic, int(p)): int(end) for topic, of in offsets.items() for p, end in of.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, p, e) for (t, p), e in self.ends.items()], ENDS)


def batch_state(checked: DataFrame, landed: DataFrame, before: DataFrame | None, ends: DataFrame | None, group: str) -> DataFrame:
    """Counters, last offset and lag per consumer group, topic and partition: those of ``before`` with this batch's."""
    good = F.col("error_code").isNull()
    place = ["source_topic", "source_partition"]
    seen = checked.groupBy(*place).agg(F.count_if(good).alias("accepted_count"), F.count_if(~good).alias("rejected_count"), F.max("source_offset").alias("last_offset"))
    new = landed.groupBy(*place).agg(F.count(F.lit(1)).alias("landed_count"))
    rows = seen.unionByName(new, allowMissingColumns=True).withColumn("consumer_group", F.lit(group))
    rows = rows.unionByName(before.select(*rows.columns, "last_lag"), allowMissingColumns=True) if before is not None else rows.withColumn("last_lag", F.lit(None).cast("long"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    merged = rows.groupBy("consumer_group", *place).agg(total("accepted_count"), total("rejected_count"), total("landed_count"), F.max("last_offset").alias("last_offset"), F.max("last_lag").alias("old_lag"))
    if ends is None:
        return merged.withColumnRenamed("old_lag", "last_lag")
    lag = F.greatest(F.lit(0), F.col("end_offset") - F.col("last_offset") - 1).cast("long")
    return merged.join(ends, place, "left").withColumn("last_lag", F.coalesce(lag, "old_lag")).drop("old_lag", "end_offset")


def run_stream(
    source: DataFrame, out: str, checkpoint: str, once: bool = True, *, landed_at: Column | None = None, ends: Callable[[SparkSession], DataFrame] | None = None, group: str = "ingest",
    between: Callable[[str], None] = lambda step: None,
):
    """The ingest loop as one streaming query.

    Each micro-batch writes what it lands (by reporting date), its dead letters, their messages for the
    dead-letter topic, the state of the partitions (counters, checkpoints, lag), its hourly counts and a run of
    the id index, and then a manifest: they appear together (``commits``).  Offsets are committed after
    that, and a batch that has its manifest already does nothing when it is replayed.

    Ids that older batches have landed are left out, and so is what a purge forbids.  landed_at: the time of landing,
    that of the batch by default.  ends: the end offsets of the source at this time, for the lag.
    between: called before each write; tests break the loop there.
    """
    spark = source.sparkSession

    def land(batch: DataFrame, number: int) -> None:
        last = commits.latest(spark, out) or {"batch": -1, "runs": [], "hours": [], "state": None}
        if last["batch"] >= number:
            return
        checked = validated(batch).persist()
        runs, ids_at = idindex.from_json(last["runs"]), f"{out}/ids"
        fresh = idindex.hashed(first_arrivals(purge.allowed(accepted(checked), out))).persist()
        old, _ = idindex.known(fresh.select("event_id", "h"), ids_at, runs)
        new = fresh if old is None else fresh.join(old, "event_id", "left_anti")
        new = new.select(*LANDED, (F.current_timestamp() if landed_at is None else landed_at).alias("landed_at")).withColumn("reporting_date", reporting_date("occurred_at"))

        def put(df: DataFrame, table: str, by: str | None = None) -> str:
            between(table)
            path = f"{out}/{table}/batch={number}"
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(path)
            return path

        put(new, "landing", "reporting_date")
        landed = spark.read.schema(LANDED_SCHEMA).parquet(f"{out}/landing/batch={number}").persist()
        put(rejected(checked), "dlq")
        put(dlq_records(checked), "dlq_topic")
        before = spark.read.parquet(last["state"]) if last["state"] else None
        state = put(batch_state(checked, landed, before, ends(spark) if ends else None, group).coalesce(1), "state")
        hours, spent = rollup.appended(last["hours"], landed, f"{out}/hours", f"batch={number}", lambda: between("hours"))
        between("ids")
        runs.append(idindex.write_run(idindex.hashed(landed.select("event_id")), ids_at, f"batch-{number}", 0))
        between("compaction")
        runs, gone = idindex.compacted(spark, ids_at, runs, f"merged-{number}")
        between("commit")
        commits.commit(spark, out, number, runs=idindex.to_json(runs), hours=hours, state=state)
        between("cleaning")
        for path in [f"{ids_at}/{r.name}" for r in gone]:  # only this loop reads them
            commits.remove(spark, path)
        commits.retire(spark, out, number, spent + ([last["state"]] if last["state"] else []))
        for df in (landed, fresh, checked):
            df.unpersist()

    stream = source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()


def landing_of(spark: SparkSession, out: str) -> DataFrame:
    """What the committed batches have landed, without what was purged since."""
    return purge.allowed(commits.committed(spark, out, "landing", f"{LANDED_SCHEMA}, batch long, reporting_date date"), out)


def dead_of(spark: SparkSession, out: str) -> DataFrame:
    return commits.committed(spark, out, "dlq", f"{DEAD_SCHEMA}, batch long")


def messages_of(spark: SparkSession, out: str) -> DataFrame:
    return commits.committed(spark, out, "dlq_topic", "key string, value string, batch long")


def state_of(spark: SparkSession, out: str) -> DataFrame:
    """Counters, checkpoint and lag per consumer group, topic and partition, as of the last committed batch."""
    last = commits.latest(spark, out)
    return spark.read.schema(STATE_SCHEMA).parquet(last["state"]) if last else spark.createDataFrame([], STATE_SCHEMA)


def hours_of(spark: SparkSession, out: str) -> DataFrame:
    last = commits.latest(spark, out)
    return rollup.summed(spark, last["hours"] if last else [])


def kafka_source(spark: SparkSession, servers: str, topic: str, most: int = 100_000) -> DataFrame:
    """The envelope topic, from its start; needs Spark's Kafka package on the cluster."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    raw = raw.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", most).load()
    return raw.select(F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset"), "value")
