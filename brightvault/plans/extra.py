"""Queries that are not models: ingest in batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.plans import evidence as ev
from brightvault.plans.model import MODELS, checking_sql, frame
from brightvault.plans.tables import written
from brightvault.sources import packets, raw
from brightvault.sources.adapter import events, landing_sql
from brightvault.sources.adapter import stored as landing
from brightvault.sources.shared import scratch, stored, version
from brightvault.streaming import ingest, purge, restate
from brightvault.streaming.validate import BLOCKED, keys_at_any_depth, validated

PLACE = ["source_partition", "source_offset"]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame("raw_events", {"landing": landing(spark, sf_dir)})


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts, written once: a filter on them would otherwise be pushed into the parsing and repeat it."""
    return stored(spark, events(sf_dir), "verdicts", lambda: validated(raw_events(spark, sf_dir)))


#: Parts in which the raw records reach the stream, one batch each, with a restart between them.
PARTS = 3
#: Daily tables that the stream's batches restate.
RESTATED = ("s_content_performance_daily", "br_content_reaction_daily")
#: Where the loop has run, by application, input and version.
_streams: dict[tuple[str, str, str], str] = {}


def streamed(spark: SparkSession, sf_dir: str) -> str:
    """The raw records through the streaming loop, in parts; the folder of its tables."""
    key = (spark.sparkContext.applicationId, events(sf_dir), version(spark, events(sf_dir)))
    if key not in _streams:
        topic = written(raw_events(spark, sf_dir), "topic")
        end, home = (topic.agg(F.max("source_offset")).collect()[0][0] or 0) + 1, scratch(spark, "stream")
        for part in range(PARTS):
            topic.where(F.floor(F.col("source_offset") * PARTS / end) == part).write.mode("append").parquet(f"{home}/topic")
            source = spark.readStream.schema(topic.schema).parquet(f"{home}/topic")
            query = ingest.run_stream(
                source, f"{home}/out", f"{home}/offsets", landed_at=F.expr("received_at + INTERVAL 3 SECONDS"), ends=lambda s: ingest.source_ends(s.read.schema(topic.schema).parquet(f"{home}/topic"))
            )
            query.awaitTermination()
            restate.restate(spark, f"{home}/out", f"{home}/daily", RESTATED)
        _streams[key] = home
    return _streams[key]


def stream_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed, and what was refused."""
    out = f"{streamed(spark, sf_dir)}/out"
    good = ingest.landing_of(spark, out).select(*PLACE, F.lit("landed").alias("verdict"))
    return good.unionByName(ingest.dead_of(spark, out).select(*PLACE, F.col("error_code").alias("verdict")))


def stream_purged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed table after a purge of the people who left an event, and all that comes in again after it."""
    home, away = streamed(spark, sf_dir), scratch(spark, "purged")
    topic = spark.read.parquet(f"{home}/topic")
    turn = lambda name: ingest.run_stream(spark.readStream.schema(topic.schema).parquet(f"{home}/topic"), f"{away}/out", f"{away}/{name}").awaitTermination()
    turn("offsets")
    left = ingest.landing_of(spark, f"{away}/out").where("event_name = 'event_left'").select(F.lit("person").alias("kind"), F.col("subject_user_hash").alias("key"))
    purge.purge(spark, f"{away}/out", left.distinct())
    turn("offsets-of-a-replay")
    return ingest.landing_of(spark, f"{away}/out").select("event_id", "subject_user_hash")


def of(check: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: check(checked(spark, d))


# What a finding's message may not show, in the order of removal.
TERMS = (
    r"email|phone|authorization|token|api[_-]?key|cookie|signed[_-]?url|body|message|note|raw[_-]?text|raw[_-]?content|transcript|screenshot"
    r"|contact[_-]?value|reveal[_-]?value|exact[_-]?gps|latitude|longitude"
)
REDACTED = (
    rf"(?i)\b({TERMS})\b\s*[:=]\s*[^,\s;]+",
    r"(?i)\bBearer\s+[A-Za-z0-9._~+/=-]+",
    r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\b",
    r"(?i)\b(lat|latitude|lon|longitude|lng)\s*[:=]\s*-?\d+(?:\.\d+)?",
    r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    r"\+?\d[\d\s().-]{7,}\d",
    rf"(?i)({TERMS})",
)
def redact_text(text: Column, limit: int = 500) -> Column:
    for pattern in REDACTED:
        text = F.regexp_replace(text, pattern, "[redacted]")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.substring(text, 1, limit - 3)), F.lit("..."))).otherwise(text)


def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of documents, which hold personal data and secrets, as a finding's message would show them."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", redact_text(F.coalesce("text", F.lit(""))).alias("message"))


def hot_bounded_copy(spark: SparkSession, sf_dir: str, rows: int = 500) -> DataFrame:
    """The latest rows by landing time, oldest first: bounded columns only."""
    hot = frame("hot_events", {"landing": landing(spark, sf_dir)})
    return hot.orderBy(F.desc("landed_at"), F.desc("event_id")).limit(rows).orderBy("landed_at", "event_id")


def hot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hot table, rewritten by month in ranges of its key, as many as its size asks for, and read again."""
    hot = frame("hot_events", {"landing": landing(spark, sf_dir)}).withColumn("month", F.date_format("occurred_at", "yyyyMM"))
    key = ("month", "event_name", "occurred_at", "event_id")
    path = f"{scratch(spark, 'hot')}/table"
    hot.repartitionByRange(*key).sortWithinPartitions(*key).write.option("maxRecordsPerFile", 20_000_000).partitionBy("month").parquet(path)
    return spark.read.parquet(path)


def hot_table_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_table(spark, sf_dir).groupBy("month", "event_name").agg(F.count(F.lit(1)).alias("n"))


def hourly_parity(spark: SparkSession, sf_dir: str, lost: str = "false") -> DataFrame:
    """Hours in which the hot table, as it was written, has other counts than landing. lost: its rows to leave out."""
    hot = hot_table(spark, sf_dir).where(f"NOT ({lost})")
    hours = F.date_trunc("hour", "occurred_at").alias("event_hour")
    partials = hot.groupBy(hours, "event_name", "privacy_class", "source_partition").agg(F.count(F.lit(1)).alias("event_count"))
    return frame("hourly_parity", {"landing": landing(spark, sf_dir), "hourly_partials": partials})


# Columns that no published table may have.
FORBIDDEN = (
    "raw_content raw_text body message note note_body raw_note raw_note_text internal_note private_note applicant_message feedback_message search_text raw_search_text post_body comment_body"
    " reply_body dm_content transcript screenshot request_body response_body contact_value reveal_value payload_value exact_gps gps latitude longitude lat lon"
).split()
VOICE_FORBIDDEN = (
    "audio_frame spoken_words topic sentiment emotion voiceprint speaker_embedding speaker_identity speaking_timeline speaking_interval vad_frame_list co_participant_key pairwise_duration"
    " private_room_name exact_gps request_body response_body screenshot ocr raw_filename"
).split()


#: Beginnings of the names of reporting tables: stages, vault, business vault, marts, accounts and trust.
REPORTING = ("stg_", "hub_", "h_", "link_", "l_", "sat_", "br_", "pit_", "s_", "mart_", "stage_", "reconcile_", "trust_", "bdv_", "metric_", "asset_")
PRIVATE = ("voice", "recap", "privacy")


def reporting_columns(private: bool) -> list[tuple[str, str]]:
    """Table and column names of all reporting tables, or of those on voice, recaps and privacy."""
    def wanted(n: str) -> bool:
        return any(p in n for p in PRIVATE) and not n.startswith(("inv_", "lost_", "contract_", "faulty_", "guarded_")) if private else n.startswith(REPORTING)

    def columns(n: str) -> list[str]:
        m = MODELS[n]
        while not (m.after or m.group or m.columns or m.parts):
            m = MODELS[m.source]
        return list(m.after or {**m.group, **m.columns} or m.parts[0])

    return [(n, c) for n in MODELS if wanted(n) for c in columns(n)]


def projected(spark: SparkSession, sf_dir: str, private: bool, renamed: str | None = None) -> DataFrame:
    """Column names of the reporting tables, and the payload keys of the landed events, with how many rows have them.

    renamed: a name under which the key ``surface`` is shown, to see whether it is found.
    """
    parsed = frame("parsed", {"landing": landing(spark, sf_dir)})
    parsed = parsed.where("event_name LIKE 'voice%'") if private else parsed
    keys = parsed.select(F.lit("payload").alias("table_name"), F.explode(F.map_keys("doc")).alias("column_name"))
    keys = keys.withColumn("column_name", F.when(F.col("column_name") == "surface", renamed).otherwise(F.col("column_name"))) if renamed else keys
    rows = [(*r, None) for r in reporting_columns(private)]
    return keys.groupBy("table_name", "column_name").count().unionByName(spark.createDataFrame(rows, "table_name string, column_name string, count long"))


def forbidden_columns(spark: SparkSession, sf_dir: str, renamed: str | None = None) -> DataFrame:
    low = F.lower("column_name")
    return projected(spark, sf_dir, False, renamed).where(low.isin(*FORBIDDEN) | low.contains("token") | low.contains("transcript") | low.contains("screenshot"))


def voice_forbidden_columns(spark: SparkSession, sf_dir: str, renamed: str | None = None) -> DataFrame:
    low = F.lower("column_name")
    return projected(spark, sf_dir, True, renamed).where(low.isin(*VOICE_FORBIDDEN) | low.contains("transcript"))


def column_sql(private: bool, renamed: str | None = None) -> str:
    names = ", ".join(f"('{t}', '{c}')" for t, c in reporting_columns(private))
    only = " WHERE event_name LIKE 'voice%'" if private else ""
    key = f"CASE WHEN k = 'surface' THEN '{renamed}' ELSE k END" if renamed else "k"
    listed = ", ".join(f"'{c}'" for c in (VOICE_FORBIDDEN if private else FORBIDDEN))
    like = ["transcript"] if private else ["token", "transcript", "screenshot"]
    return (
        f"WITH landing AS ({landing_sql()}), found AS (SELECT 'payload' AS table_name, {key} AS column_name, count(*) AS count FROM (SELECT unnest(json_keys(payload)) AS k FROM landing{only}) GROUP BY ALL"
        f" UNION ALL SELECT t, c, NULL FROM (VALUES {names}) v(t, c))"
        f" SELECT * FROM found WHERE lower(column_name) IN ({listed}) OR " + " OR ".join(f"lower(column_name) LIKE '%{x}%'" for x in like)
    )


# Columns that the hot copy may not have.
BANNED_HOT = "subject payload email phone token request_body response_body screenshot exact_gps raw_content note_body reveal_payload".split()


def hot_bounded_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each column of the hot copy: whether it may be there, and how many rows fill it."""
    banned = BANNED_HOT
    hot = frame("hot_events", {"landing": landing(spark, sf_dir)})
    filled = hot.agg(*[F.count(c).alias(c) for c in hot.columns])
    return filled.unpivot([], hot.columns, "column_name", "filled").withColumn("allowed", ~F.col("column_name").isin(*banned))


# Privacy requests as text lines: blank, broken and unsupported ones are left out.
# Requests that run.
REQUEST_TYPES = ("account_deletion", "analytics_opt_out", "recap_opt_out", "feed_profile_reset", "kvkk_deletion_request")


#: Records of a packet, in the mean.
IN_PACKET = 1000


def packet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle records written as packets and read again; some carry a count as a text."""
    records = written(frame("privacy_packet_scan", {"landing": landing(spark, sf_dir)}), "records")
    path = f"{scratch(spark, 'packets')}/packets"
    packet = F.pmod(F.xxhash64("source_record_ref"), F.lit(records.count() // IN_PACKET + 1))
    packets.write_packets(records, packet, path, F.col("cell_count") == 17)
    return packets.read_packets(spark, path).drop("corrupt_packet")


def request_intake(lines: DataFrame) -> DataFrame:
    """``value`` (a JSON text a row) to the requests to run, once per key."""
    parsed = lines.where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    get = lambda k: F.trim(F.try_variant_get("v", f"$.{k}", "string"))
    known = parsed.select("value", get("request_type").alias("request_type"), get("request_id").alias("request_id")).where(F.col("request_type").isin(*REQUEST_TYPES))
    key = F.coalesce(F.when(F.col("request_id") != "", F.col("request_id")), F.concat(F.lit("line-"), F.sha2("value", 256)))
    return known.select(F.concat_ws(":", "request_type", key).alias("run_key"), "request_type", "request_id").dropDuplicates(["run_key"])


def request_stream(lines: DataFrame, out: str, checkpoint: str):
    """Requests from a stream of text lines, each run once: its key is kept in the state of the query, and the sink commits by batch."""
    stream = request_intake(lines).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return stream.outputMode("append").trigger(availableNow=True).start()


#: What people ask for by what they did; other events bring a line that is left out.
ASKED = {"event_left": "account_deletion", "feed_item_mute_author": "feed_profile_reset", "together_reported": "analytics_opt_out", "reaction_removed": "recap_opt_out", "event_join_failed": "kvkk_deletion_request", "screen_viewed": "unheard_of"}


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request lines: a request of a person and hour for each event of ASKED; broken and blank ones for those of sessions."""
    kind = F.coalesce(*[F.when(F.col("event_name") == e, F.lit(k)) for e, k in ASKED.items()])
    body = F.to_json(F.struct(kind.alias("request_type"), F.concat_ws(":", "subject_user_hash", F.date_format("occurred_at", "yyyyMMddHH")).alias("request_id")))
    line = F.when(kind.isNotNull(), body).when(F.col("event_name") == "channel_session_started", F.lit(" ")).when(F.col("event_name") == "channel_session_ended", F.lit('{"request_type"'))
    return landing(spark, sf_dir).select(line.alias("value")).where("value IS NOT NULL")


def privacy_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of the landed events through the stream, whose second half of the lines repeats some of the first and comes after a restart."""
    home = scratch(spark, "requests")
    lines = written(request_lines(spark, sf_dir), "lines")
    for half in range(2):
        part = lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) >= half)  # a third comes once, the others twice
        part.write.mode("append").text(f"{home}/inbox")
        request_stream(spark.readStream.text(f"{home}/inbox"), f"{home}/out", f"{home}/state").awaitTermination()
    return spark.read.parquet(f"{home}/out")


def quality_store(spark: SparkSession, sf_dir: str) -> tuple[restate.Partitioned, restate.Partitioned]:
    """Tables of runs and findings, as two runs of a check per feature and day leave them.

    The check: no event of the feature landed later than a minute after it was received.  The
    first run sees the events that landed on their own day; the second one is of days with later ones,
    and a third finds those resolved whose events were all from after noon.
    """
    home = scratch(spark, "quality")
    runs, findings = restate.Partitioned(spark, f"{home}/runs", "window_day"), restate.Partitioned(spark, f"{home}/findings", "window_day")
    rows = landing(spark, sf_dir).select("event_name", "occurred_at", "received_at", "landed_at", F.to_date("occurred_at").alias("window_day"))
    late = F.col("landed_at") > F.col("received_at") + F.expr("INTERVAL 1 MINUTE")
    for at, seen in (("2024-01-06 00:00:00", ~late), ("2024-01-07 00:00:00", F.lit(True)), ("2024-01-08 00:00:00", F.hour("occurred_at") >= 12)):
        store_run(runs, findings, rows.where(seen).groupBy("event_name", "window_day").agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("failures")), at)
    return runs, findings


def store_run(runs: restate.Partitioned, findings: restate.Partitioned, checked_days: DataFrame, at: str) -> None:
    """``checked_days`` (event_name, window_day, n, failures) go into the tables: runs and findings by id, last write wins; a finding that fails no more closes."""
    spark = checked_days.sparkSession
    day = F.date_format("window_day", "yyyy-MM-dd")
    found = checked_days.select(
        F.concat_ws(":", F.lit("quality"), day, "event_name").alias("id"), F.col("event_name").alias("contract_name"), day.alias("window_day"), F.when(F.col("failures") > 0, "failed").otherwise("passed").alias("status"),
        F.when(F.col("failures") > 0, 1).otherwise(0).alias("critical_count"), F.lit(at).cast("timestamp").alias("finished_at"), "failures",
    )
    found = written(found, "run")
    restate.upsert(runs, found.drop("failures"), "id", "finished_at")
    known = findings.read()
    new = found.where("failures > 0").select(
        F.concat("id", F.lit(":critical:1")).alias("id"), F.col("id").alias("run_id"), "window_day", F.lit("critical").alias("severity"), F.col("failures").alias("sample_count"), F.lit("open").alias("status"),
        F.col("finished_at").alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"), F.col("finished_at").alias("changed_at"),
    )
    if known is not None:
        new = new.join(known.select("id", F.col("created_at").alias("was")), "id", "left").withColumn("created_at", F.coalesce("was", "created_at")).drop("was")
        good = found.where("failures = 0").select(F.concat("id", F.lit(":critical:1")).alias("id"), F.col("finished_at").alias("at"))
        closed = known.where("status = 'open'").join(good, "id").withColumns({"status": F.lit("resolved"), "resolved_at": F.col("at"), "changed_at": F.col("at")}).drop("at")
        new = new.unionByName(closed)
    new = written(new, "findings")
    if not new.isEmpty():
        restate.upsert(findings, new, "id", "changed_at")


def evidence(spark: SparkSession, sf_dir: str, name: str = "evidence_rows") -> DataFrame:
    return frame(name, {"landing": landing(spark, sf_dir)})


def dlq_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the evidence window's prefix that landed in its time or up to five minutes after it."""
    return ev.dead_in_window(ingest.rejected(checked(spark, sf_dir)), landing(spark, sf_dir), PLACE)


def privacy_forbidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed raw envelopes whose subject or payload has a blocked key or an address, by kind."""
    rows = checked(spark, sf_dir).where("payload IS NOT NULL")
    keyed = F.coalesce(F.exists(keys_at_any_depth(F.concat_ws(",", "subject", "payload")), lambda k: k.isin(*BLOCKED)), F.lit(False))
    return rows.select(*PLACE, keyed.alias("forbidden_key"), F.concat_ws(",", "subject", "payload").contains("@").alias("address"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_event_stream": lambda spark, d: raw_events(spark, d).select("source_topic", *PLACE, F.lower(F.hex("value")).alias("value_hex")),
    "ingest_validate": of(lambda c: c.select(*PLACE, "error_code")),
    "ingest_accept": of(lambda c: ingest.accepted(c).select("event_id", "event_name", "event_version", "producer", "privacy_class", "subject_user_hash", "subject_session_id", *PLACE)),
    "ingest_reject": of(lambda c: ingest.rejected(c).select(*PLACE, "event_id", "event_name", "error_code")),
    "ingest_error_counts": of(lambda c: c.where("error_code IS NOT NULL").groupBy("error_code").count().withColumnRenamed("count", "n")),
    "ingest_safe_identity": of(lambda c: c.select(*PLACE, "safe_event_id", "safe_event_name")),
    "ingest_hashes": of(lambda c: c.select(*PLACE, "raw_record_sha256", "raw_record_bytes", "payload_sha256")),
    "dlq_sink": of(lambda c: ingest.rejected(c).select(*PLACE, "event_id", "event_name", "error_code", "error_message", "raw_record_sha256", "raw_record_bytes")),
    "dlq_topic_record": of(ingest.dlq_records),
    "landing_insert_if_absent": of(lambda c: ingest.insert_if_absent(ingest.accepted(c), None).select("event_id", *PLACE)),
    "ingest_dedupe": of(lambda c: ingest.first_arrivals(ingest.accepted(c)).select("event_id", "source_offset")),
    "ingest_checkpoint": of(ingest.checkpoints),
    "ingest_metrics": of(ingest.metrics),
    "ingest_lag": lambda spark, d: ingest.lag(raw_events(spark, d)).select(*PLACE, "last_lag"),
    "ingest_stream": stream_verdicts,
    "ingest_stream_state": lambda spark, d: ingest.state_of(spark, f"{streamed(spark, d)}/out"),
    "dlq_topic_stream": lambda spark, d: ingest.messages_of(spark, f"{streamed(spark, d)}/out").select("key", "value"),
    "hourly_rollup_stream": lambda spark, d: ingest.hours_of(spark, f"{streamed(spark, d)}/out"),
    **{f"restated_{m}": lambda spark, d, m=m: restate.Partitioned(spark, f"{streamed(spark, d)}/daily/{m}", "reporting_date").read() for m in RESTATED},
    "purged_landing": stream_purged,
    "redact_text": redacted,
    "hot_bounded_copy": hot_bounded_copy,
    "hot_table_write": hot_table_write,
    "hourly_parity": hourly_parity,
    "hourly_parity_guard": lambda spark, d: hourly_parity(spark, d, "event_name = 'screen_viewed'"),
    "hot_bounded_columns": hot_bounded_columns,
    "inv_forbidden_columns": forbidden_columns,
    "inv_voice_forbidden_columns": voice_forbidden_columns,
    "inv_forbidden_columns_guard": lambda spark, d: forbidden_columns(spark, d, "Session_Token"),
    "inv_voice_forbidden_columns_guard": lambda spark, d: voice_forbidden_columns(spark, d, "emotion"),
    "privacy_packet_scan": packet_scan,
    "privacy_request_intake": privacy_requests,
    "quality_run_upsert": lambda spark, d: quality_store(spark, d)[0].read(),
    "quality_finding_upsert": lambda spark, d: quality_store(spark, d)[1].read(),
    "evidence_forbidden_keys": lambda spark, d: evidence(spark, d).select("event_id", ev.key_hits(ev.FORBIDDEN_KEYS, True).alias("forbidden_keys")),
    "evidence_unsupported_keys": lambda spark, d: evidence(spark, d).select("event_id", ev.unsupported_keys().alias("unsupported_keys")),
    "evidence_unsafe_values": lambda spark, d: evidence(spark, d).select("event_id", ev.unsafe_values().alias("unsafe_values")),
    "evidence_dlq_count": dlq_window,
    "evidence_criteria": lambda spark, d: ev.evidence_criteria(evidence(spark, d), dlq_window(spark, d)),
    "canary_criteria": lambda spark, d: ev.canary_criteria(evidence(spark, d, "canary_rows"), dlq_window(spark, d)),
    "privacy_forbidden_scan": privacy_forbidden,
}

GOOD = f"({raw.CODE}) IS NULL"
KNOWN = f"{raw.F} NOT IN (1, 2, 3, 24)"
ID = f"CASE WHEN {KNOWN} AND {raw.F} <> 4 THEN {raw.EVENT_ID.replace('{{txt|source_offset - 23}}', '(source_offset - 23)::VARCHAR')} END"
NAME = f"CASE WHEN {KNOWN} THEN nullif(trim({raw.NAME}), '') END"
FIRST = f"SELECT arg_min(event_id, (source_partition, source_offset)) AS event_id, min((source_partition, source_offset)) AS p FROM (SELECT {ID} AS event_id, source_partition, source_offset FROM landing WHERE {GOOD}) GROUP BY event_id"
# The same where the records come in parts: an older part comes first.
TURN = f"source_offset * {PARTS} // (SELECT max(source_offset) + 1 FROM landing)"
ARRIVED = f"SELECT * EXCLUDE (e, turn) REPLACE (e AS event_id, date_trunc('second', occurred_at) AS occurred_at, date_trunc('second', received_at) + INTERVAL 3 SECOND AS landed_at) FROM (SELECT *, {ID} AS e, {TURN} AS turn FROM landing WHERE {GOOD}) QUALIFY row_number() OVER (PARTITION BY e ORDER BY turn, source_partition, source_offset) = 1"
LATE = "landed_at > received_at + INTERVAL 1 MINUTE"
CHECKED = "c AS (" + " UNION ALL ".join(
    f"SELECT event_name, strftime(occurred_at, '%Y-%m-%d') AS d, TIMESTAMP '{at}' AS seen_at, count(*) FILTER ({LATE}) AS failures FROM landing WHERE {seen} GROUP BY ALL"
    for at, seen in (("2024-01-06 00:00:00", f"NOT ({LATE})"), ("2024-01-07 00:00:00", "true"), ("2024-01-08 00:00:00", "hour(occurred_at) >= 12"))
) + ")"
DEAD = ("source_topic", *PLACE, "event_id", "event_name", "error_code", "error_message", "raw_record_sha256", "raw_record_bytes")
HASH = "'sha256:' || sha256(value)"
MESSAGE = "substr(replace(error_code, '_', ' '), 1, 500)"


def oracles() -> dict[str, str]:
    base = {"landing": landing_sql()}
    land = f"WITH landing AS ({landing_sql()})"
    bytes_ = checking_sql("raw_events", base).removesuffix("\nSELECT * FROM raw_events")
    hot = checking_sql("hot_events", base).removesuffix("SELECT * FROM hot_events")
    redact = "coalesce(text, '')"
    for pattern in REDACTED:
        redact = f"regexp_replace({redact}, '{pattern}', '[redacted]', 'g')"
    kinds, banned = (", ".join(f"'{k}'" for k in x) for x in ((*REQUEST_TYPES, "other"), BANNED_HOT))
    dead = (
        f"{bytes_}, v AS (SELECT source_offset, value FROM raw_events), d AS (SELECT source_topic, source_partition, source_offset, {ID} AS event_id, {NAME} AS event_name, {raw.CODE} AS error_code FROM landing WHERE NOT {GOOD}),"
        f" m AS (SELECT d.*, {MESSAGE} AS error_message, {HASH} AS raw_record_sha256, octet_length(value)::INTEGER AS raw_record_bytes FROM d JOIN v USING (source_offset)) "
    )
    return ev.statements(landing_sql(), (f"NOT {GOOD}", ID)) | {
        "hot_bounded_copy": f"{hot} SELECT * FROM hot_events ORDER BY landed_at DESC, event_id DESC LIMIT 500",
        "hot_table_write": f"{hot} SELECT strftime(occurred_at, '%Y%m')::INTEGER AS month, event_name, count(*) AS n FROM hot_events GROUP BY ALL",
        "redact_text": f"SELECT doc_id, CASE WHEN length(m) > 500 THEN rtrim(substr(m, 1, 497)) || '...' ELSE m END AS message FROM (SELECT doc_id, trim(regexp_replace({redact}, '\\s+', ' ', 'g')) AS m FROM documents)",
        "privacy_packet_scan": checking_sql("privacy_packet_scan", base).removesuffix("SELECT * FROM privacy_packet_scan")
        + " SELECT * REPLACE (nullif(cell_count, 17) AS cell_count), CASE WHEN cell_count = 17 THEN 'cellCount' END AS field_error FROM privacy_packet_scan",
        "privacy_request_intake": land + " SELECT DISTINCT t || ':' || r AS run_key, t AS request_type, r AS request_id FROM (SELECT CASE event_name " + " ".join(f"WHEN '{e}' THEN '{k}'" for e, k in ASKED.items() if k in REQUEST_TYPES)
        + " END AS t, subject_user_hash || ':' || strftime(occurred_at, '%Y%m%d%H') AS r FROM landing) WHERE t IS NOT NULL",
        "quality_run_upsert": f"{land}, {CHECKED}, r AS (SELECT *, row_number() OVER (PARTITION BY event_name, d ORDER BY seen_at DESC) AS k FROM c) SELECT 'quality:' || d || ':' || event_name AS id, event_name AS contract_name, d AS window_day,"
        " CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status, (failures > 0)::INT AS critical_count, seen_at AS finished_at FROM r WHERE k = 1",
        # Open since the first run that failed; as it was last seen failing; resolved by the first good run after that.
        "quality_finding_upsert": f"{land}, {CHECKED}, b AS (SELECT event_name, d, min(seen_at) FILTER (failures > 0) AS since, max(seen_at) FILTER (failures > 0) AS until, arg_max(failures, seen_at) FILTER (failures > 0) AS n FROM c GROUP BY event_name, d HAVING since IS NOT NULL),"
        " g AS (SELECT event_name, d, min(c.seen_at) AS good FROM c JOIN b USING (event_name, d) WHERE c.seen_at > b.until GROUP BY event_name, d) SELECT 'quality:' || d || ':' || event_name || ':critical:1' AS id, 'quality:' || d || ':' || event_name AS run_id, d AS window_day,"
        " 'critical' AS severity, n AS sample_count, CASE WHEN good IS NULL THEN 'open' ELSE 'resolved' END AS status, since AS created_at, good AS resolved_at, coalesce(good, until) AS changed_at FROM b LEFT JOIN g USING (event_name, d)",
        "hourly_parity_guard": land + " SELECT date_trunc('hour', occurred_at) AS event_hour, event_name, count(*) AS source_count, NULL::BIGINT AS rebuilt_count FROM landing WHERE event_name = 'screen_viewed' GROUP BY 1, 2",
        "inv_forbidden_columns": column_sql(False),
        "inv_voice_forbidden_columns": column_sql(True),
        "inv_forbidden_columns_guard": column_sql(False, "Session_Token"),
        "inv_voice_forbidden_columns_guard": column_sql(True, "emotion"),
        "hot_bounded_columns": f"{hot} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS filled, '{c}' NOT IN ({banned}) AS allowed FROM hot_events" for c in MODELS["hot_events"].columns),
        "privacy_forbidden_scan": land + f" SELECT source_partition, source_offset, {raw.F} IN (16, 18) AS forbidden_key, {raw.F} = 14 AS address FROM landing WHERE {KNOWN}",
        "dlq_topic_record": dead + f"SELECT coalesce(event_id, raw_record_sha256) AS key, to_json({{{', '.join(repr(c) + ': ' + c for c in DEAD)}}})::VARCHAR AS value FROM m",
        "source_event_stream": f"{bytes_} SELECT source_topic, source_partition, source_offset, lower(hex(value)) AS value_hex FROM raw_events",
        "ingest_validate": land + f" SELECT source_partition, source_offset, {raw.CODE} AS error_code FROM landing",
        "ingest_accept": land + f" SELECT {ID} AS event_id, event_name, 1 AS event_version, 'fixture' AS producer, 'pseudonymous' AS privacy_class, subject_user_hash, subject_session_id, source_partition, source_offset FROM landing WHERE {GOOD}",
        "ingest_reject": land + f" SELECT source_partition, source_offset, {ID} AS event_id, {NAME} AS event_name, {raw.CODE} AS error_code FROM landing WHERE NOT {GOOD}",
        "ingest_error_counts": land + f" SELECT {raw.CODE} AS error_code, count(*) AS n FROM landing WHERE NOT {GOOD} GROUP BY 1",
        "ingest_safe_identity": land + f" SELECT source_partition, source_offset, {ID} AS safe_event_id, {NAME} AS safe_event_name FROM landing",
        # The canonical payload: members in the order of their keys, without blanks.
        "ingest_hashes": f"{bytes_}, c AS (SELECT source_offset, 'sha256:' || sha256('{{' || array_to_string(list_transform(list_sort(json_keys(payload)), lambda k: '\"' || k || '\":' || json_extract(payload, '$.' || k)::VARCHAR), ',') || '}}') AS payload_sha256 FROM landing WHERE {GOOD})"
        f" SELECT source_partition, source_offset, {HASH} AS raw_record_sha256, octet_length(value)::INTEGER AS raw_record_bytes, payload_sha256 FROM raw_events LEFT JOIN c USING (source_offset)",
        "landing_insert_if_absent": land + f" SELECT event_id, p[1] AS source_partition, p[2] AS source_offset FROM ({FIRST})",
        "ingest_dedupe": land + f" SELECT event_id, p[2] AS source_offset FROM ({FIRST})",
        "ingest_checkpoint": land + " SELECT source_topic, source_partition, max(source_offset) AS last_offset FROM landing GROUP BY ALL",
        "ingest_metrics": land
        + f" SELECT source_topic, count(*) FILTER ({GOOD}) AS accepted_count, count(*) FILTER (NOT {GOOD}) AS rejected_count, count(*) FILTER ({GOOD}) - count(DISTINCT CASE WHEN {GOOD} THEN {ID} END) AS duplicate_count,"
        " arg_max(source_partition, source_offset) AS last_processed_partition, max(source_offset) AS last_processed_offset FROM landing GROUP BY source_topic",
        "ingest_lag": land + " SELECT source_partition, source_offset, max(source_offset) OVER (PARTITION BY source_topic, source_partition) - source_offset AS last_lag FROM landing",
        "ingest_stream": land + f" SELECT source_partition, source_offset, 'landed' AS verdict FROM ({ARRIVED}) UNION ALL SELECT source_partition, source_offset, {raw.CODE} FROM landing WHERE NOT {GOOD}",
        "ingest_stream_state": land + f", a AS ({ARRIVED}) SELECT 'ingest' AS consumer_group, source_topic, source_partition, count(*) FILTER ({GOOD}) AS accepted_count, count(*) FILTER (NOT {GOOD}) AS rejected_count,"
        " (SELECT count(*) FROM a WHERE a.source_partition = landing.source_partition) AS landed_count, max(source_offset) AS last_offset, 0::BIGINT AS last_lag FROM landing GROUP BY source_topic, source_partition",
        "dlq_topic_stream": dead + f"SELECT coalesce(event_id, raw_record_sha256) AS key, to_json({{{', '.join(repr(c) + ': ' + c for c in DEAD)}}})::VARCHAR AS value FROM m",
        "hourly_rollup_stream": land + f" SELECT date_trunc('hour', occurred_at) AS event_hour, event_name, privacy_class, count(*) AS event_count FROM ({ARRIVED}) GROUP BY ALL",
        **{f"restated_{m}": checking_sql(m, {"landing": f"WITH landing AS ({landing_sql()}) {ARRIVED}"}) for m in RESTATED},
        "purged_landing": land + f", f AS (SELECT {ID} AS event_id, subject_user_hash, event_name FROM landing WHERE {GOOD} QUALIFY row_number() OVER (PARTITION BY {ID} ORDER BY source_partition, source_offset) = 1)"
        " SELECT event_id, subject_user_hash FROM f WHERE subject_user_hash NOT IN (SELECT subject_user_hash FROM f WHERE event_name = 'event_left')",
        "dlq_sink": dead + f"SELECT {', '.join(c for c in DEAD if c != 'source_topic')} FROM m",
    }
