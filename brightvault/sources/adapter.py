"""The test events as a landing table: the same rules for both engines.

The events of ``events.parquet`` become accepted envelopes.  Ten days of them
are pressed into one, so that daily cells hold enough people; each thirty-seventh
event lands a day late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightvault.functions.dialect import DUCK, SPARK, render
from brightvault.sources import shared

#: Event names by type: the name holds below the bound of k.
NAMES = {
    "view": ((30, "post_impression"), (50, "feed_item_impression"), (60, "feed_item_viewable_impression"), (75, "event_card_impression"), (90, "event_viewed"), (100, "voice_usage_session_summary")),
    "click": ((30, "reaction_added"), (45, "feed_item_open"), (55, "reply_created"), (65, "feed_item_hide"), (75, "event_interested"), (85, "channel_session_started"), (100, "together_opened")),
    "purchase": ((30, "feed_item_like"), (45, "event_joined"), (60, "event_join_attempted"), (75, "channel_session_ended"), (90, "together_response_added"), (100, "together_created")),
    "signup": ((25, "reaction_added"), (40, "channel_session_ended"), (55, "event_interested"), (70, "together_invite_sent"), (85, "feed_item_share"), (94, "screen_viewed"), (100, "app_session_started")),
    "error": ((30, "reaction_removed"), (45, "feed_item_not_interested"), (60, "event_join_failed"), (75, "event_left"), (90, "together_reported"), (100, "feed_item_mute_author")),
}
#: What members of staff do instead of some of these.
STAFF = "user_id % 15 = 7"
STAFF_NAMES = {
    "view": ((100, "admin_surface_viewed"),),
    "click": ((100, "admin_action_visibility_viewed"),),
    "signup": ((100, "admin_note_metadata_recorded"),),
    "error": ((100, "admin_reveal_audit_recorded"),),
}
EVENT_NAME = "CASE " + " ".join(f"WHEN {STAFF} AND event_type = '{t}' AND k < {b} THEN '{n}'" for t, bounds in STAFF_NAMES.items() for b, n in bounds) + " " + " ".join(f"WHEN event_type = '{t}' AND k < {b} THEN '{n}'" for t, bounds in NAMES.items() for b, n in bounds) + " END"
#: 2024-01-01 00:00 and 06:00 in microseconds.
T0, T6 = 1704067200000000, 1704088800000000


def pair(key: str, value: str, quoted: bool = True) -> str:
    """SQL for a JSON member."""
    mark = "'\"', " if quoted else ""
    return f"concat('\"{key}\": ', {mark}{value}{', ' + mark.rstrip(', ') if quoted else ''})"


def members(when: str, *pairs: str) -> str:
    return f"CASE WHEN {when} THEN concat_ws(', ', {', '.join(pairs)}) END"


K, ID, V = "{{txt|k}}", "{{txt|id % 3}}", "{{txt|v}}"
PAYLOAD = ", ".join(
    [
        members("event_name NOT LIKE 'admin_%'", pair("surface", "'home'"), pair("source", "concat('s', {{txt|k % 2}})"), pair("occupation_cohort_key", "concat('Cohort ', {{txt|id % 2}})")),
        members("event_name LIKE 'feed_item_%' OR event_name IN ('screen_viewed', 'app_session_started')", pair("client", "CASE WHEN user_id % 2 = 0 THEN '{\"platform\": \"ios\", \"version\": \"1.0\"}' ELSE '{\"platform\": \"android\"}' END", False)),
        members("event_name LIKE 'admin_%'", pair("admin_surface", "'members'"), pair("module_key", "CASE WHEN event_name = 'admin_surface_viewed' AND id % 7 = 0 THEN 'see https://x.example' ELSE concat('m', {{txt|id % 3}}) END"), pair("screen_key", "'list'")),
        members("event_name = 'admin_surface_viewed'", pair("result_state", "'ok'"), pair("role_scope_key", "'r1'"), "CASE WHEN id % 5 = 0 THEN '\"extra_key\": 1' END"),
        members("event_name = 'admin_action_visibility_viewed'", pair("action_key", "'mute'"), pair("action_surface", "'row'"), pair("target_type", "'member'"), pair("target_hash", "CASE WHEN id % 6 = 0 THEN 'md5:1' ELSE concat('sha256:t', {{txt|id % 4}}) END"), "CASE WHEN id % 5 = 1 THEN '\"reason\": \"none\"' END"),
        members("event_name = 'admin_reveal_audit_recorded'", pair("reveal_field_class", "'contact'"), pair("reveal_result", "'shown'"), pair("audit_receipt_hash", "concat('sha256:a', {{txt|id % 9}})")),
        members("event_name = 'admin_note_metadata_recorded'", pair("note_surface", "'member'"), pair("note_type", "'short'"), pair("has_attachment", "'true'", False)),
        members("event_name LIKE 'feed_item_%'", pair("item_id", f"concat('i', {ID})"), pair("dwell_ms", "{{txt|10 * k}}"), pair("feed_mode", "'for_you'")),
        members("event_name LIKE 'feed_item_%' AND k % 2 = 0", pair("visible_duration_ms", "'900'", False), pair("visible_percent_max", "'80'", False), pair("source_bucket", "'b'"), pair("reason_key", "'r'"), pair("candidate_set_id", "'cs'")),
        members("event_name IN ('reaction_added', 'reaction_removed', 'reply_created', 'post_impression')", pair("post_id", ID, False), pair("emoji_key", "CASE WHEN k % 2 = 0 THEN 'Like!' ELSE 'heart' END")),
        members("event_name LIKE 'event_%'", pair("event_id", "concat('ev', {{txt|id % 4}})"), pair("visible_pct", "'50'", False), pair("visible_ms", V)),
        members("event_name LIKE 'together_%'", pair("together_item_id", f"concat('t', {ID})"), pair("activity_type", "'study'"), pair("status", "'open'"), pair("visibility", "CASE WHEN k % 2 = 0 THEN 'public' ELSE 'friends' END"), pair("invite_count", "{{txt|k % 5}}"), pair("response_count", "{{txt|k % 3}}", False)),
        members("event_name = 'voice_usage_session_summary'", pair("voice_session_key", "concat('vs', {{txt|id % 50}})"), pair("room_key", f"concat('r', {ID})"), pair("room_type_key", "'study'"), pair("platform", "'ios'"), pair("app_version", "'1.0'"), pair("speech_activity_duration_bucket", "'none'"), pair("record_source_mode", "'synthetic_fixture'")),
        members("event_name = 'voice_usage_session_summary' AND k % 2 = 0", pair("production_write_enabled", "'false'"), pair("never_unmuted", "'true'", False)),
        members("event_name LIKE 'channel_%' OR event_name IN ('reply_created', 'together_opened')", pair("channel_id", "CASE WHEN k % 7 = 0 THEN '' ELSE concat('c', {{txt|id % 2}}) END"), pair("duration_sec", V)),
    ]
)

_SPARK = SPARK | {
    "micros": "unix_micros(CAST({0} AS TIMESTAMP))",
    "time": "timestamp_micros({0})",
    "idiv": "({0} DIV {1})",
    "props_k": "CAST(get_json_object(props, '$.k') AS INT)",
    "seconds": "{0} + make_dt_interval(0, 0, 0, {1})",
}
_DUCK = DUCK | {
    "micros": "epoch_us({0})",
    "time": "make_timestamp({0})",
    "idiv": "({0} // {1})",
    "props_k": "CAST(json_extract_string(props, '$.k') AS INTEGER)",
    "seconds": "{0} + to_seconds({1})",
}

#: Columns in steps: each step may use those before.
STEPS = (
    {"id": "event_id", "user_id": "user_id", "event_type": "event_type", "k": "{{props_k|}}", "v": "CAST(floor(value) AS BIGINT)", "occurred_at": "{{time|%d + {{idiv|({{micros|ts}} - %d);;10}}}}" % (T6, T0)},
    {c: c for c in ("id", "user_id", "k", "v", "occurred_at")} | {"event_name": EVENT_NAME},
    {c: c for c in ("id", "user_id", "occurred_at", "event_name")} | {"payload": "concat('{', concat_ws(', ', " + PAYLOAD + "), '}')"},
    {
        "event_id": "concat('ev-', {{txt|id}})",
        "event_name": "event_name",
        "event_version": "1",
        "occurred_at": "occurred_at",
        "received_at": "{{seconds|occurred_at;;2}}",
        "producer": "'fixture'",
        "privacy_class": "'pseudonymous'",
        "consent_scope": "CASE WHEN id % 101 = 0 THEN '[\"analytics\", \"analytics_opt_out\"]' ELSE '[\"analytics\"]' END",
        "subject": "concat('{\"user_hash\":\"sha256:u', {{txt|user_id}}, '\"', CASE WHEN id % 10 = 0 THEN '' ELSE concat(',\"session_id\":\"s', {{txt|user_id}}, '\"') END, '}')",
        "subject_user_hash": "concat('sha256:u', {{txt|user_id}})",
        "subject_session_id": "CASE WHEN id % 10 <> 0 THEN concat('s', {{txt|user_id}}) END",
        "payload": "payload",
        "source_topic": "'fixture.v1'",
        "source_partition": "CAST(id % 4 AS INT)",
        "source_offset": "id",
        "raw_record_sha256": "concat('sha256:', {{sha|concat('raw', {{txt|id}})}})",
        "raw_record_bytes": "256",
        "payload_sha256": "concat('sha256:', {{sha|payload}})",
        "landed_at": "{{seconds|occurred_at;;CASE WHEN id % 37 = 0 THEN 86400 ELSE 5 END}}",
    },
)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 landing columns, a row per event."""
    df = spark.read.parquet(events(sf_dir))
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:  # one small file would keep one core busy; large tables are left as they are
        df = df.repartition(cores)
    for step in STEPS:
        df = df.select(*[F.expr(render(e, _SPARK)).alias(c) for c, e in step.items()])
    return df


def events(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table as a table: written once per application and version of the input, then read.

    Derived on the fly, each filter on a landed column would be pushed into the
    derivation and repeat it; a stored table takes the filter at its scan.  It is
    in the order of time, so that a scan skips what lies outside a window of it.
    """

    def make() -> DataFrame:
        return landing(spark, sf_dir).repartitionByRange("occurred_at").sortWithinPartitions("occurred_at")

    return shared.stored(spark, events(sf_dir), "landing", make)


def landing_sql() -> str:
    sql = "events"
    for step in STEPS:
        sql = "(SELECT " + ", ".join(f"{render(e, _DUCK)} AS {c}" for c, e in step.items()) + f" FROM {sql})"
    return sql[1:-1]
