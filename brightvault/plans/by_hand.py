"""Checking statements that were written by hand, one or more for each layer.

The other statements are rendered from the models; these were not, so that they
check the rules of a model and not only its rendering.
"""

from __future__ import annotations

from brightvault.operators.contracts import RAW_KEYS, SMOKE_KEYS

PAYLOAD = "payload->>'$.{}'"


def member(key: str) -> str:
    return "(" + PAYLOAD.format(key) + ")"


DAY = "CAST(occurred_at + INTERVAL 3 HOUR AS DATE)"
CONTENT_KEY = f"coalesce({member('post_id')}, {member('item_id')}, {member('entity_id')})"
EMOJI = f"nullif(regexp_replace(lower(coalesce({member('emoji_key')}, {member('reaction_key')})), '[^a-z0-9_:-]', '', 'g'), '')"
COHORT = f"nullif(regexp_replace(lower(coalesce({member('subject_occupation_cohort_key')}, {member('occupation_cohort_key')})), '[^a-z0-9_:-]', '', 'g'), '')"
REACTED = f"""reacted AS (
  SELECT event_id, landed_at, {DAY} AS reporting_date, md5(subject_user_hash) AS person, {CONTENT_KEY} AS content, {COHORT} AS cohort,
         md5(concat_ws('||', coalesce({member('post_id')}, ''), coalesce({member('item_id')}, ''), coalesce({member('entity_id')}, ''))) AS content_hk,
         md5(concat_ws('||', event_id, {CONTENT_KEY}, coalesce({EMOJI}, ''), coalesce({member('kind')}, event_name), payload_sha256)) AS reaction_hk,
         CASE WHEN event_name = 'reaction_removed' THEN 'removed' ELSE 'added' END AS action, CASE WHEN event_name = 'reaction_removed' THEN 'negative' ELSE 'positive' END AS valence
  FROM landing WHERE event_name IN ('reaction_added', 'reaction_removed', 'feed_item_like') AND {CONTENT_KEY} IS NOT NULL)"""
SESSIONS = f"""sessions AS (
  SELECT event_id, subject_user_hash, landed_at, {DAY} AS reporting_date, {member('channel_id')} AS channel,
         concat_ws(':', coalesce(subject_session_id, event_id), {member('channel_id')}, {DAY}::VARCHAR) AS session_key, event_name,
         try_cast({member('duration_sec')} AS INTEGER)::BIGINT * 1000 AS duration_ms
  FROM landing WHERE event_name IN ('channel_session_started', 'channel_session_ended') AND {member('channel_id')} <> '')"""
VALENCE = """valences AS (
  SELECT reporting_date, valence AS reaction_valence, coalesce(cohort, 'unknown') AS occupation_cohort_key, count(*) AS n, count(*) FILTER (action = 'added') AS added, count(*) FILTER (action = 'removed') AS removed,
         count(DISTINCT person) AS people, max(landed_at) AS loaded FROM reacted GROUP BY ALL)"""
CONTRACTS = "'reaction_valence_count_daily,positive_reaction_day_daily,negative_reaction_day_daily' AS metric_contract_ids"


# Payload keys of a voice summary, in the order in which they are hashed.
VOICE = (
    "voice_session_key", "room_key", "room_type_key", "session_duration_bucket", "microphone_unmuted_duration_bucket", "unmute_count_bucket", "first_unmute_latency_bucket", "permission_state",
    "speech_activity_duration_bucket", "speech_activity_ratio_bucket", "reconnect_count_bucket", "join_failure_reason_code", "rtt_bucket", "jitter_bucket", "packet_loss_bucket",
)
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
VOICES = f"""voices AS (
  SELECT md5({member('voice_session_key')}) AS voice_session_hk, {DAY} AS reporting_date, {member('room_type_key')} AS room_type_key, {member('session_duration_bucket')} AS session_duration_bucket, {member('platform')} AS platform,
         {member('app_version')} AS app_version, coalesce({member('purpose_id')}, 'analytics.voice_usage_measurement.v1') AS purpose_id, {member('legal_basis_id')} AS legal_basis_id, {member('notice_version')} AS notice_version,
         coalesce({member('retention_policy_id')}, 'voice-summary-30d-anonymize-or-delete-v1') AS retention_policy_id, coalesce({member('record_source_mode')}, 'unknown') AS record_source_mode,
         lower({member('production_write_enabled')}) = 'true' AS production_write_enabled, landed_at AS load_datetime, 'analytics.raw_event_landing' AS record_source,
         md5(concat_ws('||', event_name, event_version::VARCHAR, {STAMP.format('occurred_at')}, {STAMP.format('received_at')}, {', '.join(f"coalesce({member(k)}, '')" for k in VOICE)}, payload_sha256, raw_record_sha256)) AS hashdiff
  FROM landing WHERE event_name = 'voice_usage_session_summary' AND json_exists(payload, '$.voice_session_key') AND json_exists(payload, '$.room_key') AND json_exists(payload, '$.room_type_key'))"""


# The landing table with the rows of a leaking client beside its own, as operators/guards.py puts them in.
LEAKED = "leaked AS (SELECT * FROM landing" + "".join(
    f" UNION ALL BY NAME SELECT * REPLACE ({value} AS {column}) FROM landing WHERE source_offset % 50 = {i}"
    for i, (column, value) in enumerate(
        [("payload", "'{\"a\": {\"body\": \"x\"}}'"), ("payload", "'{\"STAFF_ID\": 3}'"), ("subject", "'{\"user_hash\": \"h\", \"gps\": [1]}'"), ("payload", "'{\"voiceprint\": 1}'"), ("subject_user_hash", "'a@b'"),
         ("payload", "'{\"bodyguard\": \"safe\"}'"), ("received_at", "TIMESTAMP '2024-01-09 00:00:00'"), ("occurred_at", "TIMESTAMP '2019-12-31 00:00:00'"), ("privacy_class", "'identified'"), ("event_id", "NULL")], 1)
) + ")"


def leaks(keys: list[str]) -> str:
    """A row that shows a key, found as a quoted word and not by a pattern."""
    return f"contains(subject_user_hash, '@') OR list_bool_or(list_transform([{', '.join(repr(k.lower()) for k in keys)}], lambda k: contains(lower(subject), '\"' || k || '\"') OR contains(lower(payload), '\"' || k || '\"')))"


TIMES = "occurred_at IS NULL OR received_at IS NULL OR occurred_at - received_at > INTERVAL 5 MINUTE OR year(occurred_at) < 2020 OR received_at > TIMESTAMP '2024-01-04 12:05:00'"


def landing_contract(table: str) -> str:
    checks = {
        "row_count_all": ("row_count", None, "(count(*) = 0)::INT"), "failed_rows_valid_timestamps": ("failed_rows", None, f"count(*) FILTER ({TIMES})"),
        "failed_rows_no_raw_identifiers": ("failed_rows", None, f"count(*) FILTER ({leaks(RAW_KEYS)})"), "missing_event_id": ("missing", "event_id", "count(*) - count(event_id)"),
        "duplicate_event_id": ("duplicate", "event_id", "count(event_id) - count(DISTINCT event_id)"), "invalid_privacy_class": ("invalid", "privacy_class", "count(*) FILTER (privacy_class <> 'pseudonymous')"),
    }
    rows = " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{k}' AS kind, {f"'{c}'" if c else 'NULL'} AS column_name, {e}::BIGINT AS failed_count FROM {table}" for n, (k, c, e) in checks.items())
    return f"SELECT 'contract_landing' AS contract_name, *, CASE WHEN failed_count > 0 THEN 'failed' ELSE 'passed' END AS status FROM ({rows})"


def smoke(table: str) -> str:
    return (
        "SELECT count(*) AS row_count, count(event_id) - count(DISTINCT event_id) AS duplicate_event_ids, count(*) - count(event_id) AS null_event_ids,"
        f" count(*) FILTER ({TIMES}) AS bad_timestamps, count(*) FILTER (privacy_class <> 'pseudonymous') AS bad_privacy_class, count(*) FILTER ({leaks(SMOKE_KEYS)}) AS raw_identifier_rows FROM {table}"
    )


#: Which events a stage takes, and what they must have to stay.
TAKEN = {
    "stg_content_events": ("(event_name IN ('reaction_added', 'reaction_removed', 'reply_created', 'post_impression') OR starts_with(event_name, 'feed_item_'))", f"{CONTENT_KEY} IS NOT NULL"),
    "stg_reactions": ("event_name IN ('reaction_added', 'reaction_removed', 'feed_item_like')", f"{CONTENT_KEY} IS NOT NULL"),
    "stg_feed_events": ("starts_with(event_name, 'feed_item_')", f"coalesce({member('item_id')}, {member('entity_id')}) IS NOT NULL"),
    "stg_channel_sessions": ("event_name IN ('channel_session_started', 'channel_session_ended')", f"{member('channel_id')} <> ''"),
    "stg_event_funnel": ("starts_with(event_name, 'event_')", f"coalesce({member('event_id')}, {member('community_event_id')}, {member('entity_id')}) IS NOT NULL"),
    "stg_together_items": ("starts_with(event_name, 'together_')", "true"),
}
OFFERED = "offered AS (" + " UNION ALL ".join(f"SELECT '{m}' AS m, event_id, {DAY} AS d, coalesce({stays}, false) AS stays FROM landing WHERE {takes}" for m, (takes, stays) in TAKEN.items()) + ")"
# A lifecycle record per event, checked; its rare cells need twenty people, the others ten.
CANDIDATES = """records AS (
  SELECT 'rec:' || event_id AS ref, source_offset AS n, occurred_at, source_offset % 31 - 1 AS people, source_offset % 7 <> 0 AS free, source_offset % 3 = 0 AS rare, source_offset % 4 AS state,
         CASE source_offset % 9 WHEN 0 THEN 'analytics_opt_out' WHEN 1 THEN 'account_deletion' WHEN 2 THEN 'recap_opt_out' WHEN 3 THEN 'feed_profile_reset' END AS request, event_name
  FROM landing WHERE source_offset % 53 <> 0 AND source_offset % 6 > 0 AND source_offset % 31 > 0 AND source_offset % 9 <> 4),
candidates AS (SELECT *, free AND people >= CASE WHEN rare THEN 20 ELSE 10 END AS good FROM records WHERE n % 5 <> 0 AND occurred_at + to_days((n % 6)::INT) <= TIMESTAMP '2024-01-05 00:00:00')"""


def by_hand(landing: str) -> dict[str, str]:
    base = f"WITH landing AS ({landing}), "
    loads = "min(landed_at) AS load_datetime, 'analytics.raw_event_landing' AS record_source"
    return {
        "contract_landing": base + f"x AS (SELECT 1) {landing_contract('landing')}",
        "contract_landing_guard": base + f"{LEAKED} {landing_contract('leaked')}",
        "landing_smoke_metrics": base + f"x AS (SELECT 1) {smoke('landing')}",
        "landing_smoke_metrics_guard": base + f"{LEAKED} {smoke('leaked')}",
        "stage_reconciliation": base + OFFERED
        + " SELECT m AS source_model, d AS reporting_date, count(*) AS accepted_source_count, count(DISTINCT event_id) AS accepted_source_distinct_event_count, count(*) FILTER (stays) AS row_count,"
        " count(DISTINCT event_id) FILTER (stays) AS distinct_event_count, count(*) FILTER (NOT stays) AS expected_excluded_count, 0::BIGINT AS missing_business_key_count, 0::BIGINT AS expected_rejected_count,"
        " 0::BIGINT AS expected_dlq_count, 0::BIGINT AS expected_deduplicated_replay_count, 0::BIGINT AS expected_suppression_count, 'Europe/Istanbul' AS reporting_timezone, 'accepted_landing_to_stage' AS accounting_scope,"
        " 'analytics.raw_event_landing' AS source_relation, m AS target_relation, 0::BIGINT AS unexplained_delta, 'explained' AS reconciliation_status FROM offered GROUP BY m, d",
        "privacy_purge_refs": base + CANDIDATES + " SELECT ref AS source_record_ref FROM candidates WHERE state < 3 UNION SELECT ref FROM records WHERE request IS NOT NULL",
        "privacy_published_aggregates": base + CANDIDATES
        + " SELECT 'source-bound-anon-candidate:' || ref AS candidate_id, ref AS source_record_ref, 'group:' || event_name AS anonymous_group, people::INT AS cell_count, 'evidence:' || replace(ref, 'rec:', '') AS evidence_id FROM candidates WHERE good",
        "privacy_decision_counts": base + CANDIDATES
        + ", a AS (SELECT 'retention_candidate_identified' AS action, ref FROM candidates UNION ALL SELECT CASE WHEN good THEN 'anonymous_candidate_check_passed' ELSE 'anonymous_candidate_check_failed' END, ref FROM candidates"
        " UNION ALL SELECT 'anonymization_failure_incident_recorded', ref FROM candidates WHERE NOT good UNION ALL SELECT 'anonymous_aggregate_published', ref FROM candidates WHERE good"
        " UNION ALL SELECT 'personal_or_pseudonymous_state_purged', ref FROM (SELECT ref FROM candidates WHERE state < 3 UNION SELECT ref FROM records WHERE request IS NOT NULL) UNION ALL SELECT 'cleanup_' || request, ref FROM records WHERE request IS NOT NULL)"
        " SELECT action, count(*) AS n, count(DISTINCT ref) AS records FROM a GROUP BY action",
        "hourly_rollup_merge": base + "x AS (SELECT 1) SELECT time_bucket(INTERVAL 1 HOUR, occurred_at) AS event_hour, event_name, privacy_class, count(*) AS event_count FROM landing GROUP BY ALL",
        "reporting_date": base + f"x AS (SELECT 1) SELECT event_id, occurred_at, {DAY} AS reporting_date FROM landing",
        "hub_reporting_reaction": base + REACTED + f" SELECT reaction_hk, event_id AS reaction_business_key, {loads} FROM reacted GROUP BY ALL",
        "link_reaction_content": base + REACTED + f" SELECT md5(reaction_hk || '||' || content_hk) AS link_hk, reaction_hk, content_hk, {loads} FROM reacted GROUP BY reaction_hk, content_hk",
        "l_user_channel_session": base + SESSIONS
        + f", keyed AS (SELECT md5(subject_user_hash) AS subject_user_hk, md5(channel) AS channel_hk, md5(session_key) AS channel_session_hk, {loads} FROM sessions GROUP BY 1, 2, 3)"
        " SELECT md5(subject_user_hk || '||' || channel_hk || '||' || channel_session_hk) AS link_hk, * FROM keyed",
        "sat_voice_usage": base + VOICES + " SELECT * FROM voices",
        "s_reaction_valence_daily": base + REACTED + ", " + VALENCE
        + " SELECT reporting_date, reaction_valence, occupation_cohort_key, n AS reaction_valence_count, added AS added_reaction_count, removed AS removed_reaction_count, people AS distinct_actor_count,"
        " CASE WHEN people < 10 THEN 'suppress_before_pl' ELSE 'reportable' END AS small_cell_suppression_status, 'partial' AS source_completeness_label, 'explicit-signal-only' AS wording_status,"
        f" {CONTRACTS}, loaded AS load_datetime, 'analytics.raw_event_landing' AS record_source FROM valences",
        "mart_reaction_valence_daily": base + REACTED + ", " + VALENCE
        + " SELECT reporting_date, reaction_valence, occupation_cohort_key, n AS reaction_valence_count, added AS added_reaction_count, removed AS removed_reaction_count,"
        f" {CONTRACTS}, 'partial' AS source_completeness_label, 'explicit-signal-only' AS wording_status, 'Europe/Istanbul' AS reporting_timezone, loaded AS refreshed_at FROM valences WHERE people >= 10",
    }
