"""Typed projections of the landing table, one per event family."""

from __future__ import annotations

from brightvault.plans.model import Model, add, same

# Event names by family.
CONTENT = (
    "reaction_added", "reaction_removed", "reply_created", "post_impression", "feed_item_impression",
    "feed_item_viewable_impression", "feed_item_open", "feed_item_like", "feed_item_reply", "feed_item_join",
    "feed_item_share", "feed_item_copy_link", "feed_item_hide", "feed_item_show_less",
    "feed_item_not_interested", "feed_item_mute_author", "feed_item_mute_channel",
)
FUNNEL = (
    "event_card_impression", "event_viewed", "event_detail_engagement", "event_interested", "event_uninterested", "event_join_attempted", "event_joined",
    "event_join_failed", "event_join_abandoned", "event_left", "event_cancel_reason_submitted", "event_reminder_set", "event_calendar_added", "event_shared",
    "event_invite_sent", "event_waitlist_joined", "event_waitlist_left", "event_check_in", "event_attendance_confirmed", "event_no_show_inferred",
)
REACTIONS = ("reaction_added", "reaction_removed", "feed_item_like")
CHANNEL = ("channel_session_started", "channel_session_ended")
LIKED = ("feed_item_like", "feed_item_reply", "feed_item_join", "feed_item_share")
REFUSED = ("feed_item_hide", "feed_item_show_less", "feed_item_not_interested", "feed_item_mute_author", "feed_item_mute_channel")
RECORD_SOURCE = "'analytics.raw_event_landing'"


def names(*values: str) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def text(*keys: str) -> dict[str, str]:
    """Payload members as text, under their own names."""
    return {k: f"{{{{text|{k}}}}}" for k in keys}


def counts(**columns: str) -> dict[str, str]:
    return {c: f"{{{{count_of|{k}}}}}" for c, k in columns.items()}


def first_of(*keys: str, last: str | None = None) -> str:
    return "coalesce(" + ", ".join([f"{{{{text|{k}}}}}" for k in keys] + ([last] if last else [])) + ")"


def hashdiff(*parts: str, head: tuple[str, ...] = ()) -> str:
    """md5 over name, version and times, then ``parts`` (payload keys), then the two record hashes."""
    times = ("event_name", "{{txt|event_version}}", "{{stamp|occurred_at}}", "{{stamp|received_at}}")
    keys = tuple(f"coalesce({{{{text|{k}}}}}, '')" for k in parts)
    return "md5(concat_ws('||', " + ", ".join(times + head + keys + ("payload_sha256", "raw_record_sha256")) + "))"


#: What every projection carries of the envelope, and its lineage.
ENVELOPE = {
    "reporting_date": "{{day|occurred_at}}",
    **same("event_name event_version occurred_at received_at producer privacy_class consent_scope subject_user_hash"),
    "subject_user_hk": "md5(subject_user_hash)",
    **same("subject_session_id source_topic source_partition source_offset raw_record_sha256 payload_sha256 landed_at"),
    "load_datetime": "landed_at",
    "record_source": RECORD_SOURCE,
}
EVENT = {"event_id": "event_id", "event_hk": "md5(event_id)"}
COHORT = "{{token|%s}}" % first_of("subject_occupation_cohort_key", "occupation_cohort_key")
CONTENT_KEY = first_of("post_id", "item_id", "entity_id")
ITEM_KEY = first_of("item_id", "entity_id")
FUNNEL_KEY = first_of("event_id", "community_event_id", "entity_id")


def every(*keys: str) -> str:
    return " AND ".join(f"{{{{key|{k}}}}}" for k in keys)


#: Landed events with the payload parsed once, as text by key.
LANDING = (
    "event_id event_name event_version occurred_at received_at producer privacy_class consent_scope subject subject_user_hash"
    " subject_session_id payload source_topic source_partition source_offset raw_record_sha256 raw_record_bytes payload_sha256 landed_at"
)
add("parsed", Model("landing", {**same(LANDING), "doc": "{{doc|payload}}"}))

add(
    "stg_analytics_events",
    Model(
        "landing",
        {
            **EVENT,
            **{k: v for k, v in ENVELOPE.items() if k not in ("reporting_date", "subject_user_hk")},
            "raw_record_bytes": "raw_record_bytes",
            "event_hashdiff": hashdiff(head=("producer", "privacy_class", "consent_scope", "subject_user_hash", "coalesce(subject_session_id, '')")),
        },
    ),
)

add(
    "stg_content_events",
    Model(
        "parsed",
        {
            **EVENT,
            "content_hk": "md5(concat_ws('||', " + ", ".join(f"coalesce({{{{text|{k}}}}}, '')" for k in ("post_id", "item_id", "entity_id")) + "))",
            "content_business_key": CONTENT_KEY,
            "content_type": first_of("item_type", "target_type", last="'post'"),
            "channel_business_key": "{{present|channel_id}}",
            "channel_hk": "md5({{present|channel_id}})",
            **ENVELOPE,
            **text("surface", "feed_mode", "reason_key"),
            "action_source": "{{text|source}}",
            "feed_kind": "{{text|kind}}",
            "occupation_cohort_key": COHORT,
            "emoji_key": "{{token|%s}}" % first_of("emoji_key", "reaction_key"),
            "reaction_valence": f"CASE WHEN event_name IN {names('reaction_added', *LIKED)} THEN 'positive' WHEN event_name IN {names('reaction_removed', *REFUSED)} THEN 'negative' ELSE 'neutral' END",
            "content_event_hashdiff": hashdiff(
                "surface", "source", "kind", "feed_mode", "subject_occupation_cohort_key", "occupation_cohort_key", "emoji_key", "reaction_key",
                head=("producer", "privacy_class", "coalesce(subject_user_hash, '')", "coalesce(subject_session_id, '')"),
            ),
            "source_completeness_input": "CASE WHEN event_name LIKE 'feed_item_%' THEN 'accepted_feed_event' WHEN event_name LIKE 'reaction_%' THEN 'accepted_reaction_event'"
            " WHEN event_name = 'reply_created' THEN 'accepted_reply_event' WHEN event_name = 'post_impression' THEN 'accepted_impression_event' ELSE 'accepted_content_event' END",
        },
        where=f"event_name IN {names(*CONTENT)} AND {CONTENT_KEY} IS NOT NULL",
    ),
)

KIND = "coalesce(feed_kind, event_name)"
add(
    "stg_reactions",
    Model(
        "stg_content_events",
        {
            **same("event_id event_hk content_hk content_business_key content_type channel_hk channel_business_key reporting_date"),
            "reaction_hk": f"md5(concat_ws('||', event_id, content_business_key, coalesce(emoji_key, ''), {KIND}, coalesce(payload_sha256, '')))",
            "reaction_action": "CASE event_name WHEN 'reaction_removed' THEN 'removed' ELSE 'added' END",
            "reaction_kind": KIND,
            "reaction_key": "coalesce(emoji_key, nullif({{drop|%s;;^feed_item_}}, ''))" % KIND,
            "emoji_key": "emoji_key",
            "emoji_business_key": "emoji_key",
            **same("reaction_valence occupation_cohort_key surface action_source feed_mode reason_key"),
            **{k: k for k in ENVELOPE if k != "reporting_date"},
            "reaction_hashdiff": "md5(concat_ws('||', event_name, {{txt|event_version}}, {{stamp|occurred_at}}, {{stamp|received_at}}, content_business_key, "
            + ", ".join(f"coalesce({c}, '')" for c in ("occupation_cohort_key", "emoji_key", "reaction_valence"))
            + f", {KIND}, "
            + ", ".join(f"coalesce({c}, '')" for c in ("surface", "action_source", "feed_mode"))
            + ", payload_sha256, raw_record_sha256))",
        },
        where=f"event_name IN {names(*REACTIONS)}",
    ),
)

SERVED = ("visible_duration_ms", "visible_percent_max", "dwell_ms", "source_bucket", "reason_key", "candidate_set_id")
FEED_TEXT = (
    "item_type", "feed_mode", "surface", "source_bucket", "reason_key", "candidate_set_id", "model_version", "feature_schema_version",
    "score_bucket", "fallback_reason", "rollback_state", "assignment_bucket", "holdout_bucket", "shadow_mode", "action_source",
)
FEED_COUNTS = ("position", "page_depth", "page_size", "visible_duration_ms", "visible_percent_max", "dwell_ms")
add(
    "stg_feed_events",
    Model(
        "parsed",
        {
            **EVENT,
            "feed_item_hk": f"md5(concat_ws(':', event_id, {ITEM_KEY}))",
            "feed_request_hk": "md5(%s)" % first_of("request_id", "candidate_set_id", last="event_id"),
            "content_hk": f"md5({ITEM_KEY})",
            "content_business_key": ITEM_KEY,
            "feed_item_business_key": f"concat_ws(':', event_id, {ITEM_KEY})",
            **text(*FEED_TEXT),
            "feed_kind": "{{text|kind}}",
            "occupation_cohort_key": COHORT,
            "interest_proxy_valence": f"CASE WHEN event_name IN {names('feed_item_open', *LIKED)} THEN 'positive_interest' WHEN event_name IN {names(*REFUSED)} THEN 'negative_interest' ELSE 'neutral_interest' END",
            **counts(**{c: c for c in FEED_COUNTS}),
            **ENVELOPE,
            "feed_event_hashdiff": hashdiff(
                "item_id", "kind", "feed_mode", "surface", "source_bucket", "reason_key", "candidate_set_id", "rollback_state",
                "assignment_bucket", "holdout_bucket", "shadow_mode", "subject_occupation_cohort_key", "occupation_cohort_key",
            ),
            "source_completeness_input": f"CASE WHEN NOT ({every(*SERVED)}) THEN 'partial' WHEN {{{{key|subject_occupation_cohort_key}}}} OR {{{{key|occupation_cohort_key}}}} THEN 'source_complete_with_occupation_cohort' ELSE 'source_complete_candidate' END",
        },
        where=f"event_name LIKE 'feed_item_%' AND {ITEM_KEY} IS NOT NULL",
    ),
)

SESSION = "concat_ws(':', coalesce(subject_session_id, event_id), {{present|channel_id}}, {{date_text|{{day|occurred_at}}}})"
add(
    "stg_channel_sessions",
    Model(
        "parsed",
        {
            **EVENT,
            "channel_hk": "md5({{present|channel_id}})",
            "channel_business_key": "{{present|channel_id}}",
            "channel_session_hk": f"md5({SESSION})",
            "channel_session_business_key": SESSION,
            "channel_session_action": "CASE event_name WHEN 'channel_session_started' THEN 'started' WHEN 'channel_session_ended' THEN 'ended' ELSE 'unknown' END",
            "entry_source": "{{text|source}}",
            "exit_reason": "{{text|reason}}",
            "duration_ms": "coalesce({{long|{{count_of|duration_ms}}}}, {{long|{{count_of|duration_sec}}}} * 1000)",
            **counts(unread_count_on_enter="unread_count_on_enter", posts_seen_count="posts_seen", comments_written_count="comments_written", reactions_added_count="reactions_added"),
            **ENVELOPE,
            "channel_session_hashdiff": hashdiff("source", "reason", "duration_ms", "duration_sec", head=("{{present|channel_id}}",)),
            "source_completeness_input": "CASE WHEN event_name = 'channel_session_ended' AND (coalesce({{like|{{text|duration_ms}};;^[0-9]+$}}, false) OR coalesce({{like|{{text|duration_sec}};;^[0-9]+$}}, false)) THEN 'source_complete' ELSE 'partial' END",
        },
        where=f"event_name IN {names(*CHANNEL)} AND {{{{present|channel_id}}}} IS NOT NULL",
    ),
)

add(
    "stg_event_funnel",
    Model(
        "parsed",
        {
            **EVENT,
            "community_event_hk": f"md5({FUNNEL_KEY})",
            "community_event_business_key": FUNNEL_KEY,
            "event_funnel_action_hk": f"md5(concat_ws(':', event_id, {FUNNEL_KEY}, event_name))",
            "event_funnel_action": "{{drop|event_name;;^event_}}",
            **text("surface", "request_id", "reason_key", "capacity_state", "previous_participation_state", "participation_state", "seconds_until_start_bucket"),
            "action_source": "{{text|source}}",
            **counts(rank="rank", visible_pct="visible_pct", visible_ms="visible_ms", duration_ms="duration_ms"),
            **ENVELOPE,
            "event_funnel_hashdiff": hashdiff("event_id", "community_event_id", "entity_id", "surface", "source", "request_id", "reason_key", "capacity_state", "participation_state"),
            "source_completeness_input": f"CASE WHEN event_name = 'event_card_impression' AND {every('visible_pct', 'visible_ms')} THEN 'source_complete'"
            f" WHEN event_name IN {names('event_joined', 'event_left', 'event_interested', 'event_uninterested')} AND {every('source')} THEN 'source_complete' ELSE 'partial' END",
        },
        where=f"event_name IN {names(*FUNNEL)} AND {FUNNEL_KEY} IS NOT NULL",
    ),
)

ITEM = first_of("together_item_id", "item_id", "post_id", "activity_id", last="event_id")
TARGET = first_of("target_id", "linked_event_id", "channel_id", "post_id", "activity_id", "together_item_id", last="event_id")
LINKED = first_of("linked_event_id", "event_id")
add(
    "stg_together_items",
    Model(
        "parsed",
        {
            **EVENT,
            "together_item_hk": f"md5({ITEM})",
            "together_item_business_key": ITEM,
            "together_target_hk": f"md5({TARGET})",
            "together_target_business_key": TARGET,
            "linked_event_hk": f"md5({LINKED})",
            "linked_event_business_key": LINKED,
            "channel_hk": "md5({{present|channel_id}})",
            "channel_business_key": "{{present|channel_id}}",
            "together_action": "{{drop|event_name;;^together_}}",
            **text("activity_type", "visibility", "response_type", "report_category", "response_latency_bucket"),
            "together_status": "{{text|status}}",
            "action_source": "{{text|source}}",
            **counts(invite_count="invite_count", response_count="response_count"),
            **ENVELOPE,
            "together_metadata_hashdiff": hashdiff("together_item_id", "activity_type", "visibility", "status", "source", "response_type", "report_category"),
            "source_completeness_input": "CASE WHEN event_name IN ('together_created', 'together_response_added') AND ({{key|activity_type}} OR {{key|status}}) THEN 'source_complete' ELSE 'partial' END",
        },
        where="event_name LIKE 'together_%'",
    ),
)

VOICE_TEXT = (
    "voice_session_key", "room_key", "room_type_key", "session_duration_bucket", "microphone_unmuted_duration_bucket", "unmute_count_bucket",
    "first_unmute_latency_bucket", "permission_state", "speech_activity_duration_bucket", "speech_activity_ratio_bucket", "reconnect_count_bucket",
    "join_failure_reason_code", "rtt_bucket", "jitter_bucket", "packet_loss_bucket", "platform", "app_version", "legal_basis_id", "notice_version",
)
add(
    "stg_voice_sessions",
    Model(
        "parsed",
        {
            **EVENT,
            "voice_session_hk": "md5({{text|voice_session_key}})",
            "voice_room_hk": "md5({{text|room_key}})",
            "voice_participant_session_hk": "md5(concat_ws(':', subject_user_hash, {{text|voice_session_key}}))",
            **text(*VOICE_TEXT),
            "never_unmuted": "{{flag|{{text|never_unmuted}}}}",
            "production_write_enabled": "{{flag|{{text|production_write_enabled}}}}",
            "purpose_id": "coalesce({{text|purpose_id}}, 'analytics.voice_usage_measurement.v1')",
            "retention_policy_id": "coalesce({{text|retention_policy_id}}, 'voice-summary-30d-anonymize-or-delete-v1')",
            "record_source_mode": "{{or_unknown|{{text|record_source_mode}}}}",
            "voice_speaker_activity_legal_mode": "'disabled'",
            **ENVELOPE,
            "voice_session_summary_hashdiff": hashdiff(*VOICE_TEXT[:15]),
        },
        where=f"event_name = 'voice_usage_session_summary' AND {every('voice_session_key', 'room_key', 'room_type_key')}",
    ),
)

# The shared column rules on their own.
add("safe_int", Model("parsed", {"event_id": "event_id", **counts(dwell_ms="dwell_ms", duration_sec="duration_sec", invite_count="invite_count", visible_ms="visible_ms")}))
add("bounded_token", Model("parsed", {"event_id": "event_id", "cohort": COHORT, "emoji": "{{token|{{text|emoji_key}}}}"}))
add("reporting_date", Model("landing", {"event_id": "event_id", "occurred_at": "occurred_at", "reporting_date": "{{day|occurred_at}}"}))
