"""Hubs, links and satellites, each from one generic builder and a table of specs."""

from __future__ import annotations

from brightvault.operators.stage import FEED_COUNTS
from brightvault.plans.model import Model, add, same

STAGE = {
    "content": "stg_content_events", "reaction": "stg_reactions", "feed": "stg_feed_events", "channel": "stg_channel_sessions",
    "funnel": "stg_event_funnel", "together": "stg_together_items", "voice": "stg_voice_sessions", "events": "stg_analytics_events",
}
LOAD = {"load_datetime": "min(load_datetime)", "record_source": "min(record_source)"}


def hub(name: str, hk: str, bk: str, *origins: tuple[str, str, str]) -> None:
    """A key once, with its earliest load. origins: (stage, its hash key, its business key)."""
    parts = tuple({hk: h, bk: b, **same("load_datetime record_source")} for _, h, b in origins)
    wheres = tuple(f"{h} IS NOT NULL AND {b} IS NOT NULL" for _, h, b in origins)
    add(name, Model(tuple(STAGE[s] for s, _, _ in origins), LOAD, group=same(hk, bk), parts=parts, wheres=wheres))


def hub_by_load(name: str, stage: str, hk: str, bk: str, key: str) -> None:
    """A row per key and load time: the form that keeps repeats."""
    add(name, Model(STAGE[stage], {hk: hk, bk: key, **same("load_datetime record_source")}, where=f"{key} IS NOT NULL", distinct=True))


def link(name: str, stage: str, **participants: str) -> None:
    """participants: output name = stage column."""
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in participants.values())
    add(name, Model(STAGE[stage], LOAD, where=keyed, group=participants, after={"link_hk": f"md5(concat_ws('||', {', '.join(participants)}))", **same(*participants, "load_datetime record_source")}))


def link_by_load(name: str, key: str, participants: str, more: str = "") -> None:
    cols = participants.split()
    add(
        name,
        Model(STAGE["voice"], {key: f"md5(concat_ws(':', {', '.join(cols)}))", **same(participants, more, "load_datetime record_source")}, where=" AND ".join(f"{c} IS NOT NULL" for c in cols), distinct=True),
    )


def satellite(name: str, stage: str, parent: str, hashdiff: str, attributes: str, keyed: bool = True) -> None:
    columns = {parent: parent, "hashdiff": hashdiff, **same("load_datetime record_source", attributes)}
    add(name, Model(STAGE[stage], columns, where=f"{parent} IS NOT NULL" if keyed else None))


hub_by_load("hub_analytics_event", "events", "event_hk", "event_business_key", "event_id")
hub("hub_reporting_content", "content_hk", "content_business_key", ("content", "content_hk", "content_business_key"))
hub("hub_reporting_feed_item", "feed_item_hk", "feed_item_business_key", ("feed", "feed_item_hk", "feed_item_business_key"))
hub("hub_reporting_reaction", "reaction_hk", "reaction_business_key", ("reaction", "reaction_hk", "event_id"))
hub("h_channel", "channel_hk", "channel_business_key", *((s, "channel_hk", "channel_business_key") for s in ("channel", "content", "together")))
hub("h_event", "event_hk", "event_business_key", ("funnel", "community_event_hk", "community_event_business_key"), ("together", "linked_event_hk", "linked_event_business_key"))
hub("h_together_item", "together_item_hk", "together_item_business_key", ("together", "together_item_hk", "together_item_business_key"))
hub_by_load("h_voice_room", "voice", "voice_room_hk", "voice_room_business_key", "room_key")
hub_by_load("h_voice_session", "voice", "voice_session_hk", "voice_session_business_key", "voice_session_key")

link("link_reaction_content", "reaction", reaction_hk="reaction_hk", content_hk="content_hk")
link("link_feed_item_content", "feed", feed_item_hk="feed_item_hk", content_hk="content_hk")
link("l_user_channel_session", "channel", subject_user_hk="subject_user_hk", channel_hk="channel_hk", channel_session_hk="channel_session_hk")
link("l_event_participant", "funnel", subject_user_hk="subject_user_hk", event_hk="community_event_hk", event_funnel_action_hk="event_funnel_action_hk")
link("l_together_actor_target", "together", subject_user_hk="subject_user_hk", together_item_hk="together_item_hk", together_target_hk="together_target_hk")
link_by_load("l_voice_participant_session", "voice_participant_session_lhk", "subject_user_hk voice_session_hk", "voice_participant_session_hk")
link_by_load("l_voice_session_room", "voice_session_room_lhk", "voice_session_hk voice_room_hk")

EVENT = "event_id event_name event_version reporting_date occurred_at received_at "
LINEAGE = " source_topic source_partition source_offset raw_record_sha256 payload_sha256"
ACTOR = " privacy_class consent_scope subject_user_hk "
satellite(
    "sat_analytics_event", "events", "event_hk", "event_hashdiff",
    "event_name event_version occurred_at received_at producer privacy_class consent_scope subject_user_hash subject_session_id raw_record_bytes landed_at" + LINEAGE, keyed=False,
)
satellite(
    "sat_content_event", "content", "content_hk", "content_event_hashdiff",
    EVENT + "content_business_key content_type channel_business_key surface action_source feed_kind feed_mode reason_key occupation_cohort_key emoji_key reaction_valence source_completeness_input" + ACTOR + LINEAGE,
)
satellite(
    "sat_reaction_event", "reaction", "reaction_hk", "reaction_hashdiff",
    EVENT + "content_hk content_business_key content_type channel_business_key reaction_action reaction_kind reaction_key emoji_key emoji_business_key reaction_valence"
    " occupation_cohort_key surface action_source feed_mode reason_key" + ACTOR + LINEAGE,
)
satellite(
    "sat_feed_serving_event", "feed", "feed_item_hk", "feed_event_hashdiff",
    EVENT + "content_business_key item_type feed_kind feed_mode surface source_bucket reason_key candidate_set_id model_version feature_schema_version score_bucket"
    " fallback_reason rollback_state assignment_bucket holdout_bucket shadow_mode occupation_cohort_key interest_proxy_valence action_source source_completeness_input "
    + " ".join(FEED_COUNTS) + ACTOR + LINEAGE,
)
satellite(
    "sat_channel_session", "channel", "channel_session_hk", "channel_session_hashdiff",
    EVENT + "channel_hk channel_business_key channel_session_business_key channel_session_action entry_source exit_reason duration_ms unread_count_on_enter"
    " posts_seen_count comments_written_count reactions_added_count subject_session_id source_completeness_input" + ACTOR + LINEAGE,
)
satellite(
    "sat_event_metadata", "funnel", "event_funnel_action_hk", "event_funnel_hashdiff",
    EVENT + "community_event_hk community_event_business_key event_funnel_action surface action_source request_id reason_key capacity_state previous_participation_state"
    " participation_state seconds_until_start_bucket rank visible_pct visible_ms duration_ms subject_session_id source_completeness_input" + ACTOR + LINEAGE,
)
satellite(
    "sat_together_metadata", "together", "together_item_hk", "together_metadata_hashdiff",
    EVENT + "together_item_business_key together_target_hk together_target_business_key linked_event_hk linked_event_business_key channel_hk channel_business_key"
    " together_action activity_type visibility together_status action_source response_type report_category invite_count response_count response_latency_bucket"
    " subject_session_id source_completeness_input" + ACTOR + LINEAGE,
)
POLICY = " purpose_id legal_basis_id notice_version retention_policy_id record_source_mode production_write_enabled"
satellite(
    "sat_voice_mic", "voice", "voice_session_hk", "voice_session_summary_hashdiff",
    "microphone_unmuted_duration_bucket unmute_count_bucket first_unmute_latency_bucket never_unmuted permission_state speech_activity_duration_bucket"
    " speech_activity_ratio_bucket voice_speaker_activity_legal_mode" + POLICY, keyed=False,
)
satellite(
    "sat_voice_qoe", "voice", "voice_session_hk", "voice_session_summary_hashdiff",
    "reconnect_count_bucket join_failure_reason_code rtt_bucket jitter_bucket packet_loss_bucket platform app_version purpose_id retention_policy_id"
    " record_source_mode production_write_enabled", keyed=False,
)
satellite(
    "sat_voice_usage", "voice", "voice_session_hk", "voice_session_summary_hashdiff",
    "reporting_date room_type_key session_duration_bucket platform app_version" + POLICY, keyed=False,
)
