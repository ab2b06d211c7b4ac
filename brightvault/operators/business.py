"""Daily bridges, points in time and metrics with small-cell suppression, and the published marts."""

from __future__ import annotations

from brightvault.operators.stage import RECORD_SOURCE, REFUSED, names
from brightvault.plans.model import Model, add, same

ACTORS = {"distinct_actor_count": "{{distinct|subject_user_hk}}"}
SMALL = {"small_cell_suppression_status": "{{small_cell|subject_user_hk}}"}
LOAD = {"load_datetime": "max(load_datetime)", "record_source": RECORD_SOURCE}
COHORT = "{{or_unknown|max(occupation_cohort_key)}}"
PARTIAL_IF = "CASE WHEN count_if(source_completeness_input = 'source_complete') > 0 THEN 'partial' ELSE 'unavailable' END"


def latest(**columns: str) -> dict[str, str]:
    return {c: f"max({x})" for c, x in columns.items()}


def known(*columns: str) -> dict[str, str]:
    """Columns whose nulls are the group 'unknown'."""
    return {c: f"{{{{or_unknown|{c}}}}}" for c in columns}


def tally(column: str, **values) -> dict[str, str]:
    """Rows by value (or values) of a column."""
    return {c: f"{{{{n|{column} IN {names(*([v] if isinstance(v, str) else v))}}}}}" for c, v in values.items()}


def labels(completeness: str, wording: str | None = None, one: str | None = None, many: str | None = None, detail: str | None = None) -> dict[str, str]:
    out = {"source_completeness_label": completeness, "source_completeness_detail": detail, "metric_contract_id": one, "metric_contract_ids": many, "wording_status": wording}
    return {k: f"'{v}'" for k, v in out.items() if v}


def daily(name: str, source: str, grain: dict[str, str], measures: dict[str, str], where: str | None = None, after: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> None:
    """An aggregate by reporting date and ``grain``; ``after`` adds columns over the measures."""
    group = {"reporting_date": "reporting_date", **grain}
    kept = same(*(c for c in (*group, *measures) if c not in drop))
    add(name, Model(source, measures, where=where, group=group, after={**kept, **after} if after else {}))


REACTED = tally("reaction_action", reaction_added_count="added", reaction_removed_count="removed")
daily(
    "br_content_reaction_daily", "sat_reaction_event",
    {"content_hk": "content_hk", **known("reaction_key", "emoji_key", "reaction_valence")},
    {**latest(content_business_key="content_business_key"), "occupation_cohort_key": COHORT, **REACTED, **ACTORS, **SMALL, **LOAD},
    where="content_hk IS NOT NULL", after={"net_reaction_count": "reaction_added_count - reaction_removed_count"},
)

INTENT = ("interested", "join_attempted", "joined", "reminder_set", "calendar_added", "shared", "check_in", "attendance_confirmed")
DROPPED = ("uninterested", "join_failed", "join_abandoned", "left", "no_show_inferred")
daily(
    "br_event_funnel", "sat_event_metadata", {"event_hk": "community_event_hk", "event_funnel_action": "event_funnel_action"},
    {**latest(event_business_key="community_event_business_key"), "action_count": "count(*)", **ACTORS,
     **tally("event_funnel_action", positive_intent_count=INTENT, dropoff_or_negative_count=DROPPED), "source_completeness_label": PARTIAL_IF, **SMALL, **LOAD},
    where="community_event_hk IS NOT NULL",
)

SEEN = ("feed_item_impression", "feed_item_viewable_impression")
TAKEN = ("feed_item_open", "feed_item_like", "feed_item_reply", "feed_item_join", "feed_item_share", "feed_item_copy_link")


def feed_interest(name: str, grain: dict[str, str]) -> None:
    """Per feed item, or with another grain per content: interest shown less three times interest refused."""
    daily(
        name, "sat_feed_serving_event", {**grain, "content_business_key": "content_business_key"},
        {"occupation_cohort_key": COHORT, "feed_mode": "{{or_unknown|max(feed_mode)}}", "surface": "{{or_unknown|max(surface)}}",
         **tally("event_name", qualified_impression_count=SEEN, positive_action_count=TAKEN, negative_action_count=REFUSED),
         "dwell_ms_total": "{{sum0|dwell_ms}}", **ACTORS, "with_cohort": "{{n|source_completeness_input = 'source_complete_with_occupation_cohort'}}", **SMALL, **LOAD},
        where="feed_item_hk IS NOT NULL", drop=("with_cohort",),
        after={"feed_interest_proxy_score": "{{long|positive_action_count + CASE WHEN dwell_ms_total > 0 THEN 1 ELSE 0 END - 3 * negative_action_count}}",
               "source_completeness_label": "'partial'",
               "source_completeness_detail": "CASE WHEN with_cohort > 0 THEN 'accepted_feed_events_with_occupation_cohort' ELSE 'accepted_feed_events_only' END"},
    )


feed_interest("br_feed_interest_proxy", {"feed_item_hk": "feed_item_hk"})
feed_interest("br_feed_interest_by_content", {})

TOGETHER = tally("together_action", invite_sent_count="invite_sent", share_count=("shared", "share_link_created"), opened_count="opened", response_added_count="response_added", reported_count="reported")
daily(
    "br_together_response_flow", "sat_together_metadata", {"together_item_hk": "together_item_hk", **known("response_type", "together_status")},
    {**latest(together_item_business_key="together_item_business_key"), **TOGETHER, **ACTORS, **SMALL, **LOAD}, where="together_item_hk IS NOT NULL",
)

SPAN = {"first_event_at": "min(occurred_at)", "latest_event_at": "max(occurred_at)"}
daily(
    "pit_event_daily", "sat_event_metadata", {"event_hk": "community_event_hk"},
    {**latest(event_business_key="community_event_business_key"), **SPAN, "event_funnel_event_count": "count(*)", "distinct_action_count": "{{distinct|event_funnel_action}}",
     **ACTORS, "source_completeness_label": PARTIAL_IF, **SMALL, **LOAD},
    where="community_event_hk IS NOT NULL",
)

# Consent texts that take a person out.
OPTED_OUT = ("analytics_opt_out", "account_deletion", "privacy_deletion", "deleted", "opted_out", "opt_out")
GONE = "(lower(consent_scope) NOT LIKE '%\"analytics\"%' OR " + " OR ".join(f"lower(consent_scope) LIKE '%{x}%'" for x in OPTED_OUT) + ")"
LATE = "{{day|load_datetime}} > reporting_date"
daily(
    "pit_content_daily", "sat_content_event", {"content_hk": "content_hk"},
    {**latest(content_business_key="content_business_key"), "content_type": "{{or_unknown|max(content_type)}}", **latest(channel_business_key="channel_business_key"),
     "occupation_cohort_key": COHORT, **SPAN, "as_of_datetime": "max(load_datetime)", "content_event_count": "count(*)", **ACTORS,
     "late_arriving_event_count": "{{n|%s}}" % LATE, "deleted_or_opted_out_subject_count": "{{n|%s}}" % GONE,
     "source_completeness_label": "CASE WHEN count(source_completeness_input) > 0 THEN 'partial' ELSE 'unavailable' END", **SMALL, **LOAD},
    where="content_hk IS NOT NULL",
    after={"restatement_state": "CASE WHEN late_arriving_event_count > 0 THEN 'restated_after_reporting_date' ELSE 'current_as_of_reporting_date' END"},
)

TOTALS = {"invite_count_total": "{{sum0|invite_count}}", "response_count_total": "{{sum0|response_count}}"}
daily(
    "pit_together_daily", "sat_together_metadata", {"together_item_hk": "together_item_hk"},
    {**latest(together_item_business_key="together_item_business_key"), **{c: f"{{{{or_unknown|max({c})}}}}" for c in ("activity_type", "visibility", "together_status")},
     **latest(channel_business_key="channel_business_key"), **SPAN, "together_event_count": "count(*)", **ACTORS, **TOTALS, "source_completeness_label": PARTIAL_IF, **SMALL, **LOAD},
    where="together_item_hk IS NOT NULL",
)

daily(
    "s_channel_session_daily", "sat_channel_session", {"channel_hk": "channel_hk"},
    {**latest(channel_business_key="channel_business_key"), **tally("channel_session_action", session_started_count="started", session_ended_count="ended"),
     "distinct_session_count": "{{distinct|channel_session_hk}}", "duration_ms_total": "{{sum0|duration_ms}}",
     **{c: f"{{{{sum0|{c}}}}}" for c in ("posts_seen_count", "comments_written_count", "reactions_added_count")}, **ACTORS,
     **labels("", "direct", many="channel_session_count_daily,channel_session_duration_ms_daily"), "source_completeness_label": PARTIAL_IF, **SMALL, **LOAD},
    where="channel_hk IS NOT NULL",
)

daily(
    "s_content_performance_daily", "sat_content_event", {"content_hk": "content_hk"},
    {**latest(content_business_key="content_business_key"), "content_type": "{{or_unknown|max(content_type)}}", **latest(channel_business_key="channel_business_key"),
     "occupation_cohort_key": COHORT,
     "positive_reaction_count": "{{n|event_name IN ('reaction_added', 'feed_item_like') AND reaction_valence = 'positive'}}",
     "like_like_reaction_count": "{{n|event_name = 'feed_item_like' OR (event_name = 'reaction_added' AND coalesce(emoji_key, '') IN ('like', 'thumbs_up', 'thumbsup'))}}",
     **tally("event_name", reply_count=("reply_created", "feed_item_reply"), share_or_open_count=("feed_item_open", "feed_item_join", "feed_item_share", "feed_item_copy_link"), hide_or_report_count=REFUSED),
     **ACTORS, **latest(latest_event_at="occurred_at"), **SMALL, **LOAD},
    where="content_hk IS NOT NULL",
    after={"content_performance_score": "{{long|positive_reaction_count + 2 * reply_count + share_or_open_count - 3 * hide_or_report_count}}",
           "most_liked_rank_score": "{{long|1000000 * positive_reaction_count + 10000 * like_like_reaction_count + 100 * reply_count}}",
           **labels("partial", "direct/proxy", many="most_liked_content_daily,content_performance_score_daily")},
)

daily(
    "s_emoji_usage_daily", "sat_reaction_event", known("emoji_key", "occupation_cohort_key"), {**REACTED, **ACTORS, **SMALL, **LOAD},
    after={"emoji_usage_count": "reaction_added_count - reaction_removed_count", **labels("partial", "direct", one="emoji_usage_count_daily")},
)

# Sums people over events: an actor of two events counts twice here, as published.
daily(
    "s_event_funnel_daily", "br_event_funnel", {"event_funnel_action": "event_funnel_action"},
    {**{c: f"{{{{sum0|{c}}}}}" for c in ("action_count", "positive_intent_count", "dropoff_or_negative_count")}, "distinct_event_count": "{{distinct|event_hk}}",
     "actor_event_count": "{{sum0|distinct_actor_count}}", "small_cell_suppression_status": "{{reportable|sum(distinct_actor_count)}}",
     **labels("partial", "proxy/partial", many="event_funnel_action_count_daily,event_join_conversion_proxy_daily"), **LOAD},
)

# A row per day, person and cohort; people are counted by cohort and, each in one of their cohorts, by day.
ACTED = {**same("reporting_date subject_user_hk"), "occupation_cohort_key": "{{or_unknown|occupation_cohort_key}}", "load_datetime": "load_datetime"}
SATS = ("sat_content_event", "sat_reaction_event", "sat_feed_serving_event")
PERSON = same("reporting_date subject_user_hk occupation_cohort_key")
add("actor_cohorts", Model(SATS, {"load_datetime": "max(load_datetime)"}, group=PERSON, parts=(ACTED,) * 3, wheres=("subject_user_hk IS NOT NULL",) * 3))
add("actor_turns", Model("actor_cohorts", {**PERSON, "load_datetime": "load_datetime", "turn": "row_number() OVER (PARTITION BY reporting_date, subject_user_hk ORDER BY occupation_cohort_key)"}))
daily("cohort_users", "actor_turns", same("occupation_cohort_key"), {"distinct_user_count": "count(*)", "first_count": "{{n|turn = 1}}", "load_datetime": "max(load_datetime)"})
add("cohort_totals", Model("cohort_users", {**same("reporting_date occupation_cohort_key distinct_user_count load_datetime"), "total_user_count": "{{long|sum(first_count) OVER (PARTITION BY reporting_date)}}"}))
add(
    "s_occupation_cohort_daily",
    Model(
        "cohort_totals", {
            **same("reporting_date occupation_cohort_key distinct_user_count total_user_count"),
            "occupation_cohort_share": "CASE WHEN total_user_count > 0 THEN {{div|distinct_user_count;;total_user_count}} END",
            "small_cell_suppression_status": "CASE WHEN distinct_user_count >= 10 AND total_user_count >= 10 THEN 'reportable' ELSE 'suppress_before_pl' END",
            **labels("partial", "direct", many="occupation_cohort_user_count_daily,occupation_cohort_share_daily", detail="analytics_event_cohort_only_pending_canonical_app_sources"),
            "load_datetime": "load_datetime", "record_source": RECORD_SOURCE,
        },
    ),
)

daily(
    "s_reaction_valence_daily", "sat_reaction_event", known("reaction_valence", "occupation_cohort_key"),
    {"reaction_valence_count": "count(*)", **tally("reaction_action", added_reaction_count="added", removed_reaction_count="removed"), **ACTORS, **SMALL,
     **labels("partial", "explicit-signal-only", many="reaction_valence_count_daily,positive_reaction_day_daily,negative_reaction_day_daily"), **LOAD},
)

daily(
    "s_together_coordination_daily", "sat_together_metadata", known("activity_type", "visibility", "together_status", "channel_business_key"),
    {"together_item_count": "{{distinct|together_item_hk}}", **tally("together_action", together_created_count="created"), **TOGETHER, **TOTALS, **ACTORS, **SMALL, **LOAD},
    where="together_item_hk IS NOT NULL",
    after={"together_coordination_success_proxy_score": "{{long|together_created_count + 2 * response_added_count + opened_count + share_count - 3 * reported_count}}",
           **labels("partial", "proxy/partial", many="together_items_created_count_daily,together_response_count_daily,together_coordination_success_proxy_daily")},
)

PLACE = ("room_type_key", "platform", "app_version")
VOICE_SMALL = {"small_cell_suppression_status": "CASE WHEN count(DISTINCT subject_user_hk) >= 10 THEN 'reportable' ELSE 'suppressed' END"}
SESSIONS = {"voice_session_count": "{{distinct|voice_session_hk}}"}
ZONE = {"reporting_timezone": "'Europe/Istanbul'"}


def voice(name: str, grain: tuple[str, ...], contract: str, completeness: str, wording: str = "direct", more: dict[str, str] | None = None, where: str | None = None) -> None:
    daily(name, "stg_voice_sessions", same(*PLACE, *grain), {**SESSIONS, **(more or {}), **VOICE_SMALL, **labels(completeness, wording, one=contract), **ZONE}, where=where)


UNTIL_GO, UNTIL_BOUND = "current_effective_default_false_until_legal_go", "partial_until_source_bound_runtime_enabled"
voice("s_voice_mic_usage_daily", ("microphone_unmuted_duration_bucket", "unmute_count_bucket", "first_unmute_latency_bucket", "permission_state", "never_unmuted"), "voice_mic_usage_daily", UNTIL_GO)
voice("s_voice_qos_daily", ("reconnect_count_bucket", "join_failure_reason_code", "rtt_bucket", "jitter_bucket", "packet_loss_bucket"), "voice_qos_daily", UNTIL_BOUND)
voice("s_voice_room_usage_daily", (), "voice_room_usage_daily", UNTIL_BOUND, more={"voice_room_count": "{{distinct|voice_room_hk}}", "distinct_participant_count": "{{distinct|subject_user_hk}}"})
voice(
    "s_voice_speech_activity_daily", ("speech_activity_duration_bucket", "speech_activity_ratio_bucket", "voice_speaker_activity_legal_mode"), "voice_speech_activity_daily",
    UNTIL_GO, "bounded_summary_only", where="voice_speaker_activity_legal_mode = 'disabled' AND production_write_enabled = false",
)

add(
    "small_cell_suppression",
    Model("sat_content_event", {"distinct_actor_count": "{{distinct|subject_user_hk}}", **SMALL}, group=same("reporting_date content_hk event_name")),
)


def mart(name: str, source: str, columns: str, extra: dict[str, str] | None = None) -> None:
    """Reportable rows with the published columns, the time zone and the time of refresh."""
    add(name, Model(source, {**same("reporting_date", columns), **(extra or {}), **ZONE, "refreshed_at": "load_datetime"}, where="small_cell_suppression_status = 'reportable'"))


LABELS = " source_completeness_label wording_status"
mart(
    "mart_content_performance_daily", "s_content_performance_daily",
    "content_business_key content_type channel_business_key occupation_cohort_key positive_reaction_count like_like_reaction_count reply_count share_or_open_count"
    " hide_or_report_count content_performance_score most_liked_rank_score metric_contract_ids latest_event_at" + LABELS, {"content_reporting_key": "content_hk"},
)
mart("mart_emoji_reaction_daily", "s_emoji_usage_daily", "emoji_key occupation_cohort_key reaction_added_count reaction_removed_count emoji_usage_count metric_contract_id" + LABELS)
FEED_MART = "content_business_key occupation_cohort_key feed_mode surface qualified_impression_count positive_action_count negative_action_count dwell_ms_total feed_interest_proxy_score source_completeness_detail source_completeness_label"
FEED_LABELS = labels("", "proxy/partial", many="feed_interest_proxy_score_daily,feed_interest_source_completeness_daily")
mart("mart_feed_interest_proxy_daily", "br_feed_interest_proxy", FEED_MART, {"feed_item_reporting_key": "feed_item_hk", **FEED_LABELS})
mart("mart_feed_interest_by_content_daily", "br_feed_interest_by_content", FEED_MART, FEED_LABELS)
mart("mart_occupation_cohort_daily", "s_occupation_cohort_daily", "occupation_cohort_key distinct_user_count total_user_count occupation_cohort_share source_completeness_detail metric_contract_ids" + LABELS)
mart("mart_reaction_valence_daily", "s_reaction_valence_daily", "reaction_valence occupation_cohort_key reaction_valence_count added_reaction_count removed_reaction_count metric_contract_ids" + LABELS)
mart(
    "mart_together_coordination_daily", "s_together_coordination_daily",
    "activity_type visibility together_status channel_business_key together_item_count together_created_count invite_sent_count share_count opened_count response_added_count"
    " reported_count invite_count_total response_count_total together_coordination_success_proxy_score metric_contract_ids" + LABELS,
)
