"""Declarative data contracts: every check of a contract is one aggregate of one scan."""

from __future__ import annotations

from brightvault.operators.trust import CLOCK
from brightvault.plans.constants import METRIC_CONTRACTS, register
from brightvault.plans.model import Model, add, same

ZONE = "reporting_timezone <> 'Europe/Istanbul'"
LABEL = ("source_completeness_label_allowed", "source_completeness_label IS NULL OR source_completeness_label NOT IN ('partial', 'complete')")
# JSON keys that no landed document may have, by the contract of the landing table.
RAW_KEYS = (
    "email emailAddress phone phoneNumber authorization token auth_token access_token refresh_token session_token api_key cookie signed_url full_url user_id userId raw_user_id actor_user_id"
    " actorUserId staff_id target_user_id body message note note_body raw_note raw_note_text internal_note private_note applicant_message feedback_message search_text raw_search_text raw_text"
    " raw_content post_body comment_body reply_body dm_content raw_policy_text request_body response_body transcript screenshot view_hierarchy support_payload support_contact contact_payload"
    " reveal_payload reveal_value contact_value payload_value exact_gps gps latitude longitude lat lon"
).split()
# The same by the smoke check, which also knows what voice and pictures give away.
SMOKE_KEYS = (
    "email emailAddress phone phoneNumber authorization token auth_token access_token refresh_token session_token api_key cookie signed_url full_url user_id userId raw_user_id actor_user_id"
    " actorUserId staff_id target_user_id body message note note_body raw_note raw_note_text internal_note private_note applicant_message feedback_message search_text raw_search_text raw_text"
    " raw_content post_body comment_body reply_body dm_content raw_policy_text request_body response_body transcript screenshot view_hierarchy raw_audio audio_frame spoken_words caption summary"
    " topic sentiment emotion voiceprint speaker_embedding speaker_identity speaking_timeline speaking_interval vad_frame_list co_participant_key pairwise_duration private_room_name"
    " raw_room_title ocr raw_filename support_payload support_contact contact_payload reveal_payload reveal_value contact_value payload_value exact_gps gps latitude longitude lat lon"
).split()
#: When the times of an event can't be right.
BAD_TIMES = "occurred_at IS NULL OR received_at IS NULL OR occurred_at > {{plus_minutes|received_at;;5}} OR occurred_at < TIMESTAMP '2020-01-01 00:00:00' OR received_at > {{plus_minutes|%s;;5}}" % CLOCK


def raw_identifiers(keys: list[str]) -> str:
    """A subject with an address, or one of the keys, whatever its case, anywhere in subject or payload."""
    quoted = '(?i)"(' + "|".join(keys) + ')"'
    return "subject_user_hash LIKE '%%@%%' OR {{like|subject;;KEYS}} OR {{like|payload;;KEYS}}".replace("%%", "%").replace("KEYS", quoted)


def below_zero(columns: str) -> str:
    return " OR ".join(f"{c} < 0" for c in columns.split())


def labelled(wording: str, contracts: str, column: str = "metric_contract_ids") -> tuple[str, str]:
    return "wording_timezone_contract_safe", f"wording_status <> '{wording}' OR {ZONE} OR {column} <> '{contracts}' OR refreshed_at IS NULL"


def given(*columns: str) -> list[tuple[str, str, str]]:
    return [("missing", c, "") for c in " ".join(columns).split()]


#: Contract: (model, checks); a check is (kind, column or qualifier, condition or values).
CONTRACTS: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "contract_landing": (
        "landing",
        [("row_count", "*", "0"),
         ("failed_rows", "valid_timestamps", BAD_TIMES), ("failed_rows", "no_raw_identifiers", raw_identifiers(RAW_KEYS)),
         ("missing", "event_id", ""), ("duplicate", "event_id", ""), ("invalid", "privacy_class", "'pseudonymous'")],
    ),
    "contract_content_performance": (
        "mart_content_performance_daily",
        [("failed_rows", "bounded_content_counts", below_zero("positive_reaction_count like_like_reaction_count reply_count share_or_open_count hide_or_report_count")), ("failed_rows", *LABEL),
         ("failed_rows", *labelled("direct/proxy", "most_liked_content_daily,content_performance_score_daily")), ("failed_rows", "most_liked_rank_inputs_present", "content_performance_score IS NULL OR most_liked_rank_score IS NULL"),
         *given("reporting_date content_reporting_key content_type source_completeness_label")],
    ),
    "contract_coverage_registry": (
        "mart_contract_coverage",
        [("failed_rows", "coverage_status_allowed", "coverage_status <> 'covered_in_phase2_bdv' OR product_layer_contract_status NOT IN ('product_reporting_phase3_pl', 'bdv_only_pending_pl')"),
         ("failed_rows", "contract_metadata_present", " OR ".join(f"{c} IS NULL" for c in "metric_contract_id business_vault_model expected_grain source_completeness_label suppression_rule wording_status".split())),
         ("failed_rows", "completeness_wording_allowed", "source_completeness_label NOT IN ('partial', 'complete') OR wording_status NOT IN ('direct', 'proxy', 'proxy/partial', 'explicit-signal-only', 'partial')"),
         ("missing", "metric_contract_id", ""), ("duplicate", "metric_contract_id", ""), ("invalid", "metric_contract_id", ", ".join(f"'{r[0]}'" for r in METRIC_CONTRACTS))],
    ),
    "contract_emoji_reaction": (
        "mart_emoji_reaction_daily",
        [("failed_rows", "emoji_usage_formula", "reaction_added_count < 0 OR reaction_removed_count < 0 OR emoji_usage_count <> reaction_added_count - reaction_removed_count"), ("failed_rows", *LABEL),
         ("failed_rows", *labelled("direct", "emoji_usage_count_daily", "metric_contract_id")), *given("reporting_date emoji_key occupation_cohort_key")],
    ),
    "contract_feed_interest": (
        "mart_feed_interest_proxy_daily",
        [("failed_rows", "feed_interest_proxy_inputs_bounded", below_zero("qualified_impression_count positive_action_count negative_action_count dwell_ms_total") + " OR feed_interest_proxy_score IS NULL"),
         ("failed_rows", LABEL[0], LABEL[1] + " OR source_completeness_detail IS NULL OR source_completeness_detail NOT IN ('accepted_feed_events_with_occupation_cohort', 'accepted_feed_events_only')"),
         ("failed_rows", *labelled("proxy/partial", "feed_interest_proxy_score_daily,feed_interest_source_completeness_daily")), *given("reporting_date feed_item_reporting_key occupation_cohort_key feed_mode surface")],
    ),
    "contract_occupation_cohort": (
        "mart_occupation_cohort_daily",
        [("failed_rows", "bounded_counts_and_share", below_zero("distinct_user_count total_user_count") + " OR distinct_user_count > total_user_count OR occupation_cohort_share NOT BETWEEN 0 AND 1"), ("failed_rows", *LABEL),
         ("failed_rows", *labelled("direct", "occupation_cohort_user_count_daily,occupation_cohort_share_daily")), *given("reporting_date occupation_cohort_key distinct_user_count total_user_count source_completeness_detail")],
    ),
    "contract_reaction_valence": (
        "mart_reaction_valence_daily",
        [("failed_rows", "reaction_valence_formula", below_zero("reaction_valence_count added_reaction_count removed_reaction_count") + " OR reaction_valence_count <> added_reaction_count + removed_reaction_count"), ("failed_rows", *LABEL),
         ("failed_rows", *labelled("explicit-signal-only", "reaction_valence_count_daily,positive_reaction_day_daily,negative_reaction_day_daily")),
         *given("reporting_date reaction_valence"), ("invalid", "reaction_valence", "'positive', 'negative', 'neutral', 'unknown'"), *given("occupation_cohort_key")],
    ),
    "contract_together": (
        "mart_together_coordination_daily",
        [("failed_rows", "together_coordination_counts_bounded", below_zero("together_item_count together_created_count invite_sent_count share_count opened_count response_added_count reported_count invite_count_total response_count_total")
          + " OR together_coordination_success_proxy_score IS NULL"), ("failed_rows", *LABEL),
         ("failed_rows", *labelled("proxy/partial", "together_items_created_count_daily,together_response_count_daily,together_coordination_success_proxy_daily")),
         *given("reporting_date activity_type visibility together_status channel_business_key")],
    ),
    "contract_voice_summary": (
        "stg_voice_sessions",
        [("failed_rows", "voice_speaker_activity_gate_closed", "production_write_enabled = true OR (voice_speaker_activity_legal_mode = 'disabled' AND record_source_mode NOT IN ('synthetic_fixture', 'local_contract_test'))"),
         ("failed_rows", "voice_summary_no_pairwise_or_content_keys", "speech_activity_duration_bucket NOT IN ('none', 'under_1_minute', '1_to_5_minutes', '5_to_15_minutes', '15_plus_minutes') OR speech_activity_ratio_bucket NOT IN ('none', 'low', 'medium', 'high')"),
         ("duplicate", "event_id", ""), *given("voice_session_key room_key room_type_key"), ("invalid", "privacy_class", "'pseudonymous'"), *given("retention_policy_id")],
    ),
}


def failures(kind: str, on: str, detail: str) -> str:
    """The aggregate that counts a check's failures."""
    return {
        "row_count": f"CASE WHEN count(*) > {detail or 0} THEN 0 ELSE 1 END",
        "failed_rows": f"count_if({detail})",
        "missing": f"count_if({on} IS NULL)",
        "duplicate": f"count({on}) - count(DISTINCT {on})",
        "invalid": f"count_if({on} NOT IN ({detail}))",
    }[kind]


def contract(name: str, model: str, checks: list[tuple[str, str, str]]) -> Model:
    """One row per check: contract, check, kind, column, failures, status."""
    counts = {f"c{i}": "{{long|coalesce(%s, 0)}}" % failures(*c) for i, c in enumerate(checks)}
    rows = ", ".join("{{st5|'%s';;'%s_%s';;'%s';;%s;;c%d}}" % (name, k, on if on != "*" else "all", k, f"'{on}'" if k in ("missing", "duplicate", "invalid") else "CAST(NULL AS VARCHAR(1))", i) for i, (k, on, _) in enumerate(checks))
    add(f"{name}_counts", Model(model, counts))
    return Model(
        f"{name}_counts", {"e": "{{each|%s}}" % rows},
        after={"contract_name": "e.a", "check_name": "e.b", "kind": "e.c", "column_name": "e.d", "failed_count": "e.e", "status": "CASE WHEN e.e = 0 THEN 'passed' ELSE 'failed' END"},
    )


for _name, (_model, _checks) in CONTRACTS.items():
    add(_name, contract(_name, _model, _checks))
KINDS = "row_count failed_rows missing duplicate invalid".split()
RESULT = same("contract_name check_name kind column_name failed_count status")
add("contract_results", Model(tuple(CONTRACTS), parts=(RESULT,) * len(CONTRACTS)))
for _k in KINDS:
    add(f"contract_{_k}", Model("contract_results", RESULT, where=f"kind = '{_k}'"))

# The audit of the privacy lifecycle, a run per candidate for publication; every fifth purge is still open.
add(
    "privacy_lifecycle_audit",
    Model(
        "privacy_anonymization_checks",
        {"lifecycle_run_id": "candidate_id", "retention_policy_id": "CASE WHEN cell_count <> 12 THEN concat('policy:', data_state) END", "evidence_id": "evidence_id", "anonymous_publish_status": "CASE WHEN passed OR cell_count = 9 THEN 'published' ELSE 'blocked' END",
         "anonymization_check_status": "CASE WHEN passed THEN 'passed' ELSE 'failed' END", "anonymization_method_version": "method_version", "expired_personal_purge_status": "CASE WHEN cell_count % 5 = 0 THEN 'open' ELSE 'completed' END",
         "stable_identifier_present": "NOT identifier_free", "exact_timestamp_present": "false", "exact_location_present": "false", "disallowed_dimension_present": "cell_count < required_cell_threshold"},
    ),
)
# A person's own month; those who opted out on the way have no activation.
add(
    "personal_recap_monthly",
    Model(
        "landing",
        {"events": "count(*)", "out": "{{n|consent_scope LIKE '%opt_out%'}}"},
        group={"subject_key": "md5(subject_user_hash)", "month": "substr({{date_text|{{day|occurred_at}}}}, 1, 7)"},
        after={"subject_key": "subject_key", "month": "month", "purpose_id": "CASE WHEN events % 11 = 0 THEN 'other' ELSE 'personal_insights.yearly_recap.v1' END", "retention_policy_id": "CASE WHEN events % 13 > 0 THEN 'recap-12m' END",
               "consent_or_service_activation_id": "CASE WHEN out = 0 THEN concat('activation:', subject_key) END", "production_collection_enabled_before_legal_go": "events % 17 = 0"},
    ),
)
#: Contracts on these tables.
OTHER = {
    "contract_privacy_lifecycle": (
        "privacy_lifecycle_audit",
        [("failed_rows", "anonymous_publish_has_method_and_evidence", "anonymous_publish_status = 'published' AND (anonymization_check_status <> 'passed' OR anonymization_method_version IS NULL OR evidence_id IS NULL)"),
         ("failed_rows", "anonymization_failure_purge_required", "anonymization_check_status = 'failed' AND expired_personal_purge_status <> 'completed'"),
         ("failed_rows", "anonymous_zone_identifier_free", "anonymous_publish_status = 'published' AND (stable_identifier_present OR exact_timestamp_present OR exact_location_present OR disallowed_dimension_present)"),
         ("missing", "lifecycle_run_id", ""), ("duplicate", "lifecycle_run_id", ""), *given("retention_policy_id evidence_id")],
    ),
    "contract_personal_recap": (
        "personal_recap_monthly",
        [("failed_rows", "personal_recap_opt_in_required", "consent_or_service_activation_id IS NULL OR production_collection_enabled_before_legal_go = true"),
         ("failed_rows", "personal_recap_allowed_monthly_shape", "subject_key IS NULL OR month IS NULL OR retention_policy_id IS NULL"),
         *given("subject_key month"), ("invalid", "purpose_id", "'personal_insights.yearly_recap.v1'"), *given("retention_policy_id")],
    ),
}
for _name, (_model, _checks) in OTHER.items():
    add(_name, contract(_name, _model, _checks))

EXPECTED = {name: len(checks) for name, (_, checks) in CONTRACTS.items()}
register("expected_contracts", "contract_name string, expected_checks int", list(EXPECTED.items()))
add("contract_executed", Model("contract_results", {"executed": "count(*)", "failed": "{{n|status = 'failed'}}", "failures": "{{sum0|failed_count}}"}, group=same("contract_name")))
add(
    "contract_inventory_gate",
    Model(
        "expected_contracts", {"contract_name": "coalesce(l.contract_name, r.contract_name)", "expected_checks": "l.expected_checks", "executed_checks": "coalesce(r.executed, 0)",
                               "verdict": "CASE WHEN r.contract_name IS NULL THEN 'not_evaluated' WHEN l.contract_name IS NULL THEN 'not_declared' WHEN l.expected_checks <> r.executed THEN 'count_mismatch' ELSE 'complete' END"},
        join=("contract_executed", "full", "l.contract_name = r.contract_name"),
    ),
)
add(
    "quality_run_result",
    Model(
        "contract_executed",
        {"id": "concat('quality:run:', contract_name)", "contract_name": "contract_name", "status": "CASE WHEN failed = 0 THEN 'passed' ELSE 'failed' END", "critical_count": "CASE WHEN failed = 0 THEN 0 ELSE 1 END",
         "warning_count": "0", "finding_id": "CASE WHEN failed > 0 THEN concat('finding:', contract_name) END", "sample_count": "failures", "finding_status": "CASE WHEN failed > 0 THEN 'open' END"},
    ),
)
add(
    "landing_smoke_metrics",
    Model(
        "landing",
        {"row_count": "count(*)", "duplicate_event_ids": "count(event_id) - {{distinct|event_id}}", "null_event_ids": "{{n|event_id IS NULL}}",
         "bad_timestamps": "{{n|%s}}" % BAD_TIMES, "bad_privacy_class": "{{n|privacy_class <> 'pseudonymous'}}", "raw_identifier_rows": "{{n|%s}}" % raw_identifiers(SMOKE_KEYS)},
    ),
)
