"""Privacy lifecycle, evidence windows and the hot rollup, as models."""

from __future__ import annotations

from brightvault.operators.stage import names, text  # noqa: F401
from brightvault.plans.constants import register
from brightvault.plans.model import Model, add, same
from brightvault.streaming.validate import ADMIN_KEYS

END = "{{clock|window_end}}"
PERSONAL = ("IDENTIFIABLE", "PSEUDONYMOUS", "AGGREGATED_PERSONAL")
REQUESTS = ("analytics_opt_out", "account_deletion", "recap_opt_out", "feed_profile_reset")


def pick(by: str, *values: str | None) -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN " + (f"'{v}'" if v is not None else "NULL") for i, v in enumerate(values)) + " END"


# Lifecycle records derived from the landed events; a few break a rule each.
add(
    "privacy_packet_scan",
    Model(
        "landing",
        {"source_record_ref": "concat(CASE WHEN source_offset % 53 = 0 THEN '!' ELSE 'rec:' END, event_id)", "subject_ref": "concat('sha256:', {{sha|subject_user_hash}})", "feature_id": "event_name",
         "data_state": pick("source_offset % 4", *PERSONAL, "ANONYMOUS"), "occurred_at": "occurred_at", "retention_days": "CAST(source_offset % 6 AS INT)",
         "expiry_action": "CASE WHEN source_offset % 5 = 0 THEN 'delete' ELSE 'anonymize_or_delete' END", "anonymization_target": "'daily_aggregate'", "anonymous_group": "concat('group:', event_name)",
         "cell_count": "CAST(source_offset % 31 AS INT) - 1", "candidate_identifier_free": "source_offset % 7 <> 0", "demographic_or_rare_cell": "source_offset % 3 = 0", "method_version": "'method-v1'",
         "evidence_id": "concat('evidence:', event_id)", "request_type": pick("source_offset % 9", *REQUESTS, "unknown_request"), "private_recap_counter": "source_offset % 8 = 0"},
    ),
)
SAFE = "^[A-Za-z0-9][A-Za-z0-9._:/=-]+$"
RULES = (
    ("unsafe_reference", "NOT ({{like|source_record_ref;;%s}} AND length(source_record_ref) BETWEEN 3 AND 181 AND {{like|feature_id;;%s}} AND {{like|evidence_id;;%s}})" % (SAFE, SAFE, SAFE)),
    ("subject_not_hashed", "NOT ({{like|subject_ref;;^sha256:[a-fA-F0-9]+$}} AND length(subject_ref) = 71)"),
    ("invalid_data_state", f"data_state NOT IN {names(*PERSONAL, 'ANONYMOUS')}"),
    ("retention_not_positive", "retention_days <= 0"),
    ("invalid_expiry_action", "expiry_action NOT IN ('anonymize_or_delete', 'delete')"),
    ("negative_cell_count", "cell_count < 0"),
    ("unsupported_request_type", f"request_type NOT IN {names(*REQUESTS)}"),
)
add("privacy_judged", Model("privacy_packet_scan", {**{c: c for c in ()}, **same("source_record_ref subject_ref feature_id data_state occurred_at retention_days expiry_action anonymization_target anonymous_group cell_count candidate_identifier_free demographic_or_rare_cell method_version evidence_id request_type private_recap_counter"),
                                                    "error_code": "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in RULES) + " END"}))
add("privacy_record_validation", Model("privacy_judged", same("source_record_ref error_code")))
add("privacy_records", Model("privacy_judged", where="error_code IS NULL"))
add("privacy_retention_candidates", Model("privacy_records", where=f"expiry_action = 'anonymize_or_delete' AND {{{{plus_minutes|occurred_at;;retention_days * 1440}}}} <= {END}"))
LIMIT = "(CASE WHEN demographic_or_rare_cell THEN 20 ELSE 10 END)"
CHECKS = {"identifier_free": "candidate_identifier_free", "cell_threshold_passed": f"cell_count >= {LIMIT}", "approved_method_version": "method_version <> ''", "evidence_id_present": "evidence_id <> ''",
          "complementary_suppression_passed": f"cell_count >= {LIMIT}", "quasi_identifier_risk_check_passed": f"candidate_identifier_free AND cell_count >= {LIMIT}"}
PASSED = " AND ".join(f"({c})" for c in CHECKS.values())
add(
    "privacy_anonymization_checks",
    Model(
        "privacy_retention_candidates",
        {"candidate_id": "concat('source-bound-anon-candidate:', source_record_ref)", **same("source_record_ref data_state anonymous_group anonymization_target cell_count method_version evidence_id"),
         "required_cell_threshold": LIMIT, **CHECKS, "passed": PASSED, "anonymous_publish": f"CASE WHEN {PASSED} THEN 'allowed' ELSE 'blocked' END", "expired_personal_purge": "'required'",
         "incident_and_audit": f"CASE WHEN {PASSED} THEN 'not_required' ELSE 'required' END"},
    ),
)
add("privacy_published_aggregates", Model("privacy_anonymization_checks", same("candidate_id source_record_ref anonymous_group cell_count evidence_id"), where="passed"))
DELETES = "request_type IN ('account_deletion', 'recap_opt_out')"
add(
    "privacy_cleanup_actions",
    Model(
        "privacy_records",
        {**same("source_record_ref request_type"), "new_user_level_eligibility_stopped": "true", "personal_or_private_state_removed": "true", "private_recap_counter_deleted": f"private_recap_counter OR {DELETES}",
         "generated_recap_deleted": DELETES, "feed_profile_reset": "request_type = 'feed_profile_reset'", "true_anonymous_aggregate_allowed_to_remain": "true"},
        where="request_type IS NOT NULL",
    ),
)
REF = same("source_record_ref")
add("privacy_purge_refs", Model(("privacy_retention_candidates", "privacy_cleanup_actions"), REF, parts=(REF, REF), wheres=(f"data_state IN {names(*PERSONAL)}", "personal_or_private_state_removed"), distinct=True))


def receipt(action: str) -> dict[str, str]:
    return {"action": action, "source_record_ref": "source_record_ref"}


add(
    "privacy_audit_receipts",
    Model(
        ("privacy_retention_candidates", "privacy_anonymization_checks", "privacy_anonymization_checks", "privacy_published_aggregates", "privacy_purge_refs", "privacy_cleanup_actions"),
        {"audit_id": "concat(action, ':', source_record_ref)", "action": "action", "source_record_ref": "source_record_ref", "retention": "'minimum_3_years'"},
        parts=(receipt("'retention_candidate_identified'"), receipt("CASE WHEN passed THEN 'anonymous_candidate_check_passed' ELSE 'anonymous_candidate_check_failed' END"), receipt("'anonymization_failure_incident_recorded'"),
               receipt("'anonymous_aggregate_published'"), receipt("'personal_or_pseudonymous_state_purged'"), receipt("concat('cleanup_', request_type)")),
        wheres=(None, None, "NOT passed", None, None, None),
    ),
)
add("privacy_decision_counts", Model("privacy_audit_receipts", {"n": "count(*)", "records": "{{distinct|source_record_ref}}"}, group=same("action")))
AUDITS = ("retention_candidate_identified", "anonymous_candidate_check_passed", "anonymous_candidate_check_failed", "anonymization_failure_incident_recorded", "personal_or_pseudonymous_state_purged", *(f"cleanup_{r}" for r in REQUESTS))
register("expected_audits", "action string", [(a,) for a in AUDITS])
add("published_failures", Model("privacy_published_aggregates", {"violation": "'failed_candidate_published'", "detail": "l.source_record_ref"}, join=("failed_checks", "left semi", "l.source_record_ref = r.source_record_ref")))
add("failed_checks", Model("privacy_anonymization_checks", where="NOT passed"))
add("missing_audits", Model("expected_audits", {"violation": "'missing_audit_kind'", "detail": "l.action"}, join=("privacy_decision_counts", "left anti", "l.action = r.action")))
FOUND = same("violation detail")
add("privacy_invariants", Model(("published_failures", "missing_audits"), FOUND, parts=(FOUND, FOUND)))
add("privacy_ref_events", Model("privacy_purge_refs", {"event_id": "{{drop|source_record_ref;;^rec:}}"}))
add("privacy_purge_apply", Model("landing", same("event_id event_name source_offset"), join=("privacy_ref_events", "left anti", "l.event_id = r.event_id")))

# Evidence windows: prefix, person, closed time window, and names or the client's platform.
FROM, TO = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-05 00:00:00'"
# Payload keys by required event.
EVIDENCE_KEYS = {
    "admin_surface_viewed": "admin_surface module_key screen_key result_state role_scope_key".split(),
    "admin_action_visibility_viewed": "admin_surface module_key screen_key action_key action_surface result_state disabled_reason_key role_scope_key proposal_mode target_type target_hash".split(),
} | ADMIN_KEYS
# What a canary client may send, and which of these are interactions.
CANARY_NAMES = (
    "app_session_started app_session_ended screen_viewed feed_item_impression feed_item_viewable_impression feed_item_open feed_item_like feed_item_reply feed_item_join feed_item_share"
    " feed_item_copy_link feed_item_hide feed_item_show_less feed_item_not_interested feed_item_mute_author feed_item_mute_channel"
).split()
INTERACTIONS = (
    "feed_item_like feed_item_reply feed_item_join feed_item_share feed_item_copy_link feed_item_hide feed_item_show_less feed_item_not_interested feed_item_mute_author feed_item_mute_channel"
).split()


def window(person: str) -> str:
    return f"event_id LIKE 'ev-%' AND subject_user_hash = '{person}' AND occurred_at BETWEEN {FROM} AND {TO}"


EVENT = same("event_id event_name occurred_at subject payload")
add("evidence_rows", Model("landing", EVENT, where=f"{window('sha256:u7')} AND event_name IN {names(*EVIDENCE_KEYS)}"))
add("canary_rows", Model("landing", EVENT, where=f"{window('sha256:u8')} AND {{{{path|payload;;$.client.platform}}}} = 'ios'"))
add("evidence_event_counts", Model("canary_rows", {"n": "count(*)", "in_scope": f"event_name IN {names(*CANARY_NAMES)}"}, group=same("event_name")))

# The hot rollup.
HOT = "event_id event_name event_version producer privacy_class subject_user_hash payload_sha256 raw_record_sha256 raw_record_bytes source_topic source_partition source_offset"
add("hot_events", Model("landing", {**same(HOT), **{c: "{{ms|%s}}" % c for c in ("occurred_at", "received_at", "landed_at")}}))
add("hourly_counts", Model("landing", {"event_count": "count(*)"}, group={"event_hour": "{{hour|occurred_at}}", **same("event_name privacy_class")}))
add("hourly_event_counts", Model("hourly_counts", {"event_hour": "{{iso|event_hour}}", **same("event_name privacy_class event_count")}))
HOURLY = same("event_hour event_name privacy_class")
add("hourly_partials", Model("landing", {"event_count": "count(*)"}, group={"event_hour": "{{hour|occurred_at}}", **same("event_name privacy_class source_partition")}))
add("hourly_rollup_merge", Model("hourly_partials", {"event_count": "{{long|sum(event_count)}}"}, group=HOURLY))
add(
    "hourly_parity",
    Model("hourly_counts", {"event_hour": "coalesce(l.event_hour, r.event_hour)", "event_name": "coalesce(l.event_name, r.event_name)", "source_count": "l.event_count", "rebuilt_count": "r.event_count"},
          join=("hourly_rollup_merge", "full", "l.event_hour = r.event_hour AND l.event_name = r.event_name AND l.privacy_class = r.privacy_class"), then="source_count IS DISTINCT FROM rebuilt_count"),
)
add("fixture_window", Model("landing", same("event_id event_name subject_user_hash occurred_at consent_scope"), where="event_name IN ('reaction_added', 'post_impression') AND occurred_at BETWEEN TIMESTAMP '2024-01-02 10:00:00' AND TIMESTAMP '2024-01-02 12:00:00'"))
