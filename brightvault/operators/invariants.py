"""Checks of built models: a row is a failure."""

from __future__ import annotations

from brightvault.operators import vault  # noqa: F401  (its satellites come first)
from brightvault.operators.business import GONE, LATE
from brightvault.operators.trust import BOTH, ZEROS
from brightvault.plans.constants import METRIC_CONTRACTS, register
from brightvault.plans.model import MODELS, Model, add, same

COUNTS = (*BOTH, *ZEROS)
BAD = " OR ".join([f"{c} < 0" for c in COUNTS] + ["distinct_event_count > row_count", "accepted_source_distinct_event_count > accepted_source_count", "missing_business_key_count > row_count", "unexplained_delta <> 0", "reconciliation_status <> 'explained'"])
BAD += " OR accepted_source_count <> row_count + unexplained_delta + expected_excluded_count + " + " + ".join(ZEROS)
FAILED = same("source_model reporting_date", *COUNTS, "unexplained_delta reconciliation_status")
add("inv_unbalanced", Model("stage_reconciliation", FAILED, where=BAD))
add(
    "inv_contradiction",
    Model(
        "landing", {"first_at": "min(occurred_at)", "n": "count(*)", "hashes": "{{distinct|raw_record_sha256}}"}, where="event_id IS NOT NULL AND raw_record_sha256 IS NOT NULL", group=same("event_id"), then="hashes > 1",
    ),
)
ONE = ("accepted_source_distinct_event_count", "distinct_event_count")
ALL = ("accepted_source_count", "row_count")
CLASH = {
    "source_model": "'analytics.raw_event_landing'", "reporting_date": "{{day|first_at}}",
    **{c: "{{long|1}}" if c in ONE else "n" if c in ALL else "{{long|0}}" for c in COUNTS}, "unexplained_delta": "hashes", "reconciliation_status": "'event_id_raw_hash_contradiction'",
}
add("inv_reconciliation", Model(("inv_unbalanced", "inv_contradiction"), FAILED, parts=(same(*FAILED), CLASH)))

# Hubs.
HUBS = {"hub_reporting_content": "content", "hub_reporting_reaction": "reaction", "hub_reporting_feed_item": "feed_item", "h_channel": "channel", "h_event": "event", "h_together_item": "together_item"}
HUB_PARTS = tuple({"model_name": f"'{m}'", "hash_key": f"{k}_hk", "business_key": f"{k}_business_key", **same("load_datetime record_source")} for m, k in HUBS.items())
add("hub_rows", Model(tuple(HUBS), parts=HUB_PARTS))
GAP, MANY = "coalesce({0}, '<null>')", "'<multiple>'"
add(
    "inv_hub_nulls",
    Model("hub_rows", {"failing_row_count": "count(*)"}, group={"model_name": "model_name", "hash_key": "coalesce(hash_key, '<null>')", "business_key": "coalesce(business_key, '<null>')"},
          where="hash_key IS NULL OR nullif(trim(business_key), '') IS NULL OR load_datetime IS NULL OR nullif(trim(record_source), '') IS NULL"),
)
add("inv_hub_hash", Model("hub_rows", {"n": "count(*)", "others": "{{distinct|business_key}}"}, group=same("model_name hash_key"), then="n > 1"))
add("inv_hub_key", Model("hub_rows", {"others": "{{distinct|hash_key}}"}, group=same("model_name business_key"), then="others > 1"))
HUB_OUT = same("model_name hash_key business_key violation failing_row_count")


def hub_row(violation: str, count: str, hash_key: str = "hash_key", business_key: str = MANY) -> dict[str, str]:
    return {"model_name": "model_name", "hash_key": hash_key, "business_key": business_key, "violation": f"'{violation}'", "failing_row_count": count}


add(
    "inv_hub",
    Model(
        ("inv_hub_nulls", "inv_hub_hash", "inv_hub_key", "inv_hub_hash"), HUB_OUT, wheres=(None, None, None, "others > 1"),
        parts=(hub_row("hub_required_field_null", "failing_row_count", business_key="business_key"), hub_row("duplicate_hash_key", "n"),
               hub_row("business_key_hash_drift", "others", MANY, "business_key"), hub_row("hash_key_business_key_drift", "others")),
    ),
)

# Links: participants, and the hub (and its key) that each needs.
LINKS = {
    "link_reaction_content": ("reaction_hk content_hk", (("reaction_hk", "hub_reporting_reaction", "reaction_hk"), ("content_hk", "hub_reporting_content", "content_hk"))),
    "link_feed_item_content": ("feed_item_hk content_hk", (("feed_item_hk", "hub_reporting_feed_item", "feed_item_hk"), ("content_hk", "hub_reporting_content", "content_hk"))),
    "l_user_channel_session": ("subject_user_hk channel_hk channel_session_hk", (("channel_hk", "h_channel", "channel_hk"),)),
    "l_event_participant": ("subject_user_hk event_hk event_funnel_action_hk", (("event_hk", "h_event", "event_hk"),)),
    "l_together_actor_target": ("subject_user_hk together_item_hk together_target_hk", (("together_item_hk", "h_together_item", "together_item_hk"),)),
}
# One pass over a link gives a row per participant.
add(
    "link_participants",
    Model(
        tuple(LINKS), {**same("model_name link_hk load_datetime record_source signature"), "participant_role": "e.a", "participant_hk": "e.b", "first": "e.c"},
        parts=tuple(
            {"model_name": f"'{m}'", **same("link_hk load_datetime record_source"), "signature": f"concat_ws('||', {', '.join(p.split())})",
             "e": "{{each|%s}}" % ", ".join("{{st|'%s';;%s;;%s}}" % (c, c, str(i == 0).lower()) for i, c in enumerate(p.split()))}
            for m, (p, _) in LINKS.items()
        ),
    ),
)
add(
    "inv_link_nulls",
    Model("link_participants", {"failing_row_count": "count(*)"}, where="link_hk IS NULL OR nullif(trim(participant_hk), '') IS NULL",
          group={"model_name": "model_name", "link_hk": "coalesce(link_hk, '<null>')", "participant_role": "participant_role", "participant_hk": "coalesce(participant_hk, '<null>')"}),
)
add("inv_link_metadata", Model("link_participants", {"failing_row_count": "count(*)"}, where="first AND (load_datetime IS NULL OR nullif(trim(record_source), '') IS NULL)", group={"model_name": "model_name", "link_hk": "coalesce(link_hk, '<null>')"}))
add("inv_link_keys", Model("link_participants", {"n": "count(*)", "signatures": "{{distinct|signature}}"}, where="first", group=same("model_name link_hk"), then="n > 1"))
ORPHANS = []
for _m, (_p, _hubs) in LINKS.items():
    for _c, _hub, _k in _hubs:
        ORPHANS.append(f"orphans_{_m}_{_c}")
        add(ORPHANS[-1], Model(_m, {"model_name": f"'{_m}'", "link_hk": "l.link_hk", "participant_role": f"'{_c}'", "participant_hk": f"l.{_c}"}, join=(_hub, "left anti", f"l.{_c} = r.{_k}")))
add("inv_link_orphans", Model(tuple(ORPHANS), {"failing_row_count": "count(*)"}, group=same("model_name link_hk participant_role participant_hk")))


def link_row(violation: str, count: str = "failing_row_count", role: str = "participant_role", hk: str = "participant_hk") -> dict[str, str]:
    return {**same("model_name link_hk"), "participant_role": role, "participant_hk": hk, "violation": violation if "(" in violation else f"'{violation}'", "failing_row_count": count}


add(
    "inv_link",
    Model(
        ("inv_link_nulls", "inv_link_metadata", "inv_link_keys", "inv_link_keys", "inv_link_orphans"), same("model_name link_hk participant_role participant_hk violation failing_row_count"),
        wheres=(None, None, None, "signatures > 1", None),
        parts=(link_row("link_or_participant_key_null"), link_row("link_load_metadata_missing", role="'link_metadata'", hk="'<metadata>'"), link_row("duplicate_link_hash_key", "n", "'link_hk'", "'<duplicate>'"),
               link_row("link_hash_participant_drift", "signatures", "'participant_signature'", MANY), link_row("concat({{drop|participant_role;;_hk$}}, '_hub_missing')")),
    ),
)

# Satellites: parent model, its key, and the further keys that must agree.
SATELLITES = {
    "sat_content_event": ("hub_reporting_content", "content_hk", {}),
    "sat_reaction_event": ("hub_reporting_reaction", "reaction_hk", {}),
    "sat_feed_serving_event": ("hub_reporting_feed_item", "feed_item_hk", {}),
    "sat_channel_session": ("l_user_channel_session", "channel_session_hk", {"channel_hk": "channel_hk", "subject_user_hk": "subject_user_hk"}),
    "sat_event_metadata": ("l_event_participant", "event_funnel_action_hk", {"community_event_hk": "event_hk", "subject_user_hk": "subject_user_hk"}),
    "sat_together_metadata": ("h_together_item", "together_item_hk", {}),
    "sat_voice_usage": ("h_voice_session", "voice_session_hk", {}),
    "sat_voice_qoe": ("h_voice_session", "voice_session_hk", {}),
    "sat_voice_mic": ("h_voice_session", "voice_session_hk", {}),
}
LOST = []
PARTS = []
for _m, (_parent, _hk, _more) in SATELLITES.items():
    LOST.append(f"lost_{_m}")
    _on = " AND ".join([f"l.{_hk} = r.{_hk}"] + [f"l.{a} = r.{b}" for a, b in _more.items()])
    _names = {"model_name": f"'{_m}'", "parent_model_name": f"'{_parent}'", "parent_key_name": f"'{_hk}'"}
    add(LOST[-1], Model(_m, {**_names, "parent_or_grain_key": f"l.{_hk}"}, join=(_parent, "left anti", _on)))
    _voice = "voice" in _m
    _state = [c for c in MODELS[_m].columns if c not in ("hashdiff", "load_datetime", "record_source")]
    PARTS.append({
        **_names, "parent_hk": _hk, **same("hashdiff load_datetime record_source"), "occurred_at": "CAST(NULL AS TIMESTAMP)" if _voice else "occurred_at", "received_at": "CAST(NULL AS TIMESTAMP)" if _voice else "received_at",
        "voice": str(_voice).lower(),
        "grain": f"md5(concat_ws('||', '{_m}', {_hk}, record_source, " + ("hashdiff" if _voice else "source_topic, {{txt|source_partition}}, {{txt|source_offset}}") + ", {{stamp|load_datetime}}))",
        "state": "md5(concat_ws('||', " + ", ".join(f"'{c}=', coalesce({'{{stamp|%s}}' % c if c.endswith('_at') else '{{txt|%s}}' % c}, '<null>')" for c in _state) + "))",
    })
add("sat_rows", Model(tuple(SATELLITES), parts=tuple(PARTS)))
SAT = same("model_name parent_model_name")
BLANK = " OR ".join(f"nullif(trim({c}), '') IS NULL" for c in ("parent_hk", "hashdiff", "record_source")) + " OR load_datetime IS NULL"
NO_TIMES = "(NOT voice AND (occurred_at IS NULL OR received_at IS NULL))"
add("inv_sat_nulls", Model("sat_rows", {"failing_row_count": "count(*)"}, where=BLANK, group={**SAT, "parent_key_name": "parent_key_name", "parent_or_grain_key": "coalesce(parent_hk, '<null>')", "violation": "'satellite_required_field_null'"}))
add(
    "inv_sat_times",
    Model("sat_rows", {"failing_row_count": "count(*)"}, where=f"{NO_TIMES} OR load_datetime < received_at",
          group={**SAT, "parent_key_name": "parent_key_name", "parent_or_grain_key": "coalesce(parent_hk, '<null>')",
                 "violation": f"CASE WHEN {NO_TIMES} THEN 'satellite_event_timestamp_missing' ELSE 'satellite_load_timestamp_before_receive_timestamp' END"}),
)
add("inv_sat_grain", Model("sat_rows", {"failing_row_count": "count(*)", "states": "{{distinct|state}}", "diffs": "{{distinct|hashdiff}}"}, group={**SAT, "k": "grain"}, then="states > 1 OR diffs > 1"))
add("inv_sat_replay", Model("sat_rows", {"failing_row_count": "count(*)"}, group={**SAT, "k": "grain", "s": "state", "h": "hashdiff"}, then="failing_row_count > 1"))
add("inv_sat_state", Model("sat_rows", {"failing_row_count": "{{distinct|hashdiff}}"}, where="NOT voice", group={**SAT, "k": "state"}, then="failing_row_count > 1"))
add("inv_sat_hashdiff", Model("sat_rows", {"failing_row_count": "{{distinct|state}}"}, group={**SAT, "k": "hashdiff"}, then="failing_row_count > 1"))
add("inv_sat_orphans", Model(tuple(LOST), {"failing_row_count": "count(*)"}, group={**SAT, **same("parent_key_name parent_or_grain_key"), "violation": "'satellite_parent_missing'"}))
add(
    "inv_sat_voice",
    Model("sat_voice_mic", {"failing_row_count": "count(*)"}, where="production_write_enabled = true OR voice_speaker_activity_legal_mode <> 'disabled'",
          group={"model_name": "'sat_voice_mic'", "parent_model_name": "'voice_speaker_activity_legal_mode'", "parent_key_name": "'voice_session_hk'", "parent_or_grain_key": "voice_session_hk", "violation": "'voice_speaker_activity_conditional_path_enabled'"}),
)
SAT_OUT = same("model_name parent_model_name parent_key_name parent_or_grain_key violation failing_row_count")


def sat_row(key: str, violation: str) -> dict[str, str]:
    return {**SAT, "parent_key_name": f"'{key}'", "parent_or_grain_key": "k", "violation": f"'{violation}'", "failing_row_count": "failing_row_count"}


add(
    "inv_satellite",
    Model(
        ("inv_sat_nulls", "inv_sat_times", "inv_sat_grain", "inv_sat_replay", "inv_sat_state", "inv_sat_hashdiff", "inv_sat_orphans", "inv_sat_voice"), SAT_OUT,
        parts=(SAT_OUT, SAT_OUT, sat_row("history_grain_signature", "satellite_grain_conflict"), sat_row("history_grain_signature", "satellite_duplicate_exact_replay"),
               sat_row("state_signature", "satellite_hashdiff_state_drift"), sat_row("hashdiff", "satellite_hashdiff_state_collision"), SAT_OUT, SAT_OUT),
    ),
)

# Points in time against the satellite, in one join.
PIT = "late_arriving_event_count restatement_state deleted_or_opted_out_subject_count as_of_datetime"
add("pit_grain", Model("pit_content_daily", {"n": "count(*)"}, group=same("content_hk reporting_date"), then="n > 1"))
add("pit_matched", Model("pit_content_daily", {"content_hk": "l.content_hk", "reporting_date": "l.reporting_date", **{c: f"l.{c}" for c in PIT.split()}, "load_datetime": "r.load_datetime", "occurred_at": "r.occurred_at", "consent_scope": "r.consent_scope", "matched": "r.content_hk IS NOT NULL"},
                         join=("sat_content_event", "left", "l.content_hk = r.content_hk AND l.reporting_date = r.reporting_date")))
add(
    "pit_recomputed",
    Model(
        "pit_matched", {"late": "{{n|%s}}" % LATE, "gone": "{{n|matched AND %s}}" % GONE.replace("consent_scope", "coalesce(consent_scope, '')"),
                        "leaked": "{{n|matched AND (load_datetime > as_of_datetime OR {{day|occurred_at}} <> reporting_date)}}"}, group=same("content_hk reporting_date", PIT),
    ),
)
PIT_KEY = "concat_ws('||', coalesce(content_hk, '<null>'), coalesce({{date_text|reporting_date}}, '<null>'))"


def pit_row(violation: str, count: str) -> dict[str, str]:
    return {"model_name": "'pit_content_daily'", "grain_key": PIT_KEY, "violation": f"'{violation}'", "failing_row_count": "{{long|%s}}" % count}


add(
    "inv_pit_content",
    Model(
        ("pit_grain", "pit_content_daily", "pit_recomputed", "pit_recomputed", "pit_recomputed"), same("model_name grain_key violation failing_row_count"),
        wheres=(None, "nullif(trim(content_hk), '') IS NULL OR reporting_date IS NULL OR as_of_datetime IS NULL OR late_arriving_event_count IS NULL OR restatement_state IS NULL OR deleted_or_opted_out_subject_count IS NULL",
                "leaked > 0", "late_arriving_event_count <> late OR restatement_state <> CASE WHEN late > 0 THEN 'restated_after_reporting_date' ELSE 'current_as_of_reporting_date' END",
                "gone <> 0 OR deleted_or_opted_out_subject_count <> 0"),
        parts=(pit_row("pit_duplicate_daily_grain", "n"), pit_row("pit_required_field_null", "1"), pit_row("pit_selected_satellite_after_as_of", "leaked"),
               pit_row("pit_late_arrival_not_surfaced_or_blocked", "greatest(abs(late_arriving_event_count - late), 1)"), pit_row("pit_deleted_or_opted_out_subject_reappeared", "greatest(gone, deleted_or_opted_out_subject_count, 1)")),
    ),
)

# Trust rules.
TRUST_RULES = {
    "invalid_status_value": "freshness_status NOT IN ('FRESH', 'STALE', 'CLOCK_SKEW', 'UNAVAILABLE') OR completeness_status NOT IN ('COMPLETE', 'PARTIAL', 'EXPECTED_EMPTY', 'MISSING', 'LATE_OPEN', 'UNAVAILABLE_SOURCE_DEPENDENCY')"
    " OR trust_status NOT IN ('TRUSTED', 'FRESH_BUT_PARTIAL', 'COMPLETE_BUT_STALE', 'LATE_OPEN', 'EXPECTED_EMPTY', 'UNAVAILABLE', 'FAILED')",
    "required_partition_not_trusted": "asset_required_for_publication AND trust_status IN ('FRESH_BUT_PARTIAL', 'COMPLETE_BUT_STALE', 'UNAVAILABLE', 'FAILED')",
    "freshness_hidden_missing_or_partial_partition": "freshness_status = 'FRESH' AND completeness_status IN ('PARTIAL', 'MISSING', 'UNAVAILABLE_SOURCE_DEPENDENCY') AND trust_status = 'TRUSTED'",
    "expected_empty_classification_failed": "asset_key = 'quality_fixture.expected_empty_day' AND trust_status <> 'EXPECTED_EMPTY'",
    "expected_exclusion_classification_failed": "expected_minimum_state = 'zero_target_expected_by_contract' AND trust_status <> 'EXPECTED_EMPTY'",
    "late_open_classification_failed": "asset_key = 'quality_fixture.late_arrival_open_partition' AND (trust_status <> 'LATE_OPEN' OR completeness_status NOT IN ('LATE_OPEN', 'PARTIAL'))",
}
RULED = ", ".join(f"CASE WHEN {c} THEN '{v}' END" for v, c in TRUST_RULES.items())
# Partitions whose right verdict is known, judged with those observed.
JUDGED = "asset_key partition_key freshness_status completeness_status expected_minimum_state trust_status trust_reason_code"
register(
    "trust_fixtures", ", ".join(f"{c} string" for c in JUDGED.split()) + ", asset_required_for_publication boolean",
    [("quality_fixture.fresh_complete_partition", "2026-06-22", "FRESH", "COMPLETE", "source_rows_required", "TRUSTED", "fresh_and_complete", True),
     ("quality_fixture.expected_empty_day", "2026-06-21", "UNAVAILABLE", "EXPECTED_EMPTY", "no_activity_partition", "EXPECTED_EMPTY", "expected_empty_partition", True),
     ("quality_fixture.expected_exclusion_partition", "2026-06-20", "STALE", "EXPECTED_EMPTY", "zero_target_expected_by_contract", "EXPECTED_EMPTY", "expected_empty_partition", True),
     ("quality_fixture.late_arrival_open_partition", "2026-06-22", "FRESH", "LATE_OPEN", "source_rows_required", "LATE_OPEN", "late_arrival_window_open", True)],
)
# The same fixtures judged wrongly, and partitions that must not pass.
register(
    "wrong_trust_fixtures", ", ".join(f"{c} string" for c in JUDGED.split()) + ", asset_required_for_publication boolean",
    [("quality_fixture.stale_complete_partition", "2026-06-20", "STALE", "COMPLETE", "source_rows_required", "COMPLETE_BUT_STALE", "complete_partition_stale_asset", True),
     ("quality_fixture.recent_row_incomplete_expected_partition", "2026-06-20", "FRESH", "PARTIAL", "source_rows_required", "FRESH_BUT_PARTIAL", "fresh_asset_incomplete_partition", True),
     ("quality_fixture.hidden_missing_partition", "2026-06-20", "FRESH", "MISSING", "source_rows_required", "TRUSTED", "fresh_and_complete", True),
     ("quality_fixture.expected_empty_day", "2026-06-21", "UNAVAILABLE", "MISSING", "no_activity_partition", "UNAVAILABLE", "freshness_or_clock_unavailable", False),
     ("quality_fixture.expected_exclusion_partition", "2026-06-20", "STALE", "MISSING", "zero_target_expected_by_contract", "FAILED", "required_trust_boundary_failed", False),
     ("quality_fixture.late_arrival_open_partition", "2026-06-22", "FRESH", "MISSING", "source_rows_required", "FAILED", "required_trust_boundary_failed", False),
     ("quality_fixture.unknown_status", "2026-06-22", "WARM", "COMPLETE", "source_rows_required", "TRUSTED", "fresh_and_complete", False)],
)
JUDGED_PART = same(JUDGED, "asset_required_for_publication")
OUT = same("asset_key partition_key freshness_status completeness_status trust_status trust_reason_code violation")
add("trust_judged", Model(("trust_state", "trust_fixtures"), parts=(JUDGED_PART, JUDGED_PART)))
add("inv_trust", Model("trust_judged", {**{c: c for c in OUT if c != "violation"}, "violation": "{{each|%s}}" % RULED}))

# Formulas of the daily metrics, recomputed.
FORMULAS = {
    "s_emoji_usage_daily": ("emoji_usage_count_mismatch", "emoji_key, occupation_cohort_key", "emoji_usage_count", "reaction_added_count - reaction_removed_count", "reaction_added_count < 0 OR reaction_removed_count < 0"),
    "s_reaction_valence_daily": ("reaction_valence_count_mismatch", "reaction_valence, occupation_cohort_key", "reaction_valence_count", "added_reaction_count + removed_reaction_count", "added_reaction_count < 0 OR removed_reaction_count < 0"),
    "s_occupation_cohort_daily": ("occupation_share_out_of_range", "occupation_cohort_key", "occupation_cohort_share", "CAST(NULL AS DOUBLE)", "occupation_cohort_share NOT BETWEEN 0 AND 1 OR distinct_user_count < 0 OR distinct_user_count > total_user_count"),
    "s_together_coordination_daily": ("together_coordination_score_mismatch", "activity_type, visibility, together_status, channel_business_key", "together_coordination_success_proxy_score",
                                      "together_created_count + 2 * response_added_count + opened_count + share_count - 3 * reported_count", "together_item_count < 0 OR together_created_count < 0 OR response_added_count < 0 OR reported_count < 0"),
}
add(
    "inv_bdv_formula",
    Model(
        tuple(FORMULAS), same("model_name reporting_date grain_key violation observed_value expected_value"), wheres=tuple(f"{o} <> {e} OR {bad}" for _, _, o, e, bad in FORMULAS.values()),
        parts=tuple({"model_name": f"'{m}'", "reporting_date": "{{date_text|reporting_date}}", "grain_key": f"concat_ws('||', {g})", "violation": f"'{v}'", "observed_value": f"CAST({o} AS DOUBLE)", "expected_value": f"CAST({e} AS DOUBLE)"} for m, (v, g, o, e, _) in FORMULAS.items()),
    ),
)
MARTS = {
    "mart_occupation_cohort_daily": "occupation_cohort_key", "mart_content_performance_daily": "content_reporting_key", "mart_emoji_reaction_daily": "emoji_key, occupation_cohort_key",
    "mart_reaction_valence_daily": "reaction_valence, occupation_cohort_key", "mart_feed_interest_proxy_daily": "feed_item_reporting_key", "mart_together_coordination_daily": "activity_type, visibility, together_status, channel_business_key",
}
add(
    "mart_rows",
    Model(tuple(MARTS), parts=tuple({"model_name": f"'{m}'", "reporting_date": "{{date_text|reporting_date}}", "grain_key": f"concat_ws('||', {g})", **same("source_completeness_label wording_status reporting_timezone"),
                                     "metric_contract_ids": "metric_contract_id" if "emoji" in m else "metric_contract_ids"} for m, g in MARTS.items())),
)
add("inv_mart_duplicate_keys", Model("mart_rows", {"row_count": "count(*)"}, group=same("model_name reporting_date grain_key"), then="row_count > 1"))
WORDINGS = "('direct', 'proxy', 'proxy/partial', 'explicit-signal-only', 'partial')"
add("inv_mart_metadata", Model("mart_rows", where=f"source_completeness_label NOT IN ('source_complete', 'partial', 'unavailable') OR nullif(metric_contract_ids, '') IS NULL OR wording_status NOT IN {WORDINGS} OR reporting_timezone <> 'Europe/Istanbul'"))
add("missing_contracts", Model("metric_contracts", {"metric_contract_id": "l.metric_contract_id"}, join=("mart_contract_coverage", "left anti", "l.metric_contract_id = r.metric_contract_id")))
COVERED = "business_vault_model, expected_grain, source_completeness_label, suppression_rule, wording_status, coverage_status, product_layer_contract_status"
add(
    "inv_mart_contract_ids",
    Model(
        ("missing_contracts", "mart_contract_coverage"), same("violation metric_contract_id detail"),
        wheres=(None, " OR ".join(f"nullif({c}, '') IS NULL" for c in ("business_vault_model", "expected_grain", "suppression_rule", "wording_status"))
                + " OR source_completeness_label NOT IN ('source_complete', 'partial', 'unavailable') OR coverage_status <> 'covered_in_phase2_bdv' OR product_layer_contract_status NOT IN ('product_reporting_phase3_pl', 'bdv_only_pending_pl')"),
        parts=({"violation": "'missing_contract'", "metric_contract_id": "metric_contract_id", "detail": "CAST(NULL AS VARCHAR(1))"}, {"violation": "'invalid_contract_metadata'", "metric_contract_id": "metric_contract_id", "detail": f"concat_ws('||', {COVERED})"}),
    ),
)
add("inv_voice_gate", Model("stg_voice_sessions", same("event_id voice_speaker_activity_legal_mode record_source_mode production_write_enabled"),
                            where="production_write_enabled = true OR (voice_speaker_activity_legal_mode = 'disabled' AND record_source_mode NOT IN ('synthetic_fixture', 'local_contract_test'))"))
EXPECTED_IDS = tuple(r[0] for r in METRIC_CONTRACTS)
