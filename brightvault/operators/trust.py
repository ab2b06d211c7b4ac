"""Reconciliation of landing and stage, and the trust state of each asset's daily partitions.

One pass over the landing table feeds every stage: an event is emitted once for
each stage that should take it, and a single aggregation counts both the
reconciliation and the expected side of the trust state.
"""

from __future__ import annotations

from brightvault.operators.stage import CHANNEL, CONTENT, CONTENT_KEY, FUNNEL, FUNNEL_KEY, ITEM_KEY, REACTIONS, names
from brightvault.plans.constants import LAYERS
from brightvault.plans.model import Model, add, same

CLOCK = "{{clock|evaluated_at}}"
NO_TIME = "CAST(NULL AS TIMESTAMP)"

# Which events a stage takes, and which of those it leaves out for want of a key.
TAKES = {
    "stg_content_events": (f"event_name IN {names(*CONTENT)}", f"{CONTENT_KEY} IS NULL"),
    "stg_reactions": (f"event_name IN {names(*REACTIONS)}", f"{CONTENT_KEY} IS NULL"),
    "stg_feed_events": ("event_name LIKE 'feed_item_%'", f"{ITEM_KEY} IS NULL"),
    "stg_channel_sessions": (f"event_name IN {names(*CHANNEL)}", "{{present|channel_id}} IS NULL"),
    "stg_event_funnel": (f"event_name IN {names(*FUNNEL)}", f"{FUNNEL_KEY} IS NULL"),
    "stg_together_items": ("event_name LIKE 'together_%'", "false"),
}
MISSING = {
    "stg_content_events": "content_business_key IS NULL",
    "stg_reactions": "reaction_hk IS NULL OR content_hk IS NULL",
    "stg_feed_events": "feed_item_hk IS NULL OR content_hk IS NULL",
    "stg_channel_sessions": "channel_hk IS NULL OR channel_session_hk IS NULL",
    "stg_event_funnel": "community_event_hk IS NULL OR event_funnel_action_hk IS NULL",
    "stg_together_items": "together_item_hk IS NULL OR together_target_hk IS NULL",
}
offered = ", ".join("CASE WHEN %s THEN {{st|'%s';;%s;;false}} END" % (takes, m, out) for m, (takes, out) in TAKES.items())
add(
    "offered",
    Model("parsed", {"e": "{{each|%s}}" % offered, "reporting_date": "{{day|occurred_at}}", **same("event_id event_name occurred_at received_at landed_at")}),
)
add(
    "reconcile_source_counts",
    Model(
        "offered", {"accepted_source_count": "count(*)", "accepted_source_distinct_event_count": "{{distinct|event_id}}", "expected_excluded_count": "{{n|e.b}}"},
        group={"source_model": "e.a", "reporting_date": "reporting_date"},
    ),
)
STAGES = tuple(MISSING)
add(
    "reconcile_target_counts",
    Model(
        STAGES, {"row_count": "count(*)", "distinct_event_count": "{{distinct|event_id}}", "missing_business_key_count": "{{n|missing}}"}, group=same("source_model reporting_date"),
        parts=tuple({"source_model": f"'{m}'", **same("reporting_date event_id"), "missing": MISSING[m]} for m in STAGES),
    ),
)
ZEROS = ("expected_rejected_count", "expected_dlq_count", "expected_deduplicated_replay_count", "expected_suppression_count")
BOTH = ("accepted_source_count", "accepted_source_distinct_event_count", "row_count", "distinct_event_count", "expected_excluded_count", "missing_business_key_count")
DELTA = "accepted_source_count - row_count - expected_excluded_count"
add(
    "stage_reconciliation",
    Model(
        "reconcile_source_counts", {
            "source_model": "coalesce(l.source_model, r.source_model)", "reporting_date": "coalesce(l.reporting_date, r.reporting_date)",
            **{c: f"{{{{long|coalesce({c}, 0)}}}}" for c in BOTH}, **{c: "{{long|0}}" for c in ZEROS},
        },
        join=("reconcile_target_counts", "full", "l.source_model = r.source_model AND l.reporting_date = r.reporting_date"),
        after={
            **same("source_model reporting_date", *BOTH, *ZEROS), "reporting_timezone": "'Europe/Istanbul'", "accounting_scope": "'accepted_landing_to_stage'",
            "source_relation": "'analytics.raw_event_landing'", "target_relation": "source_model", "unexplained_delta": DELTA,
            "reconciliation_status": f"CASE WHEN {DELTA} = 0 AND missing_business_key_count = 0 THEN 'explained' ELSE 'unexplained_delta' END",
        },
    ),
)


def asset(model: str) -> str:
    return next(f"{schema}.{model}" for schema, models in LAYERS.items() if model in models)


# Expected side: what feeds an asset, by source: (asset, its distinct key, its event class).
FEEDS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "stg_content_events": (("sat_content_event", "event_id", "event_name"),),
    "stg_reactions": (("sat_reaction_event", "event_id", "event_name"),),
    "stg_feed_events": (("sat_feed_serving_event", "event_id", "event_name"),),
    "stg_channel_sessions": (("sat_channel_session", "event_id", "channel_session_action"),),
    "stg_event_funnel": (("sat_event_metadata", "event_id", "event_funnel_action"),),
    "stg_together_items": (("sat_together_metadata", "event_id", "together_action"),),
    "sat_content_event": (
        ("pit_content_daily", "content_hk", "event_name"), ("s_content_performance_daily", "content_hk", "event_name"), ("s_occupation_cohort_daily", "subject_user_hk", "occupation_cohort_key"),
    ),
    "sat_reaction_event": (
        ("br_content_reaction_daily", "reaction_hk", "reaction_action"), ("s_occupation_cohort_daily", "subject_user_hk", "occupation_cohort_key"),
        ("s_emoji_usage_daily", "reaction_hk", "emoji_key"), ("s_reaction_valence_daily", "reaction_hk", "reaction_valence"),
    ),
    "sat_feed_serving_event": (("br_feed_interest_proxy", "feed_item_hk", "event_name"), ("s_occupation_cohort_daily", "subject_user_hk", "occupation_cohort_key")),
    "sat_channel_session": (("s_channel_session_daily", "channel_session_hk", "channel_session_action"),),
    "sat_event_metadata": (
        ("pit_event_daily", "community_event_hk", "event_funnel_action"), ("br_event_funnel", "event_funnel_action_hk", "event_funnel_action"), ("s_event_funnel_daily", "event_funnel_action_hk", "event_funnel_action"),
    ),
    "sat_together_metadata": tuple((a, "together_item_hk", "together_action") for a in ("pit_together_daily", "br_together_response_flow", "s_together_coordination_daily")),
    "s_occupation_cohort_daily": (("mart_occupation_cohort_daily", "occupation_cohort_key", "source_completeness_label"),),
    "s_content_performance_daily": (("mart_content_performance_daily", "content_hk", "source_completeness_label"),),
    "s_emoji_usage_daily": (("mart_emoji_reaction_daily", "emoji_key", "source_completeness_label"),),
    "s_reaction_valence_daily": (("mart_reaction_valence_daily", "reaction_valence", "source_completeness_label"),),
    "br_feed_interest_proxy": (("mart_feed_interest_proxy_daily", "feed_item_hk", "source_completeness_label"),),
    "s_together_coordination_daily": (("mart_together_coordination_daily", "concat_ws('||', activity_type, visibility, together_status, channel_business_key)", "source_completeness_label"),),
}


def feed(model: str) -> dict[str, str]:
    each = ", ".join("{{st|'%s';;%s;;%s}}" % (asset(a), k, c) for a, k, c in FEEDS[model])
    daily = model.startswith(("s_", "br_"))
    return {
        "e": "{{each|%s}}" % each, "reporting_date": "reporting_date", "excluded": "false",
        "occurred_at": ("latest_event_at" if model == "s_content_performance_daily" else NO_TIME) if daily else "occurred_at",
        "received_at": NO_TIME if daily else "received_at", "load_at": "load_datetime",
        "reportable": "small_cell_suppression_status = 'reportable'" if daily else "false",
    }


LANDED = {
    "e": "{{st|concat('stage.', e.a);;event_id;;event_name}}", "reporting_date": "reporting_date", "excluded": "e.b", "occurred_at": "occurred_at",
    "received_at": "received_at", "load_at": "landed_at", "reportable": "false",
}
MINIMUM = (
    "CASE WHEN min(e.a) LIKE 'stage.%' THEN count(*) - count_if(excluded) WHEN min(e.a) LIKE 'raw_vault.%' THEN count(*)"
    " WHEN min(e.a) LIKE 'business_vault.%' THEN 1 ELSE count_if(reportable) END"
)
SOURCE = ("upstream_activity_count", "expected_target_min_row_count", "source_distinct_key_count", "source_event_class_count")
add(
    "trust_source_obs",
    Model(
        ("offered", *FEEDS), {
            "upstream_activity_count": "count(*)", "expected_target_min_row_count": "{{long|%s}}" % MINIMUM, "source_distinct_key_count": "{{distinct|e.b}}",
            "source_event_class_count": "{{distinct|e.c}}", "latest_source_event_at": "max(occurred_at)", "latest_source_received_at": "max(received_at)", "latest_source_load_datetime": "max(load_at)",
        }, group={"asset_key": "e.a", "reporting_date": "reporting_date"}, parts=(LANDED, *(feed(m) for m in FEEDS)),
    ),
)

# Observed side: distinct key and remaining grain (besides the date), time of the last event.
LINES = "source_topic {{txt|source_partition}} {{txt|source_offset}}"
OBSERVED: dict[str, tuple[str, str, str]] = {m: ("event_id", "event_id", "occurred_at") for m in STAGES}
for sat, hk in (("content_event", "content"), ("reaction_event", "reaction"), ("feed_serving_event", "feed_item"), ("channel_session", "channel_session"), ("event_metadata", "event_funnel_action"), ("together_metadata", "together_item")):
    OBSERVED[f"sat_{sat}"] = (f"{hk}_hk", f"{hk}_hk {LINES}", "occurred_at")
TOGETHER = "activity_type visibility together_status channel_business_key"
OBSERVED |= {
    "pit_content_daily": ("content_hk", "content_hk", "latest_event_at"),
    "br_content_reaction_daily": ("content_hk", "content_hk reaction_key emoji_key reaction_valence", NO_TIME),
    "s_occupation_cohort_daily": ("occupation_cohort_key", "occupation_cohort_key", NO_TIME),
    "s_content_performance_daily": ("content_hk", "content_hk", "latest_event_at"),
    "s_emoji_usage_daily": ("emoji_key", "emoji_key occupation_cohort_key", NO_TIME),
    "s_reaction_valence_daily": ("reaction_valence", "reaction_valence occupation_cohort_key", NO_TIME),
    "br_feed_interest_proxy": ("feed_item_hk", "feed_item_hk content_business_key", NO_TIME),
    "s_channel_session_daily": ("channel_hk", "channel_hk", NO_TIME),
    "pit_event_daily": ("event_hk", "event_hk", "latest_event_at"),
    "br_event_funnel": ("event_hk", "event_hk event_funnel_action", NO_TIME),
    "s_event_funnel_daily": ("event_funnel_action", "event_funnel_action", NO_TIME),
    "pit_together_daily": ("together_item_hk", "together_item_hk", "latest_event_at"),
    "br_together_response_flow": ("together_item_hk", "together_item_hk response_type together_status", NO_TIME),
    "s_together_coordination_daily": ("*", TOGETHER, NO_TIME),
    "mart_occupation_cohort_daily": ("occupation_cohort_key", "occupation_cohort_key", NO_TIME),
    "mart_content_performance_daily": ("content_reporting_key", "content_reporting_key", "latest_event_at"),
    "mart_emoji_reaction_daily": ("emoji_key", "emoji_key occupation_cohort_key", NO_TIME),
    "mart_reaction_valence_daily": ("reaction_valence", "reaction_valence occupation_cohort_key", NO_TIME),
    "mart_feed_interest_proxy_daily": ("feed_item_reporting_key", "feed_item_reporting_key content_business_key", NO_TIME),
    "mart_together_coordination_daily": ("*", TOGETHER, NO_TIME),
}


def observed(model: str) -> dict[str, str]:
    key, grain, event = OBSERVED[model]
    grain = f"concat_ws('||', {', '.join(grain.split())})"
    load = "refreshed_at" if model.startswith("mart_") else "as_of_datetime" if model == "pit_content_daily" else "load_datetime"
    return {"asset_key": f"'{asset(model)}'", "reporting_date": "reporting_date", "k": grain if key == "*" else key, "grain": grain, "event_at": event, "load_at": load}


TARGET = ("observed_row_count", "observed_distinct_key_count", "duplicate_final_grain_count")
add(
    "trust_target_obs",
    Model(
        tuple(OBSERVED), {
            "observed_row_count": "count(*)", "observed_distinct_key_count": "{{distinct|k}}", "duplicate_final_grain_count": "count(*) - {{distinct|grain}}",
            "latest_target_event_at": "max(event_at)", "latest_target_load_datetime": "max(load_at)",
        }, group=same("asset_key reporting_date"), parts=tuple(observed(m) for m in OBSERVED),
    ),
)
add(
    "trust_partition_obs",
    Model(
        "trust_source_obs", {
            "asset_key": "coalesce(l.asset_key, r.asset_key)", "reporting_date": "coalesce(l.reporting_date, r.reporting_date)",
            **{c: f"{{{{long|coalesce({c}, 0)}}}}" for c in (*SOURCE, *TARGET)},
            **same("latest_source_event_at latest_source_received_at latest_source_load_datetime latest_target_event_at latest_target_load_datetime"),
        }, join=("trust_target_obs", "full", "l.asset_key = r.asset_key AND l.reporting_date = r.reporting_date"),
    ),
)
# Both sides are columns of the joined observations, so freshness needs no second pass.
add(
    "trust_asset_freshness",
    Model("trust_partition_obs", {"latest_source_event_at": "max(greatest(coalesce(latest_source_event_at, latest_target_event_at), coalesce(latest_target_event_at, latest_source_event_at)))",
                                  "latest_load_datetime": "max(greatest(coalesce(latest_source_load_datetime, latest_target_load_datetime), coalesce(latest_target_load_datetime, latest_source_load_datetime)))"},
          group=same("asset_key")),
)
CONTRACT = "asset_layer freshness_evaluation_basis freshness_timestamp_field freshness_target_minutes max_clock_skew_minutes late_arrival_grace_minutes expected_minimum_mode asset_required_for_publication"
add("trust_contracted", Model("trust_partition_obs", {"asset_key": "l.asset_key", **same("reporting_date", *SOURCE, *TARGET, CONTRACT)}, join=("asset_contracts", "inner", "l.asset_key = r.asset_key")))
add(
    "trust_with_contract",
    Model(
        "trust_contracted", {
            "asset_key": "l.asset_key", **same("reporting_date", *SOURCE, *TARGET, CONTRACT, "latest_source_event_at latest_load_datetime"), "reporting_timezone": "'Europe/Istanbul'",
            "evaluated_at": CLOCK, "partition_complete_after": "{{closes|reporting_date}}",
        }, join=("trust_asset_freshness", "left", "l.asset_key = r.asset_key"),
    ),
)
KEPT = same("asset_key reporting_date reporting_timezone", CONTRACT, *SOURCE, *TARGET, "latest_source_event_at latest_load_datetime evaluated_at partition_complete_after")
NOTHING = "upstream_activity_count = 0 AND expected_target_min_row_count = 0 AND observed_row_count = 0"
AHEAD = "latest_load_datetime > {{plus_minutes|evaluated_at;;max_clock_skew_minutes}}"
OPEN = "evaluated_at <= {{plus_minutes|partition_complete_after;;late_arrival_grace_minutes}}"
add(
    "trust_freshness_status",
    Model(
        "trust_with_contract", {**KEPT, "freshness_lag_minutes": "{{minutes|evaluated_at;;latest_load_datetime}}"},
        after={
            **KEPT, "freshness_lag_minutes": "freshness_lag_minutes",
            "freshness_status": f"CASE WHEN latest_load_datetime IS NULL THEN 'UNAVAILABLE' WHEN {AHEAD} THEN 'CLOCK_SKEW' WHEN freshness_lag_minutes <= freshness_target_minutes THEN 'FRESH' ELSE 'STALE' END",
            "freshness_reason_code": f"CASE WHEN latest_load_datetime IS NULL THEN 'no_freshness_timestamp' WHEN {AHEAD} THEN 'latest_load_after_evaluation_clock_skew'"
            " WHEN freshness_lag_minutes <= freshness_target_minutes THEN 'within_target' ELSE 'freshness_target_exceeded' END",
        },
    ),
)
# Cases in order: condition, completeness, reason.
CASES = (
    (NOTHING, "EXPECTED_EMPTY", "expected_empty_proven_by_source_observation"),
    ("upstream_activity_count > 0 AND expected_target_min_row_count = 0 AND observed_row_count = 0", "EXPECTED_EMPTY", "expected_exclusion_proven_by_source_contract"),
    (f"expected_target_min_row_count > 0 AND observed_row_count = 0 AND {OPEN}", "LATE_OPEN", "partition_inside_late_arrival_window"),
    ("expected_target_min_row_count > 0 AND observed_row_count = 0", "MISSING", "required_partition_missing"),
    (f"observed_row_count < expected_target_min_row_count AND {OPEN}", "LATE_OPEN", "observed_rows_below_contract_minimum"),
    ("observed_row_count < expected_target_min_row_count", "PARTIAL", "observed_rows_below_contract_minimum"),
    ("observed_row_count > 0 AND observed_distinct_key_count = 0", "PARTIAL", "canonical_key_count_zero"),
    ("duplicate_final_grain_count > 0", "PARTIAL", "duplicate_final_grain"),
)
FRESH = same("freshness_lag_minutes freshness_status freshness_reason_code")
add(
    "trust_completeness_status",
    Model(
        "trust_freshness_status", {
            **KEPT, **FRESH,
            "late_arrival_state": f"CASE WHEN {OPEN} THEN 'inside_late_arrival_window' ELSE 'closed_partition' END",
            "expected_minimum_state": f"CASE WHEN {NOTHING} THEN 'no_activity_partition' WHEN upstream_activity_count > 0 AND expected_target_min_row_count = 0 THEN 'zero_target_expected_by_contract'"
            " WHEN expected_minimum_mode = 'reportable_partition' THEN 'reportable_rows_from_bdv' WHEN expected_minimum_mode = 'aggregate_partition'"
            " THEN 'structural_daily_row_required_when_source_active' ELSE 'source_rows_required' END",
            "completeness_status": "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s, _ in CASES) + " ELSE 'COMPLETE' END",
            "completeness_reason_code": "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in CASES) + " ELSE 'partition_structurally_complete' END",
        },
    ),
)
TRUST = (
    ("completeness_status = 'EXPECTED_EMPTY'", "EXPECTED_EMPTY", "expected_empty_partition"),
    ("completeness_status = 'LATE_OPEN'", "LATE_OPEN", "late_arrival_window_open"),
    ("freshness_status = 'FRESH' AND completeness_status = 'COMPLETE'", "TRUSTED", "fresh_and_complete"),
    ("freshness_status = 'STALE' AND completeness_status = 'COMPLETE'", "COMPLETE_BUT_STALE", "complete_partition_stale_asset"),
    ("freshness_status = 'FRESH' AND completeness_status IN ('PARTIAL', 'MISSING')", "FRESH_BUT_PARTIAL", "fresh_asset_incomplete_partition"),
    ("freshness_status IN ('UNAVAILABLE', 'CLOCK_SKEW')", "UNAVAILABLE", "freshness_or_clock_unavailable"),
)
JUDGED = same("late_arrival_state expected_minimum_state completeness_status completeness_reason_code")
OUT = {k: v for k, v in KEPT.items() if k not in ("partition_complete_after", "expected_minimum_mode")} | FRESH | JUDGED
add(
    "trust_state",
    Model(
        "trust_completeness_status", {
            **OUT, "partition_key": "{{date_text|reporting_date}}",
            "complete_through_date": "max(CASE WHEN completeness_status IN ('COMPLETE', 'EXPECTED_EMPTY') THEN reporting_date END) OVER (PARTITION BY asset_key)",
            "trust_status": "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for c, s, _ in TRUST) + " ELSE 'FAILED' END",
            "trust_reason_code": "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in TRUST) + " ELSE 'required_trust_boundary_failed' END",
        },
        after={**same(*OUT, "partition_key trust_status trust_reason_code"), "complete_through": "{{closes|complete_through_date}}"},
    ),
)
add("late_arrival_flag", Model("sat_content_event", {"late_arriving_event_count": "{{n|{{day|load_datetime}} > reporting_date}}", "event_count": "count(*)"}, group=same("content_hk reporting_date")))
add(
    "late_open_window",
    Model("reconcile_source_counts", {"closes_at": "min({{closes|reporting_date}})", "open_until": "min({{plus_minutes|{{closes|reporting_date}};;180}})"}, group=same("source_model reporting_date")),
)
# The registries, with what the published tables show of them.
add("contract_usage", Model("contract_uses", {"published_rows": "count(*)"}, group=same("metric_contract_id")))
add("contract_uses", Model("mart_rows", {"metric_contract_id": "{{split|metric_contract_ids}}"}))
REGISTRY = "business_vault_model expected_grain suppression_rule wording_status product_layer_contract_status"
add(
    "registered",
    Model("metric_contracts", {"metric_contract_id": "l.metric_contract_id", **same(REGISTRY), "published_rows": "{{long|coalesce(r.published_rows, 0)}}"}, join=("contract_usage", "left", "l.metric_contract_id = r.metric_contract_id")),
)
add("bdv_contract_coverage", Model("registered", {**same("metric_contract_id published_rows", REGISTRY), "source_completeness_label": "'partial'", "coverage_status": "'covered_in_phase2_bdv'"}))
add("mart_contract_coverage", Model("bdv_contract_coverage", same("metric_contract_id published_rows source_completeness_label coverage_status", REGISTRY)))
add("metric_contract_registry", Model("bdv_contract_coverage", same("metric_contract_id business_vault_model expected_grain suppression_rule wording_status coverage_status published_rows")))
add("asset_days", Model("offered", {"observed_days": "{{distinct|reporting_date}}"}, group={"asset": "concat('stage.', e.a)"}))
add("asset_contract_registry", Model("asset_contracts", {**same("asset_key", CONTRACT), "observed_days": "{{long|coalesce(observed_days, 0)}}"}, join=("asset_days", "left", "l.asset_key = r.asset")))
