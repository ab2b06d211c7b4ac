"""Constant relations: the registries of metric contracts and of trusted assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Metric contract, model, grain, suppression rule, wording, status of publication. All are labelled 'partial'.
ACTORS = "suppress_before_pl when distinct_actor_count < 10"
EVENTS = "suppress_before_pl when actor_event_count < 10"
PLACE = "reporting_date x activity_type x visibility x status x channel"
PL, LATER = "product_reporting_phase3_pl", "bdv_only_pending_pl"
METRIC_CONTRACTS = (
    ("occupation_cohort_user_count_daily", "s_occupation_cohort_daily", "reporting_date x occupation_cohort_key", "suppress_before_pl when distinct_user_count < 10", "direct", PL),
    ("occupation_cohort_share_daily", "s_occupation_cohort_daily", "reporting_date x occupation_cohort_key", "suppress_before_pl when numerator or denominator < 10", "direct", PL),
    ("most_liked_content_daily", "s_content_performance_daily", "reporting_date x content_hk", ACTORS, "direct", PL),
    ("content_performance_score_daily", "s_content_performance_daily", "reporting_date x content_hk", ACTORS, "proxy/partial", PL),
    ("emoji_usage_count_daily", "s_emoji_usage_daily", "reporting_date x emoji_key", ACTORS, "direct", PL),
    ("reaction_valence_count_daily", "s_reaction_valence_daily", "reporting_date x reaction_valence", ACTORS, "explicit-signal-only", PL),
    ("feed_interest_proxy_score_daily", "br_feed_interest_proxy", "reporting_date x content_business_key", ACTORS, "proxy/partial", PL),
    ("feed_interest_source_completeness_daily", "br_feed_interest_proxy", "reporting_date x content_business_key or reporting_date x feed_mode", "no user-level output", "partial", PL),
    ("channel_session_count_daily", "s_channel_session_daily", "reporting_date x channel_hk", ACTORS, "direct", LATER),
    ("channel_session_duration_ms_daily", "s_channel_session_daily", "reporting_date x channel_hk", ACTORS, "direct", LATER),
    ("event_funnel_action_count_daily", "s_event_funnel_daily", "reporting_date x event_funnel_action", EVENTS, "proxy", LATER),
    ("event_join_conversion_proxy_daily", "s_event_funnel_daily", "reporting_date x event_funnel_action", EVENTS, "proxy", LATER),
    ("together_items_created_count_daily", "s_together_coordination_daily", PLACE, ACTORS, "proxy", PL),
    ("together_response_count_daily", "s_together_coordination_daily", PLACE, ACTORS, "proxy", PL),
    ("together_coordination_success_proxy_daily", "s_together_coordination_daily", PLACE, ACTORS, "proxy/partial", PL),
)

# Trusted asset, layer, what its freshness is judged by, the column of that, minutes within which it is fresh, of clock skew and of late arrival, how the least rows are told, whether publication needs it.
ASSETS = (
    ("stage.stg_content_events", "Stage", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("stage.stg_reactions", "Stage", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("stage.stg_feed_events", "Stage", "load_time", "load_datetime", 15, 5, 180, "one_to_one_partition", True),
    ("stage.stg_channel_sessions", "Stage", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("stage.stg_event_funnel", "Stage", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("stage.stg_together_items", "Stage", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_content_event", "RDV satellite", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_reaction_event", "RDV satellite", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_feed_serving_event", "RDV satellite", "load_time", "load_datetime", 15, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_channel_session", "RDV satellite", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_event_metadata", "RDV satellite", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("raw_vault.sat_together_metadata", "RDV satellite", "load_time", "load_datetime", 60, 5, 180, "one_to_one_partition", True),
    ("business_vault.pit_content_daily", "BDV daily", "as_of_time", "as_of_datetime", 60, 5, 180, "aggregate_partition", True),
    ("business_vault.br_content_reaction_daily", "BDV daily", "load_time", "load_datetime", 60, 5, 180, "aggregate_partition", True),
    ("business_vault.s_occupation_cohort_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.s_content_performance_daily", "BDV daily", "load_time", "load_datetime", 60, 5, 180, "aggregate_partition", True),
    ("business_vault.s_emoji_usage_daily", "BDV daily", "load_time", "load_datetime", 60, 5, 180, "aggregate_partition", True),
    ("business_vault.s_reaction_valence_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.br_feed_interest_proxy", "BDV daily", "load_time", "load_datetime", 60, 5, 180, "aggregate_partition", True),
    ("business_vault.s_channel_session_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.pit_event_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.br_event_funnel", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.s_event_funnel_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.pit_together_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.br_together_response_flow", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("business_vault.s_together_coordination_daily", "BDV daily", "load_time", "load_datetime", 1440, 5, 180, "aggregate_partition", True),
    ("mart.mart_occupation_cohort_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 1440, 5, 180, "reportable_partition", True),
    ("mart.mart_content_performance_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 60, 5, 180, "reportable_partition", True),
    ("mart.mart_emoji_reaction_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 60, 5, 180, "reportable_partition", True),
    ("mart.mart_reaction_valence_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 1440, 5, 180, "reportable_partition", True),
    ("mart.mart_feed_interest_proxy_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 60, 5, 180, "reportable_partition", True),
    ("mart.mart_together_coordination_daily", "PL mart", "mart_complete_through_time", "refreshed_at", 1440, 5, 180, "reportable_partition", True),
)
#: Models by schema.
LAYERS = {schema: tuple(a[0].split(".")[1] for a in ASSETS if a[0].startswith(schema + ".")) for schema in ("stage", "raw_vault", "business_vault", "mart")}

#: Name: (columns as DDL, rows).
CONSTANTS = {
    "metric_contracts": (
        "metric_contract_id string, business_vault_model string, expected_grain string, suppression_rule string, wording_status string, product_layer_contract_status string",
        list(METRIC_CONTRACTS),
    ),
    "asset_contracts": (
        "asset_key string, asset_layer string, freshness_evaluation_basis string, freshness_timestamp_field string, freshness_target_minutes int, max_clock_skew_minutes int,"
        " late_arrival_grace_minutes int, expected_minimum_mode string, asset_required_for_publication boolean",
        list(ASSETS),
    ),
}


def register(name: str, ddl: str, rows: list[tuple]) -> None:
    CONSTANTS[name] = (ddl, rows)


def constant(spark: SparkSession, name: str) -> DataFrame:
    ddl, rows = CONSTANTS[name]
    return spark.createDataFrame(rows, ddl)


def constant_sql(name: str) -> str:
    ddl, rows = CONSTANTS[name]
    lit = lambda v: str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + ") t(" + ", ".join(c.split()[0] for c in ddl.split(",")) + ")"
