"""Models against the checking SQL, and checks against injected faults."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from brightvault.operators.contracts import CONTRACTS, OTHER
from brightvault.plans import catalog
from brightvault.plans.by_hand import by_hand
from brightvault.plans.model import checking_sql, frame

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.10g}")
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v.isoformat() if hasattr(v, "isoformat") else v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(v[i]) for i in order) for v in values], key=repr)


@pytest.mark.parametrize(
    "name",
    ["stg_channel_sessions", "stg_voice_sessions", "h_channel", "l_event_participant", "sat_feed_serving_event", "pit_content_daily", "s_voice_speech_activity_daily", "mart_reaction_valence_daily", "stage_reconciliation", "ingest_validate", "hourly_parity_guard", "l_user_channel_session",
     "s_occupation_cohort_daily", "dlq_topic_record", "hot_bounded_columns", "privacy_forbidden_scan", "evidence_forbidden_keys", "evidence_unsafe_values", "evidence_dlq_count"],
)
def test_matches_the_checking_sql(spark, name):
    got = catalog.queries()[name](spark, DIR)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{DIR}/events.parquet'")
    want = con.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_statements_by_hand_agree_with_the_models():
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{DIR}/events.parquet'")
    for name, sql in by_hand(catalog.landing_sql()).items():
        one, two = con.sql(sql), con.sql(checking_sql(name, catalog.base()))
        assert sorted(one.columns) == sorted(two.columns) and rows(one.columns, one.fetchall()) == rows(two.columns, two.fetchall()), name


@pytest.fixture(scope="module")
def tables(spark):
    return catalog.given(spark, DIR)


def test_contradicting_hashes_are_found(spark, tables):
    landing = tables["landing"].where("source_offset < 50")
    twice = landing.unionByName(landing.limit(1).withColumn("raw_record_sha256", F.lit("other")))
    assert frame("inv_contradiction", tables | {"landing": landing}).count() == 0
    assert frame("inv_contradiction", tables | {"landing": twice}).count() == 1


def test_unbalanced_stages_are_found(spark, tables):
    good = frame("stage_reconciliation", tables)
    assert frame("inv_unbalanced", {"stage_reconciliation": good}).count() == 0
    assert frame("inv_unbalanced", {"stage_reconciliation": good.withColumn("unexplained_delta", F.lit(1).cast("long"))}).count() == good.count()


def test_missing_hubs_are_found(spark, tables):
    given = tables | {"h_channel": frame("h_channel", tables).where("false")}
    assert frame("orphans_l_user_channel_session_channel_hk", given).count() > 0
    assert frame("orphans_l_user_channel_session_channel_hk", tables).count() == 0


def test_satellite_conflicts_and_replays(spark, tables):
    sat = frame("sat_rows", tables).where("model_name = 'sat_content_event'").limit(20)
    twice = sat.unionByName(sat)
    drift = sat.unionByName(sat.withColumn("hashdiff", F.lit("other")))
    assert frame("inv_sat_replay", {"sat_rows": sat}).count() == 0 and frame("inv_sat_replay", {"sat_rows": twice}).count() == 20
    assert frame("inv_sat_grain", {"sat_rows": drift}).count() == 20 and frame("inv_sat_state", {"sat_rows": drift}).count() == 20


VIOLATIONS = {
    "inv_hub_guard": {"hub_required_field_null", "duplicate_hash_key", "business_key_hash_drift", "hash_key_business_key_drift"},
    "inv_satellite_guard": {"satellite_grain_conflict", "satellite_duplicate_exact_replay", "satellite_hashdiff_state_drift", "satellite_event_timestamp_missing"},
    "inv_link_guard": {"link_or_participant_key_null", "link_load_metadata_missing", "duplicate_link_hash_key", "link_hash_participant_drift", "channel_hub_missing"},
    "inv_pit_content_guard": {
        "pit_duplicate_daily_grain", "pit_required_field_null", "pit_selected_satellite_after_as_of", "pit_late_arrival_not_surfaced_or_blocked", "pit_deleted_or_opted_out_subject_reappeared",
    },
    "inv_bdv_formula_guard": {"emoji_usage_count_mismatch", "reaction_valence_count_mismatch", "occupation_share_out_of_range", "together_coordination_score_mismatch"},
    "inv_mart_contract_ids_guard": {"missing_contract", "invalid_contract_metadata"},
    "privacy_invariants_guard": {"failed_candidate_published", "missing_audit_kind"},
    "inv_trust_guard": {
        "invalid_status_value", "required_partition_not_trusted", "freshness_hidden_missing_or_partial_partition", "expected_empty_classification_failed",
        "expected_exclusion_classification_failed", "late_open_classification_failed",
    },
}


@pytest.mark.parametrize("name", sorted(VIOLATIONS))
def test_guards_find_each_fault(spark, name):
    assert {r.violation for r in catalog.queries()[name](spark, DIR).select("violation").distinct().collect()} >= VIOLATIONS[name]


@pytest.mark.parametrize("name", ["inv_reconciliation_negative", "inv_mart_metadata_guard", "inv_mart_duplicate_keys_guard", "inv_voice_gate_guard", "hourly_parity_guard", "inv_forbidden_columns_guard", "inv_voice_forbidden_columns_guard"])
def test_guards_find_something(spark, name):
    assert not catalog.queries()[name](spark, DIR).isEmpty()


def test_forbidden_keys_are_counted_at_any_depth(spark):
    from brightvault.plans import extra
    from brightvault.streaming.validate import BLOCKED, keys_at_any_depth

    rows = [('{"a":1}', 0), ('{"E-Mail":1,"b":[{"user id":2},{"phone":{"lat":1}}]}', 4), ('{"a":"\\"email\\":1"}', 0), (None, None)]
    df = spark.createDataFrame(rows, "t string, n int").select("n", extra.F.size(extra.F.filter(keys_at_any_depth(extra.F.col("t")), lambda k: k.isin(*BLOCKED))).alias("got"))
    assert all(r.got == r.n or r.n is None for r in df.collect())


def test_a_changed_input_is_landed_anew(spark, tmp_path):
    from brightvault.sources import adapter

    events = spark.read.parquet(f"{DIR}/events.parquet")
    events.limit(10).write.parquet(str(tmp_path / "events.parquet"))
    assert adapter.stored(spark, str(tmp_path)).count() == 10
    events.limit(5).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert adapter.stored(spark, str(tmp_path)).count() == 15


def test_tables_stay_for_other_applications_where_a_folder_is_named(spark, tmp_path):
    from brightvault.sources import shared

    source, made = tmp_path / "in", []

    def make():
        made.append(1)
        return spark.range(3)

    spark.range(1).write.parquet(str(source))
    spark.conf.set(shared.TABLES, str(tmp_path / "tables"))
    try:
        assert [shared.stored(spark, str(source), "t", make).count() for _ in range(2)] == [3, 3] and len(made) == 1
        shared._stored.clear()  # as another application would begin
        assert shared.stored(spark, str(source), "t", make).count() == 3 and len(made) == 1
        spark.range(1).write.mode("append").parquet(str(source))
        shared.stored(spark, str(source), "t", make)
        assert len(made) == 2
    finally:
        spark.conf.unset(shared.TABLES)


def test_a_change_deep_below_is_a_new_version(spark, tmp_path):
    from brightvault.sources.shared import version

    spark.range(4).selectExpr("id", "id % 2 AS a", "id % 2 AS b").write.partitionBy("a", "b").parquet(str(tmp_path / "t"))
    one = version(spark, str(tmp_path / "t"))
    assert version(spark, str(tmp_path / "t")) == one
    spark.range(1).write.mode("append").parquet(str(tmp_path / "t" / "a=0" / "b=0"))
    assert version(spark, str(tmp_path / "t")) != one


def trust_row(**change):
    base = {"asset_key": "a", "reporting_date": datetime.date(2024, 1, 2), "reporting_timezone": "z", "asset_layer": "x", "freshness_evaluation_basis": "b", "freshness_timestamp_field": "f", "freshness_target_minutes": 60,
            "max_clock_skew_minutes": 5, "late_arrival_grace_minutes": 180, "expected_minimum_mode": "one_to_one_partition", "asset_required_for_publication": True, "upstream_activity_count": 5,
            "expected_target_min_row_count": 5, "source_distinct_key_count": 5, "source_event_class_count": 1, "observed_row_count": 5, "observed_distinct_key_count": 5, "duplicate_final_grain_count": 0,
            "latest_source_event_at": datetime.datetime(2024, 1, 4, 11), "latest_load_datetime": datetime.datetime(2024, 1, 4, 11, 30), "evaluated_at": datetime.datetime(2024, 1, 4, 12), "partition_complete_after": datetime.datetime(2024, 1, 2, 21)}
    return base | change


@pytest.mark.parametrize(
    ("change", "status"),
    [
        ({}, "TRUSTED"),
        ({"latest_load_datetime": datetime.datetime(2024, 1, 4, 10, 59)}, "COMPLETE_BUT_STALE"),
        ({"latest_load_datetime": datetime.datetime(2024, 1, 4, 12, 6)}, "UNAVAILABLE"),
        ({"latest_load_datetime": None}, "UNAVAILABLE"),
        ({"observed_row_count": 4}, "FRESH_BUT_PARTIAL"),
        ({"observed_row_count": 0}, "FRESH_BUT_PARTIAL"),
        ({"observed_row_count": 0, "partition_complete_after": datetime.datetime(2024, 1, 4, 9)}, "LATE_OPEN"),
        ({"duplicate_final_grain_count": 1}, "FRESH_BUT_PARTIAL"),
        ({"expected_target_min_row_count": 0, "observed_row_count": 0}, "EXPECTED_EMPTY"),
        ({"upstream_activity_count": 0, "expected_target_min_row_count": 0, "observed_row_count": 0}, "EXPECTED_EMPTY"),
    ],
)
def test_trust_states(spark, change, status):
    row = trust_row(**change)
    kinds = {str: "string", int: "long", bool: "boolean", datetime.date: "date", datetime.datetime: "timestamp"}
    ddl = ", ".join(f"{k} {kinds[type(v)] if v is not None else 'timestamp'}" for k, v in row.items())
    df = spark.createDataFrame([tuple(row.values())], ddl)
    df = df.withColumns({c: F.col(c).cast("int") for c in row if c.endswith("_minutes")})
    assert [r.trust_status for r in frame("trust_state", {"trust_with_contract": df}).collect()] == [status]


def test_contracts_on_tables_of_their_own(spark):
    audit = spark.createDataFrame(
        [("r1", "p", "e", "published", "passed", "m", "completed", False, False, False, False), ("r1", None, "e", "published", "failed", None, "open", True, False, False, False)],
        "lifecycle_run_id string, retention_policy_id string, evidence_id string, anonymous_publish_status string, anonymization_check_status string, anonymization_method_version string,"
        " expired_personal_purge_status string, stable_identifier_present boolean, exact_timestamp_present boolean, exact_location_present boolean, disallowed_dimension_present boolean",
    )
    got = {r.check_name: r.failed_count for r in frame("contract_privacy_lifecycle", {"privacy_lifecycle_audit": audit}).collect()}
    assert len(got) == len(OTHER["contract_privacy_lifecycle"][1]) and sorted(got.values()) == [0, 0, 1, 1, 1, 1, 1]
    recap = spark.createDataFrame([("s", "2024-01", "other", "p", None, False)], "subject_key string, month string, purpose_id string, retention_policy_id string, consent_or_service_activation_id string, production_collection_enabled_before_legal_go boolean")
    assert sum(r.failed_count for r in frame("contract_personal_recap", {"personal_recap_monthly": recap}).collect()) == 2
    assert sum(len(c) for _, c in CONTRACTS.values()) > 60
