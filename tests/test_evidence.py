"""Forbidden keys, evidence criteria, the clock and canonical hashes, each on a case that fails."""

import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from brightvault.functions.dialect import at
from brightvault.operators.contracts import RAW_KEYS, SMOKE_KEYS
from brightvault.operators.lifecycle import CANARY_NAMES, EVIDENCE_KEYS, INTERACTIONS
from brightvault.plans import catalog
from brightvault.plans import evidence as ev
from brightvault.plans.model import frame
from brightvault.sources.adapter import STEPS
from brightvault.streaming.validate import validated

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def one(spark):
    """A landed event, as a dictionary."""
    row = catalog.given(spark, DIR)["landing"].select(*STEPS[-1]).limit(1)
    return row


def test_lists_are_whole():
    assert len(RAW_KEYS) == len(set(RAW_KEYS)) == 58 and len(SMOKE_KEYS) == len(set(SMOKE_KEYS)) == 78
    voice = {"raw_audio", "audio_frame", "spoken_words", "caption", "summary", "topic", "sentiment", "emotion", "voiceprint", "speaker_embedding", "speaker_identity", "speaking_timeline", "speaking_interval", "vad_frame_list",
             "co_participant_key", "pairwise_duration", "private_room_name", "raw_room_title", "ocr", "raw_filename"}
    assert set(SMOKE_KEYS) - set(RAW_KEYS) == voice and set(RAW_KEYS) < set(SMOKE_KEYS)
    assert {"body", "message", "note", "note_body", "raw_note", "staff_id", "gps", "lat", "lon", "search_text", "contact_value", "reveal_value", "payload_value", "support_payload", "support_contact"} <= set(RAW_KEYS)


@pytest.mark.parametrize(("query", "column", "keys"), [("contract_landing", "failed_count", RAW_KEYS), ("landing_smoke_metrics", "raw_identifier_rows", SMOKE_KEYS)])
def test_a_row_for_each_key_is_counted(spark, one, query, column, keys):
    leaks = [(k, "payload", f'{{"a": [{{"{k}": 1}}]}}') for k in keys] + [(k, "subject", f'{{"{k.upper()}": 1}}') for k in keys]
    near = [(k, "payload", f'{{"x{k}": 1, "{k}_count": 2}}') for k in keys if f"x{k}" not in keys and f"{k}_count" not in keys]
    rows = spark.createDataFrame([(f"{i}-{k}", c, t) for i, (k, c, t) in enumerate(leaks + near)], "id string, c string, t string")
    clean = one.drop("event_id", "payload", "subject")
    landing = rows.join(F.broadcast(clean), F.lit(True)).select(
        F.col("id").alias("event_id"), F.when(F.col("c") == "payload", F.col("t")).otherwise("{}").alias("payload"), F.when(F.col("c") == "subject", F.col("t")).otherwise("{}").alias("subject"), *clean.columns
    )
    got = frame(query, {"landing": landing})
    if query == "contract_landing":
        got = got.where("check_name = 'failed_rows_no_raw_identifiers'")
    assert got.collect()[0][column] == len(leaks)


def test_times_are_judged_by_the_given_clock(spark, one):
    landing = one.withColumns({"occurred_at": F.lit(datetime.datetime(2024, 1, 9)), "received_at": F.lit(datetime.datetime(2024, 1, 9))})

    def bad(**instants):
        with at(**instants):
            return frame("landing_smoke_metrics", {"landing": landing}).collect()[0].bad_timestamps

    assert bad() == 1 and bad(evaluated_at="2024-01-09 00:00:00") == 0 and bad(evaluated_at="2024-01-08 23:54:00") == 1
    with pytest.raises(ValueError, match="instant"), at(now="2024-01-01 00:00:00"):
        pass


def test_trust_and_retention_follow_the_given_clock(spark):
    states = lambda when: {r.trust_status for r in catalog.build(spark, DIR, "trust_state", evaluated_at=when).select("trust_status").distinct().collect()}
    early, late = states("2024-01-04 12:00:00"), states("2024-03-01 00:00:00")
    assert "LATE_OPEN" in early or "TRUSTED" in early or "UNAVAILABLE" in early
    assert "COMPLETE_BUT_STALE" in late and "TRUSTED" not in late and "LATE_OPEN" not in late
    count = lambda when: catalog.build(spark, DIR, "privacy_retention_candidates", window_end=when).count()
    assert 0 == count("2024-01-01 00:00:00") < count("2024-01-05 00:00:00") < count("2024-01-20 00:00:00")
    assert "2024-01-20" in catalog.checking("privacy_retention_candidates", window_end="2024-01-20 00:00:00")


ROW = "event_name string, subject string, payload string"
SUBJECT = '{"user_hash": "sha256:u"}'
ADMIN = {
    "admin_surface_viewed": {"admin_surface": "members", "module_key": "m", "screen_key": "s", "result_state": "ok", "role_scope_key": "r"},
    "admin_action_visibility_viewed": {"admin_surface": "members", "action_key": "a", "target_hash": "sha256:t1"},
    "admin_reveal_audit_recorded": {"admin_surface": "members", "audit_receipt_hash": "sha256:a"},
    "admin_note_metadata_recorded": {"admin_surface": "members", "note_type": "short", "has_attachment": True},
}


def verdicts(spark, of, rows, dlq=0, **more):
    df = spark.createDataFrame([(n, s, p if isinstance(p, str) else json.dumps(p)) for n, s, p in rows], ROW)
    dead = spark.createDataFrame([(dlq,)], "dlq_count long")
    return {r.criterion: r.passed for r in of(df, dead, **more).collect()}


def failed(verdict):
    return {c for c, ok in verdict.items() if not ok}


GOOD_ADMIN = [(n, SUBJECT, p) for n, p in ADMIN.items()]
EVIDENCE_CASES = [
    ([], {}, set()),
    ([], {"dlq": 1}, {"dlq_zero"}),
    ([("admin_surface_viewed", SUBJECT, {"module_key": {"Body": 1}})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", '{"user_hash": "h", "more": [{"e-mail": 1}]}', {"module_key": "m"})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", '{"user_hash": "h", "more": [{"phone-number": 1}]}', {"module_key": "m"})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", SUBJECT, {"extra_key": "x"})], {}, {"no_forbidden_fields"}),
    ([("admin_note_metadata_recorded", SUBJECT, {"note_type": "see https://x"})], {}, {"no_forbidden_fields"}),
    ([("admin_action_visibility_viewed", SUBJECT, {"target_hash": "md5:1"})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", SUBJECT, {"module_key": "free text"})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", SUBJECT, {"module_key": "5551234567"})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", SUBJECT, {"module_key": ["a"]})], {}, {"no_forbidden_fields"}),
    ([("admin_surface_viewed", SUBJECT, {"module_key": "a\n"})], {}, set()),
    ([("admin_surface_viewed", SUBJECT, "[1]")], {}, {"no_forbidden_fields"}),
    ([("screen_viewed", SUBJECT, {})], {}, {"only_expected_event_names"}),
    ([], {"states": ev.STATES | {"contracts": "failed"}}, {"downstream_checks_passed"}),
    ([], {"states": ev.STATES | {"stop_rollback": ""}}, {"stop_rollback_recorded"}),
    ([], {"states": ev.STATES | {"admin_scenario": "skipped"}}, {"admin_scenario_artifact_passed"}),
    ([], {"states": ev.STATES | {"feedml": "failed"}}, {"feedml_collection_artifact_passed"}),
    ([], {"states": ev.STATES | {"clickhouse": "failed"}}, {"clickhouse_parity_artifact_passed"}),
]


@pytest.mark.parametrize(("more", "with_", "want"), EVIDENCE_CASES)
def test_each_criterion_of_the_evidence_fails_on_its_case(spark, more, with_, want):
    assert failed(verdicts(spark, ev.evidence_criteria, GOOD_ADMIN + more, **with_)) == want


@pytest.mark.parametrize(("name", "criterion"), zip(ADMIN, ("admin_surface_viewed_seen", "admin_action_visibility_seen", "admin_reveal_audit_seen", "admin_note_metadata_seen"), strict=True))
def test_each_required_event_must_be_seen(spark, name, criterion):
    rows = [r for r in GOOD_ADMIN if r[0] != name]
    assert failed(verdicts(spark, ev.evidence_criteria, rows)) == {criterion}


def test_lanes_choose_criteria(spark):
    common = {"dlq_zero", "no_forbidden_fields", "only_expected_event_names", "downstream_checks_passed", "stop_rollback_recorded"}
    lane = lambda *lanes: set(verdicts(spark, ev.evidence_criteria, GOOD_ADMIN, lanes=lanes)) - common
    assert lane("reveal") == {"admin_reveal_audit_seen", "admin_scenario_artifact_passed"} and lane("feedml", "clickhouse") == {"feedml_collection_artifact_passed", "clickhouse_parity_artifact_passed"}
    assert len(verdicts(spark, ev.evidence_criteria, GOOD_ADMIN)) == 12
    with pytest.raises(ValueError, match="lanes"):
        lane("unheard")


CANARY = [("app_session_started", SUBJECT, {}), ("feed_item_open", SUBJECT, {}), ("feed_item_like", SUBJECT, {})] + [("screen_viewed", SUBJECT, {})] * 2 + [("feed_item_impression", SUBJECT, {})] * 3 + [("feed_item_viewable_impression", SUBJECT, {})] * 2
CANARY_CASES = [
    ([], None, {}, set()),
    ([], "app_session_started", {}, {"at_least_one_app_session_started"}),
    ([], "screen_viewed", {}, {"at_least_two_screen_viewed"}),
    ([], "feed_item_viewable_impression", {}, {"at_least_five_feed_impressions"}),
    ([], "feed_item_open", {}, {"at_least_one_feed_item_open"}),
    ([], "feed_item_like", {}, {"at_least_one_safe_feed_interaction"}),
    ([], None, {"dlq": 3}, {"dlq_zero"}),
    ([("screen_viewed", SUBJECT, {"client": {"Exact-GPS": 1}})], None, {}, {"no_forbidden_fields"}),
    ([("screen_viewed", SUBJECT, {"client": {"exactgps": 1}})], None, {}, set()),  # only '-' counts as '_' here
    ([("admin_surface_viewed", SUBJECT, {})], None, {}, {"only_allowed_event_names"}),
    ([], None, {"flags": False}, {"seeded_privacy_flags_true"}),
    ([], None, {"states": ev.STATES | {"jobs": "failed"}}, {"downstream_checks_passed"}),
]


@pytest.mark.parametrize(("more", "without", "with_", "want"), CANARY_CASES)
def test_each_criterion_of_the_canary_fails_on_its_case(spark, more, without, with_, want):
    rows = [r for r in CANARY if r[0] != without]
    assert failed(verdicts(spark, ev.canary_criteria, rows + more, **with_)) == want


def test_an_empty_window_meets_no_count(spark):
    assert len(failed(verdicts(spark, ev.canary_criteria, []))) == 5 and len(failed(verdicts(spark, ev.evidence_criteria, []))) == 4
    assert set(INTERACTIONS) < set(CANARY_NAMES) and len(EVIDENCE_KEYS) == 4


def test_a_canary_needs_the_platform_of_its_client(spark, one):
    base = one.withColumns({"subject_user_hash": F.lit("sha256:u8"), "event_name": F.lit("screen_viewed"), "occurred_at": F.lit(datetime.datetime(2024, 1, 2))})
    texts = ['{"client": {"platform": "ios"}}', '{"platform": "ios"}', "{}", '{"client": {"platform": "android"}}', '{"client": "ios"}', '{"client": null}']
    rows = base.drop("payload").join(spark.createDataFrame([(t,) for t in texts], "payload string"), F.lit(True))
    assert [r.payload for r in frame("canary_rows", {"landing": rows}).collect()] == texts[:1]


def test_the_payload_hash_is_that_of_its_canonical_text(spark):
    payloads = [{"b": 1, "a": "Ünï 😀  ", "Z": {"y": [1, {"d": None, "c": True}], "x": "q\"\\\n"}, "é": 1.5}, {}, {"a": [], "B": {}}]
    base = {"event_id": "e", "event_name": "n", "event_version": 1, "occurred_at": "2024-01-01T06:00:00Z", "received_at": "2024-01-01T06:00:02Z", "producer": "p", "privacy_class": "pseudonymous", "consent_scope": ["analytics"], "subject": {"user_hash": "h"}}
    rows = [("t", 0, i, json.dumps(base | {"payload": p}, ensure_ascii=bool(i % 2)).encode()) for i, p in enumerate(payloads)]
    got = validated(spark.createDataFrame(rows, "source_topic string, source_partition int, source_offset long, value binary")).orderBy("source_offset").collect()
    for r, p in zip(got, payloads, strict=True):
        canonical = json.dumps(p, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r.payload == canonical and r.payload_sha256 == "sha256:" + hashlib.sha256(canonical.encode()).hexdigest()
