"""The privacy gate on named cases, and ingest run twice."""

import json

import pytest

from brightvault.plans import extra
from brightvault.streaming import ingest
from brightvault.streaming.validate import validated

GOOD = {
    "event_id": "e1", "event_name": "reaction_added", "event_version": 1, "occurred_at": "2024-01-01T06:00:00Z", "received_at": "2024-01-01T06:00:02+00:00", "producer": "p", "privacy_class": "pseudonymous",
    "consent_scope": ["analytics"], "subject": {"user_hash": "sha256:u"}, "payload": {"post_id": 3},
}
NOTE, REVEAL = "admin_note_metadata_recorded", "admin_reveal_audit_recorded"
CASES = [
    ({}, None),
    ({"event_name": NOTE, "payload": {"note_type": "short", "has_attachment": True, "target_hash": "sha256:abc"}}, None),
    ({"event_name": REVEAL, "payload": {"module_key": "m", "audit_receipt_hash": "sha256:r"}}, None),
    ({"event_name": NOTE, "payload": {"note_type": "see https://x"}}, "raw_expansion_metadata_value"),
    ({"event_name": NOTE, "payload": {"note_type": "a free form note"}}, "raw_expansion_metadata_value"),
    ({"event_name": NOTE, "payload": {"note_type": "5551234567"}}, "raw_expansion_metadata_value"),
    ({"event_name": NOTE, "payload": {"target_hash": "abc"}}, "invalid_expansion_metadata_hash"),
    ({"event_name": NOTE, "payload": {"other": "x"}}, "unsupported_expansion_metadata_field"),
    ({"event_name": NOTE, "payload": {"note_type": ["x"]}}, "invalid_expansion_metadata_value"),
    ({"payload": {"post_id": 7, "channel_id": 9}}, None),
    ({"payload": {"a": [{"raw_content": 1}]}}, "blocked_payload_identifier"),
    ({"payload": {"text": 'says "email": here'}}, None),
    ({"subject": {"user_hash": "h", "User-ID": 1}}, "blocked_subject_identifier"),
    ({"event_version": True}, "invalid_event_version"),
    ({"event_version": 1.5}, "invalid_event_version"),
    ({"occurred_at": "2024-01-01T06:00:00"}, "invalid_occurred_at"),
    ({"received_at": None}, "missing_received_at"),
    ({"consent_scope": []}, "missing_analytics_consent"),
    ({"consent_scope": [" Analytics "]}, None),
    ({"consent_scope": [1]}, "invalid_consent_scope"),
    ({"subject": {"user_hash": "h", "session_id": None}}, None),
    ({"subject": {"user_hash": " "}}, "missing_subject_hash"),
    ({"privacy_class": ""}, "missing_privacy_class"),
    ({"event_name": " "}, "missing_event_name"),
    ({"occurred_at": ""}, "missing_occurred_at"),
    ({"received_at": "soon"}, "invalid_received_at"),
    ({"producer": None}, "missing_producer"),
    ({"subject": {"session_id": "s"}}, "missing_subject_hash"),
    ({"event_id": None}, "missing_event_id"),
    ({"event_id": "\t\u3000\n"}, "missing_event_id"),
    ({"producer": "\r\n"}, "missing_producer"),
    ({"consent_scope": ["\tANALYTICS\n"]}, None),
    ({"subject": {"user_hash": "h", "\temail\n": 1}}, "blocked_subject_identifier"),
]


def raw(spark, values):
    return spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)], "source_topic string, source_partition int, source_offset long, value binary")


def test_named_cases(spark):
    rows = [json.dumps(GOOD | change).encode() for change, _ in CASES] + [None, b"", b"\xff", b"[1]", b"{"]
    got = {r.source_offset: r.error_code for r in validated(raw(spark, rows)).collect()}
    want = [c for _, c in CASES] + ["empty_value", "empty_value", "invalid_json", "invalid_json_object", "invalid_json"]
    assert [got[i] for i in range(len(rows))] == want


BIG = 1 << 20


@pytest.mark.parametrize(
    ("payload", "code"),
    [
        ({"text": "x" * BIG}, None),
        ({"text": '\\"' * (BIG // 2)}, None),
        ({"k" * 40_000: 1}, None),
        ({"k" * BIG: 1}, "invalid_json"),
        ({"text": "x" * BIG, "deep": [{"e_mail": 1}]}, "blocked_payload_identifier"),
        ({"text": '"email":' * (BIG // 8)}, None),
        ({"a": [[[{"b": {"Phone-Number": "\\" * BIG}}]]]}, "blocked_payload_identifier"),
    ],
)
def test_long_strings_pass_the_gate(spark, payload, code):
    """A megabyte of plain characters, quotes and backslashes, in values and in keys."""
    row = validated(raw(spark, [json.dumps(GOOD | {"payload": payload}).encode()])).select("error_code").collect()[0]
    assert row.error_code == code


def test_ids_of_older_batches_stay_out(spark, tmp_path):
    """Ids come back in later batches, one and several at a time."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema, landed = raw(spark, [b""]).schema, []
    for ids in (["a", "b", "c"], ["c", "d"], ["a"], [f"n{i}" for i in range(40)] + ["b", "d"]):
        raw(spark, [json.dumps(GOOD | {"event_id": i}).encode() for i in ids]).write.mode("append").parquet(src)
        ingest.run_stream(spark.readStream.schema(schema).parquet(src), out, ck).awaitTermination()
        landed = sorted(r.event_id for r in ingest.landing_of(spark, out).collect())
    assert landed == sorted(["a", "b", "c", "d", *(f"n{i}" for i in range(40))])


def test_no_folder_but_the_shared_one_on_a_cluster(spark):
    from types import SimpleNamespace

    from brightvault.sources.shared import shared_dir

    cluster = lambda path: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: path), sparkContext=SimpleNamespace(master="spark://host:7077"))
    assert shared_dir(cluster("hdfs:///work/")) == "hdfs:///work"
    with pytest.raises(ValueError):
        shared_dir(cluster(None))


def test_dead_letters_never_carry_the_body(spark):
    rows = [json.dumps(GOOD | {"event_id": "a@b", "payload": {"email": "secret"}}).encode()]
    dead = ingest.rejected(validated(raw(spark, rows))).collect()[0]
    assert dead.event_id is None and "secret" not in str(dead)


def test_stream_replays_land_once(spark, tmp_path):
    one = json.dumps(GOOD).encode()
    frame = raw(spark, [one, one, json.dumps(GOOD | {"event_id": "e2"}).encode(), b"x"])
    src = str(tmp_path / "in")
    frame.write.parquet(src)

    def run():
        ingest.run_stream(spark.readStream.schema(frame.schema).parquet(src), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        out = str(tmp_path / "out")
        return sorted(r.event_id for r in ingest.landing_of(spark, out).collect()), ingest.dead_of(spark, out).count()

    assert run() == (["e1", "e2"], 1)
    assert run() == (["e1", "e2"], 1)
    frame.write.mode("append").parquet(src)
    assert run() == (["e1", "e2"], 2)


@pytest.mark.parametrize("text", ["write to ann@x.example", "call +90 555 123 45 67", "Bearer abc.def", "eyJabcdefghij.abcdefghijk.abcdefghijk", "latitude: 41.02", "w " * 600])
def test_redaction(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(extra.redact_text(extra.F.col("t")).alias("t")).collect()[0].t
    assert len(got) <= 500 and not any(x in got for x in ("@", "555", "abc.def", "eyJ", "41.02"))


def test_dead_letters_of_the_evidence_window(spark):
    """All of the prefix count, and those that landed more than five minutes after the window don't."""
    import datetime

    from brightvault.plans import extra

    where = "/root/testdata/sf0.001"
    at = {(r.source_partition, r.source_offset): r.landed_at for r in extra.landing(spark, where).select(*extra.PLACE, "landed_at").collect()}
    dead = [r for r in ingest.rejected(extra.checked(spark, where)).collect() if (r.event_id or "").startswith("ev-")]
    start, end = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 5, 0, 5)
    want = [r for r in dead if start <= at[r.source_partition, r.source_offset] <= end]
    assert any(not r.event_id.startswith("ev-1") for r in want)
    assert extra.dlq_window(spark, where).collect()[0].dlq_count == len(want)
