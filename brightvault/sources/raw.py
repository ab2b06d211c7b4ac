"""Raw envelopes, as a topic would deliver them, with faults injected by offset.

Each landed event is written as its JSON envelope.  The remainder of the offset
by 41 picks a fault (0, 23 and those above 30: none), so the right verdict is known
without running the validator.
"""

from __future__ import annotations

from brightvault.plans.model import Model, add, same

F = "(source_offset % 41)"


def put(default: str, **faults: str) -> str:
    return "CASE " + F + " " + " ".join(f"WHEN {k[1:]} THEN {v}" for k, v in faults.items()) + f" ELSE {default} END"


ADMIN = "'admin_note_metadata_recorded'"
NAME = f"CASE WHEN {F} BETWEEN 19 AND 22 THEN {ADMIN} WHEN {F} = 25 THEN ' ' ELSE event_name END"
EVENT_ID = put("event_id", f4="' '", f23="concat('ev-', {{txt|source_offset - 23}})")
ENVELOPE = (
    ("event_id", f"concat('\"', {EVENT_ID}, '\"')"),
    ("event_name", f"concat('\"', {NAME}, '\"')"),
    ("event_version", put("'1'", f5="'0'", f6="'\"1\"'")),
    ("occurred_at", "concat('\"', " + put("{{iso|occurred_at}}", f7="'2024-01-01T06:00:00'", f8="'yesterday'", f26="''") + ", '\"')"),
    ("received_at", "concat('\"', " + put("{{iso|received_at}}", f27="' '", f28="'soon'") + ", '\"')"),
    ("producer", put("'\"fixture\"'", f9="'\"\"'")),
    ("privacy_class", put("'\"pseudonymous\"'", f10="'\"identified\"'", f29="'\"\"'")),
    ("consent_scope", put("consent_scope", f11="'\"analytics\"'", f12="'[\"marketing\"]'")),
    ("subject", put("subject", f13="'[]'", f14="'{\"user_hash\":\"a@b\"}'", f15="'{\"user_hash\":\"sha256:u\",\"session_id\":7}'", f16="'{\"user_hash\":\"sha256:u\",\"more\":[{\"User-ID\":1}]}'", f30="'{\"session_id\":\"s\"}'")),
    ("payload", put("payload", f17="'[1]'", f18="'{\"a\":{\"b\":[{\"raw_content\":\"x\"}]}}'", f19="'{\"note_type\":\"x\",\"extra\":1}'", f20="'{\"note_type\":\"https://x.y\"}'", f21="'{\"target_hash\":\"md5:1\"}'", f22="'{\"note_type\":{\"a\":1}}'")),
)
TEXT = "concat('{', " + ", ', ', ".join(f"'\"{k}\": ', {v}" for k, v in ENVELOPE) + ", '}')"
add("raw_texts", Model("landing", {**same("source_topic source_partition source_offset"), "text": TEXT}))
add(
    "raw_events",
    Model("raw_texts", {**same("source_topic source_partition source_offset"), "value": "{{bytes|%s;;%s = 24}}" % (put("text", f1="''", f2="substr(text, 1, 40)", f3="'[1]'"), F)}),
)

# The verdict that each fault deserves.
CODES = {
    1: "empty_value", 2: "invalid_json", 3: "invalid_json_object", 4: "missing_event_id", 5: "invalid_event_version", 6: "invalid_event_version", 7: "invalid_occurred_at", 8: "invalid_occurred_at",
    9: "missing_producer", 10: "invalid_privacy_class", 11: "invalid_consent_scope", 12: "missing_analytics_consent", 13: "invalid_subject", 14: "raw_subject_hash", 15: "invalid_session_id",
    16: "blocked_subject_identifier", 17: "invalid_payload", 18: "blocked_payload_identifier", 19: "unsupported_expansion_metadata_field", 20: "raw_expansion_metadata_value",
    21: "invalid_expansion_metadata_hash", 22: "invalid_expansion_metadata_value", 24: "invalid_json",
    25: "missing_event_name", 26: "missing_occurred_at", 27: "missing_received_at", 28: "invalid_received_at", 29: "missing_privacy_class", 30: "missing_subject_hash",
}
CODE = "CASE " + F + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CODES.items()) + " END"
