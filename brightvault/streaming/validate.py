"""The privacy gate: raw bytes to a verdict and typed fields, in Column expressions only.

The first rule that a record breaks gives its ``error_code``.  JSON is parsed
once, into a variant; keys at any depth come from one left-to-right pass over
the strings of the canonical text.

Where this differs from a lenient JSON reader: objects with a repeated key, or a
key of more than 50,000 characters, are ``invalid_json``, and a boolean event_version is ``invalid_event_version``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key names, without case, '_', '-' and blanks, that may not occur at any depth.
BLOCKED = (
    "accesstoken actoruserid apikey applicantmessage authtoken authorization body commentbody contactpayload contactvalue cookie dmcontent email emailaddress exactgps"
    " feedbackmessage freeform fullurl gps internalnote lat latitude lon longitude message note notebody password payloadvalue phone phonenumber postbody privatenote"
    " rawcontent rawnote rawnotetext rawpolicytext rawsearchtext rawtext rawuserid refreshtoken replybody requestbody responsebody revealpayload revealvalue screenshot"
    " searchtext sessiontoken signedurl staffid supportcontact supportpayload targetuserid token transcript userid viewhierarchy"
).split()
# Payload keys of the two administrative events.
ADMIN_KEYS = {
    "admin_reveal_audit_recorded": (
        "admin_surface module_key screen_key reveal_field_class reveal_result actor_role_scope_key reason_length_bucket reason_category confirmation_state"
        " authorization_outcome audit_action_key audit_receipt_hash target_type target_hash"
    ).split(),
    "admin_note_metadata_recorded": (
        "admin_surface module_key screen_key note_surface note_type note_action note_length_bucket sensitivity_class redaction_class has_attachment language_bucket"
        " lifecycle_state lifecycle_bucket target_type target_hash"
    ).split(),
}
HASH_KEYS = ("target_hash", "audit_receipt_hash")
TOKEN = r"[\p{L}\p{N}_.-]{1,96}"
# Possessive throughout: the engine neither recurses into a long string nor tries it again.
STRINGS = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"(\s*+:)?'


#: What counts as a blank at the ends of a value.
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column | str) -> Column:
    """Without blanks at the ends."""
    return F.btrim(c, F.lit(SPACES))


#: A blank as JSON writes it within a string.
ESCAPED_BLANK = r"\\(?:[tnrf]|u00(?:0[bB]|1[c-fC-F]))"


def all_keys(text: Column) -> Column:
    """Key names of a JSON text, at any depth, as they are written."""
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(STRINGS), F.lit(1)).alias("k"), F.regexp_extract_all(text, F.lit(STRINGS), F.lit(2)).alias("c"))
    return F.transform(F.filter(found, lambda x: F.length(F.trim(x["c"])) > 0), lambda x: F.regexp_replace(x["k"], ESCAPED_BLANK, " "))


def keys_at_any_depth(text: Column) -> Column:
    """Normalised key names of a JSON text."""
    return F.transform(all_keys(text), lambda k: F.translate(F.lower(stripped(k)), "_- ", ""))


def blocked(text: Column) -> Column:
    return F.arrays_overlap(keys_at_any_depth(text), F.array(*map(F.lit, BLOCKED)))


def metadata_code(key: Column, value: Column) -> Column:
    """What is wrong with a value of administrative metadata, or null."""
    kind = F.schema_of_variant(value)
    text = stripped(F.try_variant_get(value, "$", "string"))
    low = F.lower(text)
    of_text = (
        F.when(F.length(text) > 256, "invalid_expansion_metadata_value")
        .when(text.contains("@") | text.contains("://") | low.contains("bearer ") | low.contains("token="), "raw_expansion_metadata_value")
        .when(stripped(key).isin(*HASH_KEYS), F.when((text != "") & ~text.rlike(f"^sha256:{TOKEN}$"), "invalid_expansion_metadata_hash"))
        .when(~text.rlike(f"^{TOKEN}$") | (F.length(F.regexp_replace(text, r"[^\p{Nd}]", "")) >= 7), "raw_expansion_metadata_value")
    )
    return F.when(kind == "STRING", of_text).when(kind.rlike("^(OBJECT|ARRAY)"), "invalid_expansion_metadata_value")


def validated(raw: DataFrame) -> DataFrame:
    """``source_topic, source_partition, source_offset, value`` with the verdict, typed fields and hashes."""
    text = F.col("value").cast("string")
    df = raw.withColumn("v", F.when(F.is_valid_utf8(text), F.try_parse_json(text)))
    get = lambda p: F.try_variant_get("v", f"$.{p}", "variant")
    kind = lambda p: F.schema_of_variant(get(p))
    word = lambda p: F.when(kind(p) == "STRING", F.try_variant_get("v", f"$.{p}", "string"))
    strings = ("event_id", "event_name", "occurred_at", "received_at", "producer", "privacy_class")
    df = df.withColumns(
        {f"t_{c}": word(c) for c in strings}
        | {"k_version": kind("event_version"), "k_consent": kind("consent_scope"), "k_subject": kind("subject"), "k_payload": kind("payload"), "k_session": kind("subject.session_id")}
        | {
            "event_version": F.try_variant_get("v", "$.event_version", "bigint"), "scopes": F.try_variant_get("v", "$.consent_scope", "array<variant>"),
            "user_hash": word("subject.user_hash"), "session_id": word("subject.session_id"), "subject_json": F.to_json(get("subject")), "payload_json": F.to_json(get("payload")),
            "members": F.try_variant_get("v", "$.payload", "map<string,variant>"),
        }
    )
    blank = lambda c: F.coalesce(stripped(F.col(c)), F.lit("")) == ""
    zoned = lambda c: F.col(c).rlike(r"(Z|[+-]\d\d:?\d\d)$") & F.try_to_timestamp(F.col(c)).isNotNull()
    is_a = lambda c, k: F.coalesce(F.col(c).startswith(k), F.lit(False))
    all_text = F.forall("scopes", lambda x: F.schema_of_variant(x) == "STRING")
    analytics = F.exists("scopes", lambda x: F.lower(stripped(F.try_variant_get(x, "$", "string"))) == "analytics")
    rules = [
        (F.coalesce(F.octet_length("value"), F.lit(0)) == 0, "empty_value"),
        (F.col("v").isNull(), "invalid_json"),
        (~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), "invalid_json_object"),
        (blank("t_event_id"), "missing_event_id"),
        (blank("t_event_name"), "missing_event_name"),
        (~is_a("k_version", "BIGINT") | (F.col("event_version") <= 0), "invalid_event_version"),
    ]
    for c in ("occurred_at", "received_at"):
        rules += [(blank(f"t_{c}"), f"missing_{c}"), (~F.coalesce(zoned(f"t_{c}"), F.lit(False)), f"invalid_{c}")]
    rules += [
        (blank("t_producer"), "missing_producer"),
        (blank("t_privacy_class"), "missing_privacy_class"),
        (F.col("t_privacy_class") != "pseudonymous", "invalid_privacy_class"),
        (~is_a("k_consent", "ARRAY") | ~F.coalesce(all_text, F.lit(False)), "invalid_consent_scope"),
        (~F.coalesce(analytics, F.lit(False)), "missing_analytics_consent"),
        (~is_a("k_subject", "OBJECT"), "invalid_subject"),
        (blank("user_hash"), "missing_subject_hash"),
        (F.col("user_hash").contains("@"), "raw_subject_hash"),
        (F.col("k_session").isNotNull() & ~F.col("k_session").isin("STRING", "VOID"), "invalid_session_id"),
        (blocked(F.col("subject_json")), "blocked_subject_identifier"),
        (~is_a("k_payload", "OBJECT"), "invalid_payload"),
        (blocked(F.col("payload_json")), "blocked_payload_identifier"),
    ]
    for event, allowed in ADMIN_KEYS.items():
        keys = F.transform(F.json_object_keys("payload_json"), stripped)
        extra = F.size(F.array_except(keys, F.array(*map(F.lit, allowed)))) > 0
        rules.append(((F.col("t_event_name") == event) & extra, "unsupported_expansion_metadata_field"))
    # An array of verdicts, not a chain of cases: the optimizer takes long chains apart again and again.
    verdicts = F.array(*[F.when(bad, code) for bad, code in rules])
    wrong = F.when(F.col("t_event_name").isin(*ADMIN_KEYS), F.transform(F.map_entries("members"), lambda e: metadata_code(e["key"], e["value"])))
    verdicts = F.array_compact(F.concat(verdicts, F.coalesce(wrong, F.array().cast("array<string>"))))
    df = df.withColumn("error_code", F.get(verdicts, F.lit(0)))
    safe = lambda c: F.when(~blank(c) & ~F.col(c).contains("@") & (F.length(stripped(c)) <= 200), stripped(c))
    sha = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    when = lambda c: F.try_to_timestamp(F.col(f"t_{c}"))
    good = F.col("error_code").isNull()
    consent = F.array_join(F.transform("scopes", lambda x: F.concat(F.lit('"'), F.try_variant_get(x, "$", "string"), F.lit('"'))), ", ")
    return df.select(
        "source_topic", "source_partition", "source_offset", "error_code", safe("t_event_id").alias("safe_event_id"), safe("t_event_name").alias("safe_event_name"),
        F.col("t_event_id").alias("event_id"), F.col("t_event_name").alias("event_name"), F.col("event_version").cast("int").alias("event_version"),
        F.when(good, when("occurred_at")).alias("occurred_at"), F.when(good, when("received_at")).alias("received_at"), F.col("t_producer").alias("producer"), F.col("t_privacy_class").alias("privacy_class"),
        F.when(good, F.concat(F.lit("["), consent, F.lit("]"))).alias("consent_scope"), F.col("subject_json").alias("subject"), F.col("user_hash").alias("subject_user_hash"), F.col("session_id").alias("subject_session_id"),
        F.col("payload_json").alias("payload"), sha(F.coalesce("value", F.lit(b""))).alias("raw_record_sha256"), F.coalesce(F.octet_length("value"), F.lit(0)).alias("raw_record_bytes"),
        F.when(good, sha(F.col("payload_json").cast("binary"))).alias("payload_sha256"),
    )
