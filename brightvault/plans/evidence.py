"""Evidence windows: what a bounded window of events shows, and whether it meets each criterion.

A window has an id prefix, a person, a closed span of time and either a list of names
(required events, by lanes) or a client platform (canary).  Its events, and the dead letters
of its prefix up to five minutes after it, are counted in one pass each; the criteria are
rows over these counts.  States of what lies outside the window (models, contracts, jobs,
artefacts of a lane) are inputs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightvault.operators.lifecycle import CANARY_NAMES, EVIDENCE_KEYS, FROM, INTERACTIONS, TO
from brightvault.streaming.validate import HASH_KEYS, all_keys, stripped

# Keys that no event of an evidence window may have at any depth, with '-' as '_' and with or without '_'.
FORBIDDEN_KEYS = (
    "actor_user_id applicant_message authorization auth_token bearer body comment_body contact_payload contact_value cookie dm_content email emailaddress exact_gps feedback_message free_form"
    " freeform full_url gps internal_note latitude longitude message note note_body phone phonenumber post_body private_note raw_content raw_note raw_note_text raw_policy_text raw_search_text"
    " raw_text raw_user_id reply_body request_body response_body reveal_payload reveal_value screenshot search_text signed_url support_contact support_payload target_user_id token transcript"
    " user_id userid view_hierarchy"
).split()
# The same for a canary window, with '-' as '_' only.
CANARY_FORBIDDEN = (
    "actor_user_id authorization auth_token bearer body contact_payload contact_value email exact_gps free_form freeform gps internal_note latitude longitude message note note_body phone"
    " private_note raw_content raw_note raw_note_text raw_search_text raw_text raw_user_id request_body response_body reveal_payload reveal_value screenshot search_text support_contact"
    " support_payload token user_id userid"
).split()
LANES = ("admin", "reveal", "note", "feedml", "clickhouse")
#: States that criteria take as they are.
STATES = {"models": "passed", "contracts": "passed", "jobs": "passed", "admin_scenario": "passed", "feedml": "passed", "clickhouse": "passed", "stop_rollback": "recorded"}


def key_hits(forbidden: Sequence[str], squashed: bool) -> Column:
    """How many keys of subject and payload, at any depth, are forbidden."""

    def hits(c: str) -> Column:
        plain = F.transform(all_keys(F.col(c)), lambda k: F.translate(F.lower(stripped(k)), "-", "_"))
        return F.size(F.filter(plain, lambda k: k.isin(*forbidden) | (F.translate(k, "_", "").isin(*forbidden) if squashed else F.lit(False))))

    return (F.greatest(hits("subject"), F.lit(0)) + F.greatest(hits("payload"), F.lit(0))).cast("long")


def unsupported_keys() -> Column:
    """How many keys of the payload the event's allow list doesn't have; events without a list may have none. No object counts as one."""
    keys = F.transform(F.json_object_keys("payload"), stripped)
    allowed = F.coalesce(*[F.when(F.col("event_name") == e, F.array(*map(F.lit, ks))) for e, ks in EVIDENCE_KEYS.items()], F.array().cast("array<string>"))
    return F.coalesce(F.size(F.filter(keys, lambda k: ~F.array_contains(allowed, k))), F.lit(1)).cast("long")


def unsafe_values() -> Column:
    """How many values of the payload are no bounded metadata: long texts, contact data, links, tokens, loose hashes, phone numbers, nested values."""
    entries = F.map_entries(F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>"))
    bounded = "[A-Za-z0-9_.-]{1,96}"

    def unsafe(e: Column) -> Column:
        key, v = stripped(e["key"]), e["value"]
        t = stripped(F.try_variant_get(v, "$", "string"))
        low = F.lower(t)
        odd = (F.length(t) > 256) | t.contains("@") | t.contains("://") | low.contains("bearer ") | low.contains("token=")
        loose = F.when(key.isin(*HASH_KEYS), ~t.rlike(rf"\Asha256:{bounded}\z")).otherwise(
            F.col("event_name").isin(*EVIDENCE_KEYS) & ~t.rlike(rf"\A{bounded}\z") | (F.length(F.regexp_replace(t, "[^0-9]", "")) >= 7)
        )
        return F.when(F.schema_of_variant(v) == "STRING", odd | loose).otherwise(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"))

    return F.coalesce(F.size(F.filter(entries, unsafe)), F.lit(1)).cast("long")


def dead_in_window(dead: DataFrame, landed: DataFrame, place: Sequence[str], prefix: str = "ev-") -> DataFrame:
    """The count of dead letters with the window's prefix that arrived in it or up to five minutes after it."""
    timed = landed.where(f"landed_at BETWEEN {FROM} AND {TO} + INTERVAL 5 MINUTES").select(*place)
    return dead.where(F.col("event_id").startswith(prefix)).join(timed, list(place), "left_semi").agg(F.count(F.lit(1)).alias("dlq_count"))


def counted(rows: DataFrame, dead: DataFrame, hits: Mapping[str, Column], names: Sequence[str]) -> DataFrame:
    """One row: events by name (``n_<name>``), events of other names, summed hits and ``dlq_count``."""
    each = rows.select("event_name", *[c.alias(n) for n, c in hits.items()])
    of_rows = each.agg(
        *[F.count_if(F.col("event_name") == n).alias(f"n_{n}") for n in names], F.count_if(~F.col("event_name").isin(*names)).alias("others"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in hits],
    )
    both = of_rows.unionByName(dead.select("dlq_count"), allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])


def listed(counts: DataFrame, rules: Mapping[str, Column | bool]) -> DataFrame:
    """A row per criterion."""
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("criterion"), (F.lit(c) if isinstance(c, bool) else c).alias("passed")) for n, c in rules.items()])).alias("c")).select("c.*")


def passed(states: Mapping[str, str], *which: str) -> bool:
    return all(states[w] == "passed" for w in which)


def evidence_criteria(rows: DataFrame, dead: DataFrame, lanes: Sequence[str] = LANES, states: Mapping[str, str] = STATES, names: Sequence[str] = tuple(EVIDENCE_KEYS)) -> DataFrame:
    """``rows`` (event_name, subject, payload) and the count ``dead`` to criterion, passed."""
    unknown = set(lanes) - set(LANES)
    if unknown or not lanes:
        raise ValueError(f"lanes must be some of {LANES}, not {tuple(lanes)}")
    counts = counted(rows, dead, {"forbidden": key_hits(FORBIDDEN_KEYS, True), "unsupported": unsupported_keys(), "unsafe": unsafe_values()}, names)
    seen = lambda name: F.col(f"n_{name}") >= 1
    rules: dict[str, Column | bool] = {
        "dlq_zero": F.col("dlq_count") == 0, "no_forbidden_fields": (F.col("forbidden") == 0) & (F.col("unsupported") == 0) & (F.col("unsafe") == 0), "only_expected_event_names": F.col("others") == 0,
        "downstream_checks_passed": passed(states, "models", "contracts", "jobs"), "stop_rollback_recorded": bool(states["stop_rollback"]),
    }
    if "admin" in lanes:
        rules |= {"admin_surface_viewed_seen": seen("admin_surface_viewed"), "admin_action_visibility_seen": seen("admin_action_visibility_viewed")}
    if "reveal" in lanes:
        rules["admin_reveal_audit_seen"] = seen("admin_reveal_audit_recorded")
    if "note" in lanes:
        rules["admin_note_metadata_seen"] = seen("admin_note_metadata_recorded")
    if set(lanes) & {"admin", "reveal", "note"}:
        rules["admin_scenario_artifact_passed"] = passed(states, "admin_scenario")
    if "feedml" in lanes:
        rules["feedml_collection_artifact_passed"] = passed(states, "feedml")
    if "clickhouse" in lanes:
        rules["clickhouse_parity_artifact_passed"] = passed(states, "clickhouse")
    return listed(counts, rules)


def canary_criteria(rows: DataFrame, dead: DataFrame, states: Mapping[str, str] = STATES, flags: bool = True) -> DataFrame:
    """``rows`` of a canary window and the count ``dead`` to criterion, passed. flags: the person's privacy flags were set before."""
    counts = counted(rows, dead, {"forbidden": key_hits(CANARY_FORBIDDEN, False)}, CANARY_NAMES)
    n = lambda *names: sum((F.col(f"n_{x}") for x in names), F.lit(0))
    return listed(
        counts,
        {
            "seeded_privacy_flags_true": flags, "at_least_one_app_session_started": n("app_session_started") >= 1, "at_least_two_screen_viewed": n("screen_viewed") >= 2,
            "at_least_five_feed_impressions": n("feed_item_impression", "feed_item_viewable_impression") >= 5, "at_least_one_feed_item_open": n("feed_item_open") >= 1,
            "at_least_one_safe_feed_interaction": n(*INTERACTIONS) >= 1, "dlq_zero": F.col("dlq_count") == 0, "no_forbidden_fields": F.col("forbidden") == 0,
            "only_allowed_event_names": F.col("others") == 0, "downstream_checks_passed": passed(states, "models", "contracts", "jobs"),
        },
    )


# The same in SQL, by hand: keys and values are read member by member.
SPAN = "BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-05 00:00:00'"
ROWS = f"rows AS (SELECT event_id, event_name, subject, payload FROM landing WHERE starts_with(event_id, 'ev-') AND subject_user_hash = 'sha256:u7' AND occurred_at {SPAN} AND event_name LIKE 'admin_%')"
CANARY = f"canary AS (SELECT event_id, event_name, subject, payload FROM landing WHERE starts_with(event_id, 'ev-') AND subject_user_hash = 'sha256:u8' AND occurred_at {SPAN} AND (payload->'client'->>'platform') = 'ios')"


def listing(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def hits_sql(of: str, forbidden: Sequence[str]) -> str:
    """Keys of two levels, which is all that the landed events have."""
    plain = "replace(lower(trim(k)), '-', '_')"
    return (
        f"SELECT event_id, count(k) FILTER ({plain} IN ({listing(forbidden)}) OR replace({plain}, '_', '') IN ({listing(forbidden)})) AS forbidden_keys FROM (SELECT event_id, unnest(list_concat(json_keys(subject),"
        f" list_concat(json_keys(payload), coalesce(json_keys(payload, '$.client'), [])))) AS k FROM {of}) GROUP BY event_id"
    )


UNSUPPORTED = (
    "SELECT event_id, len(list_filter(json_keys(payload), lambda k: NOT list_contains(CASE event_name "
    + " ".join(f"WHEN '{e}' THEN [{listing(ks)}]" for e, ks in EVIDENCE_KEYS.items())
    + " END, k)))::BIGINT AS unsupported_keys FROM rows"
)
UNSAFE = (
    "SELECT event_id, count(*) FILTER (kind IN ('OBJECT', 'ARRAY') OR kind = 'VARCHAR' AND (length(t) > 256 OR t LIKE '%@%' OR t LIKE '%://%' OR lower(t) LIKE '%bearer %' OR lower(t) LIKE '%token=%'"
    f" OR CASE WHEN k IN ({listing(HASH_KEYS)}) THEN NOT regexp_full_match(t, 'sha256:[A-Za-z0-9_.-]{{1,96}}') ELSE NOT regexp_full_match(t, '[A-Za-z0-9_.-]{{1,96}}') OR length(regexp_replace(t, '[^0-9]', '', 'g')) >= 7 END)) AS unsafe_values"
    " FROM (SELECT *, json_type(payload, '$.' || k) AS kind, trim(json_extract_string(payload, '$.' || k)) AS t FROM (SELECT event_id, payload, unnest(json_keys(payload)) AS k FROM rows)) GROUP BY event_id"
)


def statements(landing: str, dead: str) -> dict[str, str]:
    """``landing``: its statement. ``dead``: a condition under which an event of it is refused, and the id it shows then, as (condition, id)."""
    refused, shown = dead
    base = f"WITH landing AS ({landing}), {ROWS}, {CANARY}"
    dlq = f"SELECT count(*) AS dlq_count FROM (SELECT {shown} AS e, landed_at FROM landing WHERE {refused}) WHERE starts_with(e, 'ev-') AND landed_at BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-05 00:05:00'"
    n = lambda table, *names: f"(SELECT count(*) FROM {table} WHERE event_name IN ({listing(names)}))"
    rule = lambda **rules: " UNION ALL ".join(f"SELECT '{k}' AS criterion, {v} AS passed" for k, v in rules.items())
    return {
        "evidence_rows": f"{base} SELECT event_id, event_name, (SELECT any_value(occurred_at) FROM landing l WHERE l.event_id = rows.event_id) AS occurred_at, subject, payload FROM rows",
        "canary_rows": f"{base} SELECT event_id, event_name, (SELECT any_value(occurred_at) FROM landing l WHERE l.event_id = canary.event_id) AS occurred_at, subject, payload FROM canary",
        "evidence_event_counts": f"{base} SELECT event_name, count(*) AS n, event_name IN ({listing(CANARY_NAMES)}) AS in_scope FROM canary GROUP BY event_name",
        "evidence_forbidden_keys": f"{base} {hits_sql('rows', FORBIDDEN_KEYS)}",
        "evidence_unsupported_keys": f"{base} {UNSUPPORTED}",
        "evidence_unsafe_values": f"{base} {UNSAFE}",
        "evidence_dlq_count": f"{base} {dlq}",
        "evidence_criteria": f"{base}, f AS ({hits_sql('rows', FORBIDDEN_KEYS)}), s AS ({UNSUPPORTED}), v AS ({UNSAFE}), d AS ({dlq}) "
        + rule(
            dlq_zero="(SELECT dlq_count FROM d) = 0", no_forbidden_fields="(SELECT coalesce(sum(forbidden_keys), 0) FROM f) + (SELECT coalesce(sum(unsupported_keys), 0) FROM s) + (SELECT coalesce(sum(unsafe_values), 0) FROM v) = 0",
            only_expected_event_names=f"(SELECT count(*) FROM rows) = {n('rows', *EVIDENCE_KEYS)}", downstream_checks_passed="true", stop_rollback_recorded="true",
            admin_surface_viewed_seen=n("rows", "admin_surface_viewed") + " >= 1", admin_action_visibility_seen=n("rows", "admin_action_visibility_viewed") + " >= 1",
            admin_reveal_audit_seen=n("rows", "admin_reveal_audit_recorded") + " >= 1", admin_note_metadata_seen=n("rows", "admin_note_metadata_recorded") + " >= 1",
            admin_scenario_artifact_passed="true", feedml_collection_artifact_passed="true", clickhouse_parity_artifact_passed="true",
        ),
        "canary_criteria": f"{base}, f AS ({hits_sql('canary', CANARY_FORBIDDEN)}), d AS ({dlq}) "
        + rule(
            seeded_privacy_flags_true="true", at_least_one_app_session_started=n("canary", "app_session_started") + " >= 1", at_least_two_screen_viewed=n("canary", "screen_viewed") + " >= 2",
            at_least_five_feed_impressions=n("canary", "feed_item_impression", "feed_item_viewable_impression") + " >= 5", at_least_one_feed_item_open=n("canary", "feed_item_open") + " >= 1",
            at_least_one_safe_feed_interaction=n("canary", *INTERACTIONS) + " >= 1", dlq_zero="(SELECT dlq_count FROM d) = 0", no_forbidden_fields="(SELECT coalesce(sum(forbidden_keys), 0) FROM f) = 0",
            only_allowed_event_names=f"(SELECT count(*) FROM canary) = {n('canary', *CANARY_NAMES)}", downstream_checks_passed="true",
        ),
    }
