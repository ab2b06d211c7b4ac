"""Guards of the invariants: each check again, on the same tables with known faults put in.

A check that finds nothing in good tables may be blind.  Here one of its tables gets
rows that break each of its rules, and the check must report them.
"""

from __future__ import annotations

from dataclasses import replace

from brightvault.operators import contracts, invariants, lifecycle  # noqa: F401  (their models come first)
from brightvault.plans.constants import CONSTANTS
from brightvault.plans.model import MODELS, Model, add, ordered, same
from brightvault.sources.adapter import STEPS


def columns_of(name: str) -> dict[str, str]:
    if name == "landing":
        return {c: c for c in STEPS[-1]}
    m = MODELS[name]
    while not (m.after or m.group or m.columns or m.parts):
        m = MODELS[m.source]
    return {c: c for c in (m.after or {**m.group, **m.columns} or m.parts[0])}


def guard(check: str, called: str | None = None, **faults: Model | tuple) -> None:
    """``check`` over faulty tables, called ``check``_guard. faults: table = (rows of it that stay,
    (rows to add, column and its value, ...), ...), or the faulty table's model."""
    put = {}
    for table, fault in faults.items():
        put[table] = f"faulty_{check}_{table}"
        if isinstance(fault, Model):
            add(put[table], fault)
            continue
        stays, *more = fault
        cols = columns_of(table)
        add(put[table], Model((table,) * (1 + len(more)), wheres=(stays, *(w for w, *_ in more)), parts=(cols, *(cols | dict(zip(c[::2], c[1::2], strict=True)) for _, *c in more))))
    for name in ordered(check, {"landing": "", **dict.fromkeys(CONSTANTS, "")}):
        sources = MODELS[name].sources() if name in MODELS else ()
        if name not in faults and any(s in put for s in sources):
            m = MODELS[name]
            put[name] = (called or f"{check}_guard") if name == check else f"guarded_{check}_{name}"
            source = tuple(put.get(s, s) for s in m.source) if isinstance(m.source, tuple) else put.get(m.source, m.source)
            add(put[name], replace(m, source=source, join=(put.get(m.join[0], m.join[0]), *m.join[1:]) if m.join else None))


guard("inv_reconciliation", "inv_reconciliation_negative", stage_reconciliation=(None, ("source_model = 'stg_reactions'", "unexplained_delta", "unexplained_delta + 1"), ("source_model = 'stg_feed_events'", "reconciliation_status", "'unexplained_delta'")))
guard(
    "inv_hub",
    hub_rows=(None, ("model_name = 'h_event'", "business_key", "' '"), ("model_name = 'h_channel'", "business_key", "concat(business_key, 'x')"), ("model_name = 'h_together_item'", "hash_key", "concat(hash_key, 'x')")),
)
guard("inv_satellite", sat_rows=(None, ("model_name = 'sat_content_event' AND parent_hk < '2'", "hashdiff", "concat(hashdiff, 'x')"), ("model_name = 'sat_channel_session' AND parent_hk < '2'",), ("model_name = 'sat_reaction_event' AND parent_hk < '2'", "received_at", "CAST(NULL AS TIMESTAMP)")))
guard(
    "inv_bdv_formula",
    s_emoji_usage_daily=(None, ("emoji_key = 'heart'", "emoji_usage_count", "emoji_usage_count + 1")),
    s_reaction_valence_daily=(None, ("reaction_valence = 'positive'", "added_reaction_count", "-1 - added_reaction_count")),
    s_occupation_cohort_daily=(None, ("distinct_user_count > 0", "occupation_cohort_share", "1.5")),
    s_together_coordination_daily=(None, ("together_item_count > 0", "together_coordination_success_proxy_score", "together_coordination_success_proxy_score - 1")),
)
guard("inv_mart_duplicate_keys", mart_rows=(None, ("model_name = 'mart_occupation_cohort_daily'",), ("model_name = 'mart_emoji_reaction_daily' AND grain_key LIKE 'like%'",)))
guard("inv_mart_contract_ids", mart_contract_coverage=("metric_contract_id <> 'emoji_usage_count_daily'", ("metric_contract_id LIKE 'together%'", "coverage_status", "'open'")))
guard("inv_voice_gate", stg_voice_sessions=(None, ("platform = 'ios' AND source_offset % 2 = 0", "production_write_enabled", "true"), ("source_offset % 2 = 1", "record_source_mode", "'live'")))
guard(
    "privacy_invariants",
    privacy_published_aggregates=Model("privacy_anonymization_checks", same("candidate_id source_record_ref anonymous_group cell_count evidence_id"), where="cell_count % 7 = 3"),
    privacy_decision_counts=("action NOT LIKE 'cleanup%'",),
)
guard("inv_trust", trust_judged=Model(("trust_state", "wrong_trust_fixtures"), parts=(invariants.JUDGED_PART, invariants.JUDGED_PART)))
# What a leaking client would land: keys of either list, an address, impossible times, repeated ids.
LEAKS = (
    None,
    ("source_offset % 50 = 1", "payload", "'{\"a\": {\"body\": \"x\"}}'"), ("source_offset % 50 = 2", "payload", "'{\"STAFF_ID\": 3}'"), ("source_offset % 50 = 3", "subject", "'{\"user_hash\": \"h\", \"gps\": [1]}'"),
    ("source_offset % 50 = 4", "payload", "'{\"voiceprint\": 1}'"), ("source_offset % 50 = 5", "subject_user_hash", "'a@b'"), ("source_offset % 50 = 6", "payload", "'{\"bodyguard\": \"safe\"}'"),
    ("source_offset % 50 = 7", "received_at", "TIMESTAMP '2024-01-09 00:00:00'"), ("source_offset % 50 = 8", "occurred_at", "TIMESTAMP '2019-12-31 00:00:00'"), ("source_offset % 50 = 9", "privacy_class", "'identified'"),
    ("source_offset % 50 = 10", "event_id", "CAST(NULL AS VARCHAR(9))"),
)
guard("contract_landing", landing=LEAKS)
guard("landing_smoke_metrics", landing=LEAKS)
guard(
    "inv_link",
    link_participants=(
        None, ("model_name = 'l_event_participant' AND participant_role = 'event_hk' AND link_hk < '2'", "participant_hk", "CAST(NULL AS VARCHAR(9))"),
        ("model_name = 'l_user_channel_session' AND first AND link_hk < '2'", "record_source", "' '"), ("model_name = 'link_reaction_content' AND first AND link_hk < '2'", "signature", "concat(signature, 'x')"),
    ),
    h_channel=("channel_hk < '8'",),
)
guard(
    "inv_pit_content",
    pit_content_daily=(
        None, ("content_hk < '4'",), ("content_hk < '8'", "restatement_state", "CAST(NULL AS VARCHAR(9))"), ("content_hk >= '8'", "as_of_datetime", "TIMESTAMP '2024-01-01 00:00:00'"),
        ("content_hk < '8'", "late_arriving_event_count", "late_arriving_event_count + 1"), ("content_hk >= '4'", "deleted_or_opted_out_subject_count", "{{long|2}}"),
    ),
)
guard(
    "inv_mart_metadata",
    mart_rows=(
        None, ("model_name = 'mart_emoji_reaction_daily'", "reporting_timezone", "'UTC'"), ("model_name = 'mart_reaction_valence_daily'", "wording_status", "'guess'"),
        ("model_name = 'mart_together_coordination_daily'", "source_completeness_label", "'whole'"), ("model_name = 'mart_occupation_cohort_daily'", "metric_contract_ids", "''"),
    ),
)
