"""All queries of the warehouse by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from brightvault.functions.dialect import at
from brightvault.operators import business, contracts, guards, invariants, lifecycle, stage, trust, vault  # noqa: F401  (each registers its models)
from brightvault.plans import extra
from brightvault.plans.by_hand import by_hand
from brightvault.plans.constants import LAYERS, CONSTANTS, constant, constant_sql
from brightvault.plans.model import MODELS, checking_sql, frame, ordered
from brightvault.plans.tables import prepared
from brightvault.sources.adapter import events, landing_sql, stored

#: Models that only serve others.
INNER = {
    "raw_texts", "raw_events", "privacy_judged", "privacy_records", "published_failures", "failed_checks", "missing_audits", "privacy_ref_events", "hourly_counts", "hourly_partials", "hot_events", "contract_uses", "contract_usage", "registered", "asset_days", "parsed", "actor_cohorts", "actor_turns", "cohort_users", "cohort_totals", "offered", "trust_judged", "trust_contracted", "hub_rows", "link_participants", "sat_rows", "mart_rows", "missing_contracts",
    "inv_unbalanced", "inv_contradiction", "pit_grain", "pit_matched", "pit_recomputed", "contract_results", "contract_executed", "privacy_lifecycle_audit", "personal_recap_monthly",
}
INNER_LIKE = ("faulty_", "guarded_", "orphans_", "lost_", "inv_hub_", "inv_link_", "inv_sat_")
#: What a query's plan would compute again and again, and is written once instead (after the stages that it needs).
DAILY = LAYERS["business_vault"]
SHARED: dict[str, tuple[tuple[str, ...], ...]] = {
    "trust_": (DAILY, ("trust_partition_obs",)),
    "inv_trust": (DAILY, ("trust_partition_obs",)),
    "trust_source_obs": (DAILY,),
    "trust_target_obs": (DAILY,),
    "trust_partition_obs": (DAILY,),
    "inv_hub": (("hub_rows",),),
    "inv_satellite": (("sat_rows",),),
    "inv_pit_content": (("sat_content_event",), ("pit_content_daily",)),
    "contract_inventory_gate": (("contract_results",),),
    "quality_run_result": (("contract_results",),),
}
#: Tables that are kept for the application.
KEPT = frozenset(n for n in MODELS if n.startswith("stg_") or n in DAILY)


def given(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"landing": stored(spark, sf_dir)} | {n: constant(spark, n) for n in CONSTANTS}


def base() -> dict[str, str]:
    return {"landing": landing_sql()} | {n: constant_sql(n) for n in CONSTANTS}


def published() -> list[str]:
    return [n for n in MODELS if n not in INNER and not (n.endswith("_counts") and n.startswith("contract_")) and (n.endswith("_guard") and not n.startswith(("faulty_", "guarded_")) or not n.startswith(INNER_LIKE))]


def build(spark: SparkSession, sf_dir: str, name: str, **instants: str) -> DataFrame:
    """A model over the test events. instants: ``evaluated_at`` and ``window_end``, in UTC."""
    with at(**instants):
        return built(spark, sf_dir, name)


def checking(name: str, **instants: str) -> str:
    """The statement that gives the rows of ``build`` in the checking engine."""
    with at(**instants):
        return checking_sql(name, base())


def built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = given(spark, sf_dir)
    origin = name.removesuffix("_guard").removesuffix("_negative")
    shared = SHARED.get(origin) or next((s for k, s in SHARED.items() if k.endswith("_") and origin.startswith(k)), ())
    stages = tuple(n for n in ordered(name, tables) if n.startswith("stg_") and n != name)
    return frame(name, prepared(tables, stages, *shared, source=events(sf_dir), kept=KEPT))


def daily_frames(landing: DataFrame, models: Sequence[str]) -> dict[str, DataFrame]:
    """Models over a landing table, or the part of it that holds some days; their stages are written once."""
    tables = {"landing": landing} | {n: constant(landing.sparkSession, n) for n in CONSTANTS}
    stages = dict.fromkeys(n for m in models for n in ordered(m, tables) if n.startswith("stg_") and n != m)
    tables = prepared(tables, tuple(stages))
    return {m: frame(m, tables) for m in models}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {n: (lambda spark, d, n=n: build(spark, d, n)) for n in published()}
    return out | {"landing_scan": stored} | extra.QUERIES


def oracle_sql() -> dict[str, str]:
    out = {n: checking_sql(n, base()) for n in published()}
    return out | {"landing_scan": landing_sql()} | extra.oracles() | by_hand(landing_sql())
