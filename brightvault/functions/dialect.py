"""Expressions that Spark and the checking engine both understand.

Columns are written once, as SQL expressions.  Where the two engines differ,
an expression has a mark such as ``{{text|post_id}}``; ``SPARK`` and ``DUCK``
say what each mark stands for.  Spark runs the expressions through
``functions.expr``, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

ZONE = "Europe/Istanbul"
MARK = re.compile(r"\{\{(\w+)\|([^{}]*)\}\}")

#: The instants that stand for now: a query never asks the machine's clock. ``at`` sets them.
NOW = {"evaluated_at": "2024-01-04 12:00:00", "window_end": "2024-01-05 00:00:00"}
_clock: ContextVar[dict[str, str]] = ContextVar("clock", default=NOW)


@contextmanager
def at(**instants: str | None) -> Iterator[None]:
    """Statements that are rendered inside take these instants (UTC), where given."""
    unknown = set(instants) - set(NOW)
    if unknown:
        raise ValueError(f"no such instant: {sorted(unknown)}")
    token = _clock.set(_clock.get() | {k: v for k, v in instants.items() if v is not None})
    try:
        yield
    finally:
        _clock.reset(token)


#: What both engines read alike.
BOTH = {
    "n": "CAST(count_if({0}) AS BIGINT)",
    "rows": "count(*)",
    "sum0": "CAST(coalesce(sum({0}), 0) AS BIGINT)",
    "distinct": "count(DISTINCT {0})",
    "long": "CAST({0} AS BIGINT)",
    "small_cell": "CASE WHEN count(DISTINCT {0}) >= 10 THEN 'reportable' ELSE 'suppress_before_pl' END",
    "reportable": "CASE WHEN {0} >= 10 THEN 'reportable' ELSE 'suppress_before_pl' END",
    "or_unknown": "coalesce({0}, 'unknown')",
    "present": "nullif({{text|{0}}}, '')",
    "count_of": "{{int|{{text|{0}}}}}",
}

SPARK = BOTH | {
    "doc": "from_json({0}, 'map<string,string>')",
    "text": "try_element_at(doc, '{0}')",
    "path": "get_json_object({0}, '{1}')",
    "key": "coalesce(map_contains_key(doc, '{0}'), false)",
    "int": "CASE WHEN {0} RLIKE '^[0-9]+$' THEN try_cast({0} AS INT) END",
    "token": "nullif(regexp_replace(lower({0}), '[^a-z0-9_:-]', ''), '')",
    "drop": "regexp_replace({0}, '{1}', '')",
    "stamp": "date_format({0}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "day": f"to_date(from_utc_timestamp({{0}}, '{ZONE}'))",
    "closes": f"to_utc_timestamp(CAST(date_add({{0}}, 1) AS TIMESTAMP), '{ZONE}')",
    "sha": "sha2({0}, 256)",
    "flag": "CASE WHEN lower(coalesce({0}, 'false')) IN ('true', 'false') THEN CAST({0} AS BOOLEAN) ELSE false END",
    "like": "{0} RLIKE '{1}'",
    "minutes": "CAST(floor((unix_micros({0}) - unix_micros({1})) / 60000000) AS BIGINT)",
    "plus_minutes": "{0} + make_dt_interval(0, 0, {1}, 0)",
    "date_text": "CAST({0} AS STRING)",
    "txt": "CAST({0} AS STRING)",
    "hour": "date_trunc('hour', {0})",
    "iso": "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "ms": "date_trunc('millisecond', {0})",
    "div": "(CAST({0} AS DOUBLE) / CAST({1} AS DOUBLE))",
    "keys": "map_keys({0})",
    "split": "explode(split({0}, ','))",
    "list": "array({0})",
    "unlisted": "size(array_except({0}, {1}))",
    "bytes": "CAST(CASE WHEN {1} THEN concat(CAST({0} AS BINARY), X'FF') ELSE CAST({0} AS BINARY) END AS BINARY)",
    "each": "explode(array_compact(array({0})))",
    "st": "named_struct('a', {0}, 'b', {1}, 'c', {2})",
    "st5": "named_struct('a', {0}, 'b', {1}, 'c', {2}, 'd', {3}, 'e', {4})",
}

DUCK = BOTH | {
    "doc": "{0}",
    "text": "json_extract_string(doc, '$.{0}')",
    "path": "json_extract_string({0}, '{1}')",
    "key": "coalesce(list_contains(json_keys(doc), '{0}'), false)",
    "int": "CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN try_cast({0} AS INTEGER) END",
    "token": "nullif(regexp_replace(lower({0}), '[^a-z0-9_:-]', '', 'g'), '')",
    "drop": "regexp_replace({0}, '{1}', '', 'g')",
    "stamp": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
    "day": "CAST({0} + INTERVAL 3 HOUR AS DATE)",
    "closes": "(CAST({0} AS TIMESTAMP) + INTERVAL 21 HOUR)",
    "sha": "sha256({0})",
    "flag": "CASE WHEN lower(coalesce({0}, 'false')) IN ('true', 'false') THEN CAST({0} AS BOOLEAN) ELSE false END",
    "like": "regexp_matches({0}, '{1}')",
    "minutes": "CAST(floor((epoch_us({0}) - epoch_us({1})) / 60000000) AS BIGINT)",
    "plus_minutes": "{0} + to_minutes({1})",
    "date_text": "CAST({0} AS VARCHAR)",
    "txt": "CAST({0} AS VARCHAR)",
    "hour": "date_trunc('hour', {0})",
    "iso": "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')",
    "ms": "date_trunc('millisecond', {0})",
    "div": "(CAST({0} AS DOUBLE) / CAST({1} AS DOUBLE))",
    "keys": "json_keys({0})",
    "split": "unnest(string_split({0}, ','))",
    "list": "[{0}]",
    "unlisted": "CAST(len(list_filter({0}, lambda k: NOT list_contains({1}, k))) AS INTEGER)",
    "bytes": "CASE WHEN {1} THEN encode({0}) || '\\xFF'::BLOB ELSE encode({0}) END",
    "each": "unnest(list_filter([{0}], lambda x: x IS NOT NULL))",
    "st": "struct_pack(a := {0}, b := {1}, c := {2})",
    "st5": "struct_pack(a := {0}, b := {1}, c := {2}, d := {3}, e := {4})",
}


def render(text: str, marks: dict[str, str]) -> str:
    """``text`` with its marks replaced, inner ones first; ``;;`` separates arguments."""
    while found := MARK.search(text):
        parts = [p.strip() for p in found[2].split(";;")]
        put = f"TIMESTAMP '{_clock.get()[parts[0]]}'" if found[1] == "clock" else marks[found[1]]
        for i, p in enumerate(parts):
            put = put.replace("{%d}" % i, p)
        text = text[: found.start()] + put + text[found.end() :]
    return text
