"""Models: named tables that follow from other tables.

A model says where its rows come from, which of them it takes, and its columns.
``frame`` composes lazy DataFrames from the landing table up, so Catalyst sees
one plan from landing to mart; ``checking_sql`` gives the statement by which
another engine arrives at the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightvault.functions.dialect import DUCK, SPARK, render


@dataclass(frozen=True)
class Model:
    """One step: filter, then project or aggregate, then project again.

    source: a model, or several whose rows are put together (by ``parts``,
    projections of each, or by the columns themselves).
    group: grouping columns with their expressions; then ``columns`` are aggregates.
    after: columns over the aggregates; ``then`` filters what comes out.
    window: columns added at the end, with their own OVER clause.
    join: (model, kind, condition) on ``l`` and ``r``; joined rows are the source.
    """

    source: str | tuple[str, ...]
    columns: dict[str, str] = field(default_factory=dict)
    where: str | None = None
    group: dict[str, str] = field(default_factory=dict)
    after: dict[str, str] = field(default_factory=dict)
    then: str | None = None
    distinct: bool = False
    parts: tuple[dict[str, str], ...] = ()
    wheres: tuple[str | None, ...] = ()
    union_distinct: bool = False
    join: tuple[str, str, str] | None = None

    def sources(self) -> tuple[str, ...]:
        own = (self.source,) if isinstance(self.source, str) else self.source
        return own + ((self.join[0],) if self.join else ())


MODELS: dict[str, Model] = {}


def same(*names: str) -> dict[str, str]:
    """Columns that keep their names."""
    return {n: n for n in " ".join(names).split()}


def add(name: str, model: Model) -> None:
    if name in MODELS:
        raise ValueError(f"two models are called {name}")
    MODELS[name] = model


def _exprs(columns: dict[str, str]) -> list:
    return [F.expr(render(e, SPARK)).alias(n) for n, e in columns.items()]


def frame(name: str, given: dict[str, DataFrame]) -> DataFrame:
    """The rows of a model. ``given``: tables by name, at least ``landing``; models found there are taken as they are."""
    if name in given:
        return given[name]
    m = MODELS[name]
    on = (lambda t: F.expr(render(t, SPARK)))
    if isinstance(m.source, tuple):
        sides = [frame(s, given) for s in m.source]
        sides = [d.where(on(w)) if w else d for d, w in zip(sides, m.wheres or (None,) * len(sides), strict=True)]
        sides = [d.select(*_exprs(p)) for d, p in zip(sides, m.parts, strict=True)] if m.parts else sides
        df = sides[0]
        for side in sides[1:]:
            df = df.unionByName(side)
        df = df.distinct() if m.union_distinct else df
    elif m.join:
        df = frame(m.source, given).alias("l").join(frame(m.join[0], given).alias("r"), on(m.join[2]), m.join[1].replace(" ", "_"))
    else:
        df = frame(m.source, given)
    df = df.where(on(m.where)) if m.where else df
    if m.group:
        df = df.groupBy(*_exprs(m.group)).agg(*_exprs(m.columns))
    elif m.columns:
        df = df.select(*_exprs(m.columns))
    if m.after:
        df = df.select(*_exprs(m.after))
    df = df.where(on(m.then)) if m.then else df
    return df.distinct() if m.distinct else df


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{render(e, DUCK)} AS {n}" for n, e in columns.items()) or "*"


def _statement(m: Model) -> str:
    where = f" WHERE {render(m.where, DUCK)}" if m.where else ""
    if isinstance(m.source, tuple):
        each = [f"SELECT {_listed(p)} FROM {s}" + (f" WHERE {render(w, DUCK)}" if w else "") for s, p, w in zip(m.source, m.parts or ({},) * len(m.source), m.wheres or (None,) * len(m.source), strict=True)]
        of = "(" + (" UNION " if m.union_distinct else " UNION ALL BY NAME ").join(each) + ")"
    elif m.join:
        kind = {"left": "LEFT JOIN", "full": "FULL JOIN", "inner": "JOIN", "left anti": "ANTI JOIN", "left semi": "SEMI JOIN", "cross": "JOIN"}[m.join[1]]
        of = f"{m.source} AS l {kind} {m.join[0]} AS r ON {render(m.join[2], DUCK)}"
    else:
        of = m.source
    if m.group:
        sql = f"SELECT {_listed(m.group)}, {_listed(m.columns)} FROM {of}{where} GROUP BY {', '.join(render(e, DUCK) for e in m.group.values())}"
    else:
        sql = f"SELECT {_listed(m.columns)} FROM {of}{where}"
    if m.after:
        sql = f"SELECT {_listed(m.after)} FROM ({sql})"
    if m.then:
        sql = f"SELECT * FROM ({sql}) WHERE {render(m.then, DUCK)}"
    return f"SELECT DISTINCT * FROM ({sql})" if m.distinct else sql


def ordered(name: str, base: dict[str, str]) -> list[str]:
    """The models that ``name`` needs, each after its own needs."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n not in out:
            for s in MODELS[n].sources() if n not in base else ():
                visit(s)
            out.append(n)

    visit(name)
    return out


def checking_sql(name: str, base: dict[str, str], extra: str | None = None) -> str:
    """A statement of common table expressions over ``base`` (statements by name)."""
    steps = [(n, base[n] if n in base else _statement(MODELS[n])) for n in ordered(name, base)]
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in steps) + f"\nSELECT * FROM {name}" + (extra or "")


def variant(name: str, **changes) -> Model:
    return replace(MODELS[name], **changes)
