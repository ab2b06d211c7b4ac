"""Models that several others read, written once.

A plan that reads the same satellite ten times would compute it ten times.
``prepared`` writes the shared models of a query as parquet to the cluster's
shared folder and hands the written tables to the rest of the plan.  Stages and
daily tables are kept for the application, as long as their input doesn't change.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame

from brightvault.plans.model import frame
from brightvault.sources.shared import stored, write_table

#: Jobs that are submitted at once; a small one leaves most of a cluster idle.
WRITERS = 6


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder."""
    return write_table(df, name)[0]


def prepared(given: dict[str, DataFrame], *waves: tuple[str, ...], source: str = "", kept: frozenset[str] = frozenset()) -> dict[str, DataFrame]:
    """``given`` with models written: those of a wave side by side, each from the waves before.

    Models in ``kept`` are written once per application and version of ``source``.
    """
    given = dict(given)

    def table(name: str, tables: dict[str, DataFrame]) -> DataFrame:
        if name in kept:
            return stored(tables["landing"].sparkSession, source, name, lambda: frame(name, tables))
        return written(frame(name, tables), name)

    for wave in waves:
        contexts = [copy_context() for _ in wave]  # the clock goes along
        with ThreadPoolExecutor(WRITERS) as pool:
            tables = list(pool.map(lambda c, n, g=given: c.run(table, n, g), contexts, wave))
        given = given | dict(zip(wave, tables, strict=True))
    return given
