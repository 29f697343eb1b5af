"""Named queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.plans import estimates, html, intake, joins, pages, quality, records, reuse, sampling, selection, sequences

#: Modules of this package with QUERIES and ORACLE.
MODULES = (reuse, quality, selection, sequences, joins, sampling, estimates, pages, html, intake, records)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
