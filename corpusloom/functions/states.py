"""Stateful fields: a value beside a state (known, unknown, not_applicable, undecided, not_available), null unless known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOWN, UNKNOWN, NOT_APPLICABLE, UNDECIDED, NOT_AVAILABLE = "known", "unknown", "not_applicable", "undecided", "not_available"
STATES = (KNOWN, UNKNOWN, NOT_APPLICABLE, UNDECIDED, NOT_AVAILABLE)


def label(value: str) -> Column:
    """The value as text, or its state in angle brackets: what unknown values are grouped under."""
    return F.when(F.col(f"{value}_state") == KNOWN, F.col(value).cast("string")).otherwise(F.concat(F.lit("<"), F.col(f"{value}_state"), F.lit(">")))


def broken(value: str) -> Column:
    """True where value and state contradict each other, or the state is none of the five."""
    state = F.col(f"{value}_state")
    return state.isNull() | ~state.isin(*STATES) | (F.col(value).isNull() == (state == KNOWN))


def known_sum(value: str) -> list[Column]:
    """Aggregates: the sum if all are known, else null with the common state, or not_available; over nothing, known zero."""
    state = F.col(f"{value}_state")
    all_known = F.coalesce(F.bool_and(state == KNOWN), F.lit(True))
    kinds = F.count_distinct(state)
    return [
        F.when(all_known, F.coalesce(F.sum(value), F.lit(0))).alias(value),
        F.when(all_known, KNOWN).when(kinds == 1, F.max(state)).otherwise(NOT_AVAILABLE).alias(f"{value}_state"),
    ]


def guarded(value: str, test: Column) -> Column:
    """test where the value is known, else false; never null."""
    return F.when(F.col(f"{value}_state") == KNOWN, F.coalesce(test, F.lit(False))).otherwise(False)
