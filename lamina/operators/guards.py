"""Checks that stop a run before it writes something wrong."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lamina.operators.keys import as_list


class ExpectationError(RuntimeError):
    """A table does not meet what the next step needs."""


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ExpectationError(f"missing columns: {missing}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ExpectationError(message)
    return df


def _unset(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def require_set_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Raise if a key is NULL; the test is pushed to the scan."""
    keys = as_list(key)
    if df.filter(_unset(keys)).select(*keys).take(1):
        raise ExpectationError(f"NULL in key {keys}")
    return df


def require_unique_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Raise if a key is NULL or occurs twice.

    Reads the key columns only, counts per key before the shuffle and fetches one offender.
    """
    keys = as_list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offender = counts.filter((F.col("_rows") > 1) | _unset(keys)).take(1)
    if offender:
        row = offender[0].asDict()
        rows = row.pop("_rows")
        raise ExpectationError(f"key {row} occurs {rows} times; keys must be set and unique")
    return df
