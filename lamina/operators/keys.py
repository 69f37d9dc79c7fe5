"""Operators on the rows that share a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def as_list(key: str | Sequence[str]) -> list[str]:
    """Column names, given as one or as several."""
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(df: DataFrame, key: str | Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*as_list(key)).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` of each key, in the input's columns.

    An aggregate and not a window: each map task keeps one row per key before the shuffle, so a hot
    key is never sorted in one task. Ties go to the greatest remaining columns, so that a rerun of a
    lost task keeps the same row.
    """
    keys, order = as_list(key), as_list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest)).alias("_latest")
    latest = df.groupBy(*keys).agg(packed)
    return latest.select(*[F.col(c) if c in keys else F.col(f"_latest.{c}").alias(c) for c in df.columns])
