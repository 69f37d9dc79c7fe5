"""Keyed upsert of one table into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lamina.operators.guards import require_columns, require_set_key, require_unique_key
from lamina.operators.keys import as_list, latest_per_key


def keyed_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Target rows whose key the source does not hold, and all source rows.

    Source keys must be set and unique, else this raises. With ``order_by`` the latest row of each
    key is taken instead, the target's row included, so that a row that comes late changes nothing; only
    NULL keys raise. Of rows that are equally late the one with the greatest remaining columns is taken. ``checked``
    skips the check for a source that has passed it. The target holds one row per key, as this function leaves it, so
    neither side can be skewed. Without an order, and where the source is small, AQE broadcasts its
    keys and the target is not shuffled.
    """
    keys = as_list(key)
    require_columns(source, target.columns)
    if order_by is not None:
        if not checked:
            require_set_key(source, keys)
        return _latest_of_both(target, latest_per_key(source, keys, order_by), keys, order_by)
    if not checked:
        require_unique_key(source, keys)
    source = source.select(*target.columns)
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def _latest_of_both(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str | Sequence[str]
) -> DataFrame:
    """Of each key the later of the target's and the source's row; one join, each side read once."""
    order = as_list(order_by)
    rest = [c for c in target.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    both = target.select(*keys, packed.alias("_old")).join(
        source.select(*target.columns).select(*keys, packed.alias("_new")), list(keys), "full_outer"
    )
    later = both.select(*keys, F.greatest("_old", "_new").alias("_row"))
    return later.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns])
