"""Summaries of a child table joined to its parent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from lamina.operators.joins import lookup_join
from lamina.operators.keys import as_list
from lamina.operators.orphans import drop_orphans


def child_rollup(child: DataFrame, key: str | Sequence[str], **aggregates: Column) -> DataFrame:
    """All summaries of the child in one aggregate: one scan and one shuffle of partial results.

    A hot key shuffles one partial row per map task, so no task sees its whole group.
    """
    keys = as_list(key)
    return child.groupBy(*keys).agg(*[a.alias(name) for name, a in aggregates.items()])


def left_enrich(
    parent: DataFrame, rollup: DataFrame, key: str | Sequence[str], defaults: Mapping[str, Any]
) -> DataFrame:
    """Every parent row with its rollup columns; parents without children get ``defaults``.

    Duplicate parents all stay, a NULL key never matches, children without a parent vanish.
    ``rollup`` holds one row per key, as ``child_rollup`` returns it.
    """
    joined = lookup_join(parent, rollup, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def enrich(
    parent: DataFrame,
    child: DataFrame,
    key: str | Sequence[str],
    aggregates: Mapping[str, Column],
    defaults: Mapping[str, Any],
    many_orphans: bool = False,
) -> DataFrame:
    """``child_rollup`` and ``left_enrich`` in one step.

    ``many_orphans`` is for children most of whom have no parent here: they are left out before their shuffle, at the
    price of a scan of the parents' keys.
    """
    if many_orphans:
        child = drop_orphans(child, parent, key)
    return left_enrich(parent, child_rollup(child, key, **aggregates), key, defaults)
