"""Joins of a large, possibly skewed side to a side that holds one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from lamina.operators.keys import as_list

_SPREAD = "_lamina_key_hash"

# Types whose equal values have equal hashes, beside integers and strings without a collation.
# Floating point has two zeros.
_EXACT = (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    TimestampNTZType,
    TimestampType,
)


def key_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column] | None:
    """The keys as columns whose hashes are equal wherever the keys are, or None if no type assures that."""
    columns = []
    for k in keys:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if isinstance(a, IntegralType) and isinstance(b, IntegralType):
            columns.append(F.col(k).cast("long"))
        elif a == b and (isinstance(a, _EXACT) or a == StringType()):
            columns.append(F.col(k))
        else:
            return None
    return columns


def lookup_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key), safe for a hot or NULL key on the left.

    AQE can split a hot left partition only when both join inputs come straight from a shuffle. A
    right side that has just been aggregated by the key would be joined in place, without one. The
    key hash is therefore a join key of its own: the aggregated side, already one row per key, is
    shuffled once more and the join stays splittable. Where it turns out small, AQE broadcasts it
    by its measured size and that shuffle is all it costs.

    Keys of two types, or of a type whose equal values may be stored differently, are joined plainly.
    """
    keys = as_list(on)
    columns = key_columns(left, right, keys)
    if columns is None:
        return left.join(right, keys, how)
    spread = F.hash(*columns)
    return (
        left.withColumn(_SPREAD, spread)
        .join(right.withColumn(_SPREAD, spread), [*keys, _SPREAD], how)
        .drop(_SPREAD)
    )


def missing_from(expected: DataFrame, present: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``expected`` whose key does not occur in ``present``.

    The present keys are reduced to one row each before the shuffle, however often they occur.
    """
    keys = as_list(on)
    return lookup_join(expected, present.select(*keys).distinct(), keys, "left_anti")
