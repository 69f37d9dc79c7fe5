"""Projections that give a table its names, types and column order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lamina.operators.guards import require_columns

# Columns that describe where a row came from and are not data of the row.
LINEAGE = ("_file", "_entity", "_delimiter", "_batch", "_archive", "_entry")


def positional_rename(df: DataFrame, names: Sequence[str], helpers: Sequence[str] = LINEAGE) -> DataFrame:
    """The first ``len(names)`` data columns under new names, in one projection.

    Helper columns are not counted; wider input is cut, narrower input raises.
    """
    columns = [c for c in df.columns if c not in helpers]
    if len(columns) < len(names):
        raise ValueError(f"table has {len(columns)} columns, {len(names)} are needed")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(columns, names)])


def coerce_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; values that do not fit become NULL."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def split_rows(df: DataFrame, column: str, name: str, sep: str = ",") -> DataFrame:
    """One row per piece of a separated list, without surrounding white space, in column ``name``.

    The list column is dropped. Pieces are trimmed after they are taken apart, one row at a time.
    """
    rest = [c for c in df.columns if c != column]
    pieces = df.select(*rest, F.explode(F.split(column, re.escape(sep))).alias(name))
    return pieces.withColumn(name, F.btrim(name, F.lit(" \t\r\n")))
