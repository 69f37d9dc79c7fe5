"""Stored tables that may not be there yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Error conditions that mean "no such table"; every other error is a real one and is raised.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_if_present(
    spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame | None:
    """The table at ``path``, or None if there is none. Reads the schema only."""
    try:
        return spark.read.format(fmt).options(**(options or {})).load(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] in _ABSENT:
            return None
        raise


def rows_of(spark: SparkSession, schema: StructType, *rows: Sequence) -> DataFrame:
    """A few literal rows, or none, as a plan of constants without a Python worker."""
    empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    for row in rows:
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)]
        empty = empty.unionByName(spark.range(1, numPartitions=1).select(*values))
    return empty


def is_readable(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True if a table with a schema is there, even one without rows."""
    return load_if_present(spark, path, fmt) is not None


def read_first_available(
    spark: SparkSession, candidates: Sequence[tuple[str, str, Mapping[str, str]]]
) -> DataFrame:
    """The first of the ``(format, path, options)`` candidates that exists."""
    for fmt, path, options in candidates:
        df = load_if_present(spark, path, fmt, options)
        if df is not None:
            return df
    raise FileNotFoundError(f"none of these is readable: {[p for _, p, _ in candidates]}")
