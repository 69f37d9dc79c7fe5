"""Run-scoped Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lamina.operators.guards import require_set_key
from lamina.operators.joins import missing_from
from lamina.operators.keys import as_list, latest_per_key
from lamina.sources.tables import load_if_present


class RowCount(int):
    """A number of rows, with a fingerprint of their contents where one was taken."""

    fingerprint: str | None = None

    @classmethod
    def of(cls, rows: int, fingerprint: str | None = None) -> RowCount:
        count = cls(rows)
        count.fingerprint = fingerprint
        return count

    @classmethod
    def total(cls, *counts: RowCount) -> RowCount:
        """The sum of several tables' counts, with all their fingerprints if each has one."""
        prints = [c.fingerprint for c in counts]
        return cls.of(sum(counts), " ".join(prints) if all(prints) else None)


def _observed(df: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *more), seen


def content_aggregates(df: DataFrame, but: Sequence[str] = ()) -> list[Column]:
    """Aggregates that tell two tables' contents apart whatever the order of their rows, columns in ``but`` left out.

    The sum tells repeated rows, which cancel each other in the exclusive or.
    """
    row = F.xxhash64(*[c for c in df.columns if c not in but])
    return [F.sum(row.cast("decimal(38,0)")).alias("sum"), F.bit_xor(row).alias("xor")]


def write_run(df: DataFrame, path: str, fingerprint: bool = False, but: Sequence[str] = ()) -> RowCount:
    """Write one run's table, replacing an earlier attempt of the same run; returns its row count.

    The count is taken while writing, so the input is computed once, and so is the ``fingerprint`` of all columns
    but those in ``but``.
    """
    observed, seen = _observed(df, *(content_aggregates(df, but) if fingerprint else ()))
    observed.write.mode("overwrite").parquet(path)
    found = seen.get
    return RowCount.of(found["rows"], f"{found['rows']}:{found['sum']}:{found['xor']}" if fingerprint else None)


def overwrite_partitions(df: DataFrame, path: str, by: str | Sequence[str] = "run_id") -> int:
    """Replace the partitions that occur in ``df`` and leave all others; returns the row count."""
    columns = as_list(by)
    observed, seen = _observed(df)
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    return seen.get["rows"]


def append_new(incoming: DataFrame, path: str, on: str | Sequence[str]) -> int:
    """Append the incoming rows whose name is not in the table at ``path`` yet; returns how many.

    What has landed is never replaced. One row per name is taken, the greatest by its other columns; a row
    without a name is an error.
    """
    landed = load_if_present(incoming.sparkSession, path)
    first = latest_per_key(require_set_key(incoming, on).withColumn("_one", F.lit(1)), on, "_one").drop("_one")
    observed, seen = _observed(first if landed is None else missing_from(first, landed, on))
    observed.write.mode("append").parquet(path)
    return seen.get["rows"]
