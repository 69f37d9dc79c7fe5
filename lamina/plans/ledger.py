"""A table of finished stages, and what is left to do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from lamina.operators.joins import missing_from
from lamina.operators.keys import latest_per_key
from lamina.schemas import GATE, LEDGER, STAGES
from lamina.sources.tables import load_if_present, rows_of

DONE = "SUCCESS"
FAILED = "FAILED"


def record_stage(
    spark: SparkSession,
    ledger: str,
    run_id: str,
    stage: str,
    rows: int | None = None,
    status: str = DONE,
    at: datetime | None = None,
    read: str | None = None,
    written: str | None = None,
) -> None:
    """Append one ledger row; a row written twice by a rerun is harmless.

    ``read`` and ``written`` are fingerprints of what the stage has read and written, where they are known.
    """
    row = (run_id, stage, status, None if rows is None else int(rows), at or datetime.now(timezone.utc), read, written)
    rows_of(spark, LEDGER, row).coalesce(1).write.mode("append").parquet(ledger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    if load_if_present(spark, ledger, "parquet") is None:
        return rows_of(spark, LEDGER)
    # By the whole schema, as rows that were written before a column existed lack it.
    return spark.read.schema(LEDGER).parquet(ledger)


def latest_status(entries: DataFrame) -> DataFrame:
    """The newest ledger row of each run and stage."""
    return latest_per_key(entries, ["run_id", "stage"], ["at"])


def pending(expected: DataFrame, entries: DataFrame) -> DataFrame:
    """Expected (run_id, stage) rows whose newest ledger row is not a success."""
    done = latest_status(entries).filter(F.col("status") == DONE)
    return missing_from(expected, done, ["run_id", "stage"])


def newest_rows(spark: SparkSession, ledger: str, run_id: str, stages: Sequence[str] = STAGES) -> dict[str, Row]:
    """The newest ledger row of each stage of a run; one row per stage reaches the driver."""
    entries = read_ledger(spark, ledger).filter((F.col("run_id") == run_id) & F.col("stage").isin(*stages))
    return {r["stage"]: r for r in latest_status(entries).collect()}


def is_stale(row: Mapping | Row | None, before: Mapping | Row | None) -> bool:
    """Whether a stage is to do, by its newest row and that of the stage whose output it reads.

    Where both fingerprints are known, its input must be what that stage has last written; else it must not be
    older than that stage.
    """
    if row is None or row["status"] != DONE:
        return True
    if before is None:
        return False
    if row["input"] and before["output"]:
        return row["input"] != before["output"]
    return row["at"] < before["at"]


def pending_stages(spark: SparkSession, ledger: str, run_id: str, stages: Sequence[str] = STAGES) -> list[str]:
    """Stages of one run still to do, in order.

    A stage is done if its newest row is a success whose input is what the stage before it has written last (``is_stale``). Once one stage
    is to do, so may all be that follow, as they read what it writes; the arrival gate writes nothing, so it only counts for
    itself. One row per stage reaches the driver.
    """
    latest = newest_rows(spark, ledger, run_id, stages)
    left, stale, before = [], False, None
    for stage in stages:
        row = latest.get(stage)
        if stage == GATE:
            due = is_stale(row, None)
        else:
            due = stale = stale or is_stale(row, before)
            before = row
        if due:
            left.append(stage)
    return left
