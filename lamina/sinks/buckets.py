"""A keyed Parquet table in hashed buckets, of which an upsert reads and writes only those it touches.

Buckets are partitions, so the rows of a source meet their table by partition pruning and replace it by a dynamic
partition overwrite; nothing is kept beside the rows. An upsert that is done again changes nothing, so whoever fails half
way does it again. One writer at a time is assumed, and readers open the table between upserts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lamina.operators.guards import require_columns, require_set_key, require_unique_key
from lamina.operators.incremental import BATCH, ROWS, merged_states, state_changes
from lamina.operators.keys import as_list, latest_per_key
from lamina.operators.upsert import keyed_upsert
from lamina.session import measured_broadcasts, planned_bytes, scratch_dir, wide_shuffle
from lamina.sinks.runs import overwrite_partitions, write_run
from lamina.sources.tables import load_if_present

# Buckets of a table that is written for the first time: one per so many bytes of its first source, and the fewest.
BUCKET_BYTES = 64 << 20
FEWEST = 16

# Rows of a source up to which its keys may be broadcast by the size of its files, so that the table is not shuffled.
UNMEASURED_ROWS = 100_000

# Partition columns: how many buckets the table has, and a row's own.
_PLACE = ("_buckets", "_bucket")


def _place(keys: Sequence[str], buckets: int) -> dict[str, Column]:
    return {"_buckets": F.lit(buckets), "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")}


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """The table's rows, or None if nothing was written yet."""
    stored = load_if_present(spark, root)
    return None if stored is None else stored.drop(*_PLACE)


def touched_rows(stored: DataFrame, staged: DataFrame) -> DataFrame:
    """The stored rows of the buckets that occur in ``staged``; others are not read. One number per touched bucket reaches the driver."""
    touched = sorted(r["_bucket"] for r in staged.select("_bucket").distinct().collect())
    return stored.filter(F.col("_bucket").isin(touched))


def merged_buckets(
    stored: DataFrame, staged: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str] | None = None
) -> DataFrame:
    """All rows of the buckets that occur in ``staged``, after the upsert."""
    return keyed_upsert(touched_rows(stored, staged), staged, key, order_by, checked=True)


def _apply(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int | None,
    prepare: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> int:
    """Store the prepared source with its buckets, merge it with their rows and replace them; returns how many rows it brings."""
    stored = load_if_present(spark, root)
    if stored is not None:
        require_columns(source, [c for c in stored.columns if c not in (*_PLACE, BATCH)])
        buckets = int(stored.select("_buckets").first()[0])
        kept = [f for f in stored.schema if f.name not in _PLACE and f.name in source.columns]
        source = source.select(*[F.col(f.name).cast(f.dataType) for f in kept])
    elif buckets is None:
        buckets = max(FEWEST, -(-planned_bytes(source) // BUCKET_BYTES))
    stage = scratch_dir(spark, "staged")
    with wide_shuffle(spark, planned_bytes(source)):
        rows = write_run(prepare(source).withColumns(_place(keys, buckets)), stage)
    if not rows:
        return 0
    merged = merge(stored, spark.read.parquet(stage))
    with wide_shuffle(spark, planned_bytes(merged)), nullcontext() if rows <= UNMEASURED_ROWS else measured_broadcasts(spark):
        # One task and file per bucket.
        overwrite_partitions(merged.repartition("_bucket"), root, _PLACE)
    return rows


def upsert_buckets(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    key: str | Sequence[str],
    order_by: str | Sequence[str] | None = None,
    buckets: int | None = None,
) -> int:
    """Upsert ``source`` into the table at ``root``; returns how many rows it brings.

    Keys are checked, and rows chosen by ``order_by``, as in ``keyed_upsert``. The first upsert decides on the columns and the number of ``buckets``, by its size
    if none is given; a bucket should be some hundred megabytes at most once the table has grown. Later ones cast to the table's types.
    The source is stored first, since it is read several times.
    """
    keys = as_list(key)

    def prepare(rows: DataFrame) -> DataFrame:
        return require_unique_key(rows, keys) if order_by is None else latest_per_key(require_set_key(rows, keys), keys, order_by)

    def merge(stored: DataFrame | None, staged: DataFrame) -> DataFrame:
        return staged if stored is None else merged_buckets(stored, staged, keys, order_by)

    return _apply(spark, root, source, keys, buckets, prepare, merge)


def change_rollup(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    key: str | Sequence[str],
    batch: int,
    sign: Column,
    buckets: int | None = None,
    **sums: Column,
) -> int:
    """Add a batch of additions and retractions to the summaries stored at ``root``; returns how many keys it changes.

    ``sign`` and ``sums`` are those of ``state_changes``, batches are numbered in their order. Only the buckets of the batch's own keys are
    read and written, and a batch that is done again changes nothing.
    """
    keys = as_list(key)
    source = state_changes(changes, keys, sign, **sums)

    def merge(stored: DataFrame | None, staged: DataFrame) -> DataFrame:
        if stored is None:
            return staged.withColumn(BATCH, F.lit(batch).cast("long"))
        merged = merged_states(touched_rows(stored, staged).drop(*_PLACE), staged.drop(*_PLACE), keys, batch)
        return merged.withColumns(_place(keys, int(staged.select("_buckets").first()[0])))

    return _apply(spark, root, source, keys, buckets, lambda rows: rows, merge)


def read_rollup(spark: SparkSession, root: str) -> DataFrame | None:
    """The summaries of all keys that still have rows, or None if nothing was written yet."""
    stored = read_buckets(spark, root)
    return None if stored is None else stored.filter(F.col(ROWS) > 0).drop(BATCH)
