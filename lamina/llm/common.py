"""What several operators share: stored intermediate tables, worker-wide caches, row identity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lamina.session import scratch_dir, wide_shuffle

# Bytes of one Arrow batch. Texts may be very long; a batch ends with the row that passes this size.
BATCH_BYTES = 4 << 20


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that the plan reads, each scan counted; those of unknown size are not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.length())]
    return sum(size for size in sizes if size < 1 << 60)


def stash(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared scratch folder and read again.

    This cuts the lineage: what follows survives a lost executor without computing ``df`` again. The shuffles of this write
    are as wide as the bytes it scans ask for, and at least as wide as the session's.
    """
    path = scratch_dir(df.sparkSession, label)
    with wide_shuffle(df.sparkSession, scanned_bytes(df)):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stash_seen(df: DataFrame, label: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """``stash`` with aggregates of the rows, taken while they are written."""
    seen = Observation()
    stored = stash(df.observe(seen, *[a.alias(n) for n, a in aggregates.items()]), label)
    return stored, seen.get


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Hand texts to Python workers in batches of about ``size`` bytes, so that long ones fit in their memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def worker_cache(family: str, name: str, make: Callable):
    """A value that outlives its task in the Python worker, shared by the tasks that run in it.

    A worker holds the values of one family at a time, so what earlier operators left does not add up.
    """
    import sys
    import types

    box = sys.modules.setdefault("_lamina_worker_cache", types.ModuleType("_lamina_worker_cache"))
    if getattr(box, "family", None) != family:
        box.family, box.values = family, {}
    if name not in box.values:
        box.values[name] = make()
    return box.values[name]


def runs_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``most`` at most; a larger item has its own range."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def id_bucket(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a NULL id counts as the empty text."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(name.cast("string"), F.lit("")).cast("binary")) % buckets


# Columns that tell rows apart although ids may be NULL or repeated.
ROW_KEY = ("_lamina_row_id", "_lamina_row_text")


def row_key(doc_id: str, text: str) -> dict[str, Column]:
    """Identity of a row: its id (NULL as the smallest number) and a hash of its text.

    Rows that agree in both are copies of one row and share every decision.
    """
    return {
        ROW_KEY[0]: F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))),
        ROW_KEY[1]: F.xxhash64(F.col(doc_id), F.col(text)),
    }
