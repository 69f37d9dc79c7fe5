"""Incremental landing of files as they arrive.

Each call handles what is new since the last one with the same checkpoint and returns. A scheduler
or a loop around it takes the place of polling for markers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from lamina.functions.names import base_name, classify_name
from lamina.sinks.buckets import upsert_buckets
from lamina.sinks.landing import land_archives
from lamina.sources.files import path_below

_FILE = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)


def _finish(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is new to a Parquet table, each input file exactly once."""
    _finish(stream.writeStream.format("parquet").option("path", path), checkpoint)


def land_archives_stream(
    spark: SparkSession,
    raw: str,
    landing: str,
    checkpoint: str,
    rules: Mapping[str, Sequence[str]],
    archive_suffix: str = ".zip",
    entry_suffix: str = ".csv",
) -> None:
    """Add the entries of new archives to ``landing/csv``; the one that landed first under a name below ``raw`` stays.

    Names and not batches decide, so neither a replayed batch nor a new checkpoint lands an archive twice. Only paths travel through the stream; executors read
    the archives when they inflate them.
    """
    files = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true").load(raw)
    arrived = files.select(
        "path", path_below("path", raw).alias("archive"), classify_name(base_name("path"), rules).alias("entity")
    ).filter(
        F.lower("path").endswith(archive_suffix.lower()) & F.col("entity").isNotNull()
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        land_archives(batch, landing, entry_suffix, keep_landed=True)

    _finish(arrived.writeStream.foreachBatch(land), checkpoint)


def upsert_stream(
    stream: DataFrame,
    root: str,
    key: str | Sequence[str],
    order_by: str | Sequence[str],
    checkpoint: str,
) -> None:
    """Upsert what is new into a bucketed table; the latest row of a key is kept, whichever batch brings it.

    A row that arrives late changes nothing, nor does a replayed batch. A batch reads and writes the buckets of its own keys
    only.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_buckets(batch.sparkSession, root, batch, key, order_by)

    _finish(stream.writeStream.foreachBatch(merge), checkpoint)
