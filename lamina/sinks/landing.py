"""Raw copies of archive entries."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lamina.functions.names import base_name
from lamina.operators.guards import ExpectationError
from lamina.operators.joins import missing_from
from lamina.session import session_setting
from lamina.sinks.runs import write_run
from lamina.sources.archives import SAMPLE_BYTES, UNCLASSIFIED, expand_entries, list_entries
from lamina.sources.tables import load_if_present

# Files a landing task keeps open at a time.
OPEN_FILES = 100

# Blocks after which a landing task begins a new file of the same entry.
FILE_BLOCKS = 4096

# Folders of a landing, outermost first.
_FOLDERS = ("_entity", "_delimiter", "_archive", "_entry")


def land_entries(
    chunks: DataFrame, path: str, ordered: bool = False, batch: int | None = None, keep: bool = False
) -> None:
    """Raw copy of the entries, byte for byte, in a folder per entity, separator, archive and entry.

    Blocks are written by the tasks that inflate them, without a shuffle. Each task keeps a file
    open per entry it has met instead of sorting its blocks by entry first, and begins a new one when
    it has grown large. ``ordered`` sorts the blocks by number and keeps an entry in one file, for
    records that span lines. A numbered ``batch`` is added to what has landed before and replaces
    only itself; with ``keep`` an entry replaces only itself; otherwise the landing is replaced.
    """
    if ordered:
        chunks = chunks.sortWithinPartitions(*_FOLDERS, "path", "nth", "chunk")
    value = F.col("content").cast("string").alias("value")
    if batch is None:
        rows, folders, mode = chunks.select(value, *_FOLDERS), _FOLDERS, "dynamic" if keep else "static"
    else:
        rows = chunks.select(value, *_FOLDERS, F.lit(batch).cast("long").alias("_batch"))
        folders, mode = (*_FOLDERS[:2], "_batch", *_FOLDERS[2:]), "dynamic"
    writers = "0" if ordered else str(OPEN_FILES)
    options = {"partitionOverwriteMode": mode, "maxRecordsPerFile": "0" if ordered else str(FILE_BLOCKS)}
    with session_setting(chunks.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", writers):
        rows.write.mode("overwrite").options(**options).partitionBy(*folders).text(path)


def land_archives(
    archives: DataFrame,
    path: str,
    suffix: str = ".csv",
    encoding: str = "ISO-8859-1",
    ordered: bool = False,
    expect: Sequence[str] = (),
    batch: int | None = None,
    keep_landed: bool = False,
    sample_bytes: int = SAMPLE_BYTES,
) -> int:
    """List the entries into ``path/entries``, land them in ``path/csv``; returns how many there are.

    All entities are landed by one job, so that their archives are inflated side by side. An entity
    of ``expect`` without an entry stops it before anything is inflated.

    With ``keep_landed`` archives are added to what is there and one whose name has landed is left alone, whatever
    it holds now; ``path/landed`` keeps the names. An attempt that failed is replaced by the next one. Of
    equal names in ``archives`` the least path is taken.
    """
    spark = archives.sparkSession
    listing = f"{path}/entries" if batch is None else f"{path}/entries/_batch={batch}"
    if keep_landed:
        if batch is not None:
            raise ValueError("a landing is kept by batch or by name, not both")
        attempt = uuid.uuid4().hex
        listing = f"{path}/entries/_attempt={attempt}"
        archives = _not_landed(archives, f"{path}/landed", f"{path}/incoming/{attempt}")
        if archives.isEmpty():
            return 0
    found = write_run(list_entries(archives, suffix, sample_bytes=sample_bytes), listing)
    entries = spark.read.parquet(listing)
    if expect:
        expected = entries.filter(F.col("entity").isin(*expect))
        present = {r["entity"] for r in expected.select("entity").distinct().collect()}
        absent = [e for e in expect if e not in present]
        if absent:
            raise ExpectationError(f"no {suffix} entry in any archive of {absent}")
    if found:
        land_entries(expand_entries(entries, encoding), f"{path}/csv", ordered, batch, keep=keep_landed)
    if keep_landed:
        archives.select("archive").write.mode("append").parquet(f"{path}/landed")
    return found


def _not_landed(archives: DataFrame, log: str, names: str) -> DataFrame:
    """One row per archive name that is not in the log, its least path and entity; stored in ``names``."""
    name = F.col("archive") if "archive" in archives.columns else base_name("path")
    entity = F.col("entity") if "entity" in archives.columns else F.lit(UNCLASSIFIED)
    first = archives.groupBy(name.alias("archive")).agg(F.min(F.struct("path", entity.alias("entity"))).alias("first"))
    incoming = first.select("archive", "first.path", "first.entity")
    landed = load_if_present(archives.sparkSession, log)
    new = incoming if landed is None else missing_from(incoming, landed, "archive")
    # Stored, since the log that follows the landing would empty the same plan.
    new.write.parquet(names)
    return archives.sparkSession.read.schema(new.schema).parquet(names)
