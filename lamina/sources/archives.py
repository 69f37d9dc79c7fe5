"""ZIP archives as distributed tables.

An archive is never loaded whole. Its directory is read first, giving one row per entry; entries are
then spread over tasks and each is inflated as a stream, in blocks of whole lines. A deflate stream
can only be read from its start, so one entry is the smallest unit; what follows the landing reads
plain text, which Spark splits by byte range.

The functions handed to Spark are closures over the standard library and Arrow, so executors need no
copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lamina.functions.names import base_name
from lamina.functions.values import separator_of

# Fixed value: bytes of a file that separator detection looks at, unless told otherwise.
SAMPLE_BYTES = 4096

# Inflated bytes of an entry that has a task of its own, and of the smaller entries that share one.
TASK_BYTES = 256 << 20

# Groups that entries are packed within, side by side; each group has a task that is not full.
PACK_GROUPS = 64

# Entity of archives that were not classified.
UNCLASSIFIED = "files"

# Folder names of the separators in a landing.
DELIMITER_NAMES = {"|": "pipe", ";": "semicolon", ",": "comma"}


def _required(name: str, kind) -> StructField:
    return StructField(name, kind, nullable=False)


_ENTRY = StructType(
    [
        _required("entity", StringType()),
        _required("path", StringType()),
        _required("archive", StringType()),
        _required("entry", StringType()),
        _required("nth", IntegerType()),
        _required("size", LongType()),
        _required("head", BinaryType()),
    ]
)
# Names are non-null so that the writer recognises a landing that is already in their order.
_CHUNK = StructType(
    [
        _required("path", StringType()),
        _required("_entity", StringType()),
        _required("_archive", StringType()),
        _required("_entry", StringType()),
        _required("_delimiter", StringType()),
        _required("nth", IntegerType()),
        _required("chunk", IntegerType()),
        _required("content", BinaryType()),
    ]
)


def file_opener(read_ahead: int = 8 << 20) -> Callable:
    """A function that opens a path for random access on an executor.

    Object stores are read ``read_ahead`` bytes at a time, as each read is a request.
    """

    def open_path(path: str):
        from urllib.parse import quote

        scheme, sep, rest = path.partition(":")
        if not sep or "/" in scheme:
            return open(path, "rb")
        if scheme == "file":
            return open("/" + rest.lstrip("/"), "rb")
        import io

        from pyarrow import fs

        scheme = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}.get(scheme, scheme)
        filesystem, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
        return io.BufferedReader(filesystem.open_input_file(inner), read_ahead)

    return open_path


def list_entries(
    archives: DataFrame, suffix: str = ".csv", opener: Callable | None = None, sample_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """Entries of the archives in ``path``: name, place in the directory, size and first bytes, from the archive directories.

    The ``entity`` of a classified archive is passed on to its entries, and so is ``archive``, its name in the lineage
    (the base name if there is no such column). Folders and entries without ``suffix`` (ignoring case) are left out. An
    entry is identified by archive and place, so repeated names, in one archive or in several, do not collide.
    """
    open_path = opener or file_opener(read_ahead=1 << 16)
    wanted = suffix.lower()

    def read_directories(batches):
        import zipfile

        import pyarrow as pa

        for batch in batches:
            for entity, path, origin in zip(*[c.to_pylist() for c in batch.columns]):
                names, places, sizes, heads = [], [], [], []
                with open_path(path) as handle, zipfile.ZipFile(handle) as archive:
                    for nth, info in enumerate(archive.infolist()):
                        if info.is_dir() or not info.filename.lower().endswith(wanted):
                            continue
                        with archive.open(info) as stream:
                            heads.append(stream.read(sample_bytes))
                        names.append(info.filename)
                        places.append(nth)
                        sizes.append(info.file_size)
                if names:
                    yield pa.record_batch(
                        [
                            pa.array([entity] * len(names), pa.string()),
                            pa.array([path] * len(names), pa.string()),
                            pa.array([origin] * len(names), pa.string()),
                            pa.array(names, pa.string()),
                            pa.array(places, pa.int32()),
                            pa.array(sizes, pa.int64()),
                            pa.array(heads, pa.binary()),
                        ],
                        names=["entity", "path", "archive", "entry", "nth", "size", "head"],
                    )

    entity = F.col("entity") if "entity" in archives.columns else F.lit(UNCLASSIFIED)
    origin = F.col("archive") if "archive" in archives.columns else base_name("path")
    named = archives.select(entity.alias("entity"), "path", origin.alias("archive"))
    return named.mapInArrow(read_directories, _ENTRY)


def packed(entries: DataFrame, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, int]:
    """The entries with a task number each in ``_task``, and how many tasks there are.

    An entry of ``task_bytes`` or more has a task of its own; smaller ones fill tasks of about that size, so tasks
    grow with bytes and not with entries. Numbers are running sums within fixed groups of entries, and only a group's
    totals go to the driver.
    """
    large = F.col("size") >= task_bytes
    small = F.when(large, 0).otherwise(F.col("size"))
    grouped = entries.withColumn("_group", F.pmod(F.xxhash64("path", "nth"), F.lit(PACK_GROUPS)).cast("int"))
    totals = grouped.groupBy("_group").agg(F.count_if(large).alias("large"), F.sum(small).alias("small"))
    bases, tasks = {}, 0
    for group, alone, shared in sorted(totals.collect()):
        bases[group] = (tasks, tasks + alone)
        tasks += alone + shared // task_bytes + 1
    if not tasks:
        return grouped.withColumn("_task", F.lit(0)).drop("_group"), 1
    before = Window.partitionBy("_group").orderBy("path", "nth").rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    base = lambda i: F.create_map(*[F.lit(v) for g, b in bases.items() for v in (g, b[i])])[F.col("_group")]
    alone, shared = base(0) + summed(large.cast("int")), base(1) + F.floor(summed(small) / task_bytes)
    numbered = grouped.withColumn("_task", F.when(large, alone).otherwise(shared).cast("int"))
    return numbered.drop("_group"), tasks


def expand_entries(
    entries: DataFrame,
    encoding: str = "ISO-8859-1",
    chunk_bytes: int = 1 << 20,
    opener: Callable | None = None,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Contents of the entries as numbered blocks of whole lines, as raw bytes.

    Memory per task is one block, or one line where a line is longer. Entries are dealt to tasks by ``packed``, which
    reads ``entries`` twice; store them if there are many. The separator is detected per entry, from its first bytes.
    """
    open_path = opener or file_opener()
    delimiter = separator_of(F.decode("head", encoding))
    names = F.create_map(*[F.lit(v) for pair in DELIMITER_NAMES.items() for v in pair])
    wanted = entries.select("path", "entity", "archive", "entry", "nth", "size", names[delimiter].alias("delimiter"))
    work, tasks = packed(wanted, task_bytes)

    def inflate(batches):
        import zipfile

        import pyarrow as pa

        def block(origin, number, content):
            columns = [pa.array([v], pa.int32() if isinstance(v, int) else pa.string()) for v in origin.values()]
            columns += [pa.array([number], pa.int32()), pa.array([content], pa.binary())]
            return pa.record_batch(columns, names=[*origin, "chunk", "content"])

        for batch in batches:
            for path, entity, name, entry, nth, delimiter in zip(*[c.to_pylist() for c in batch.columns]):
                origin = {
                    "path": path,
                    "_entity": entity,
                    "_archive": name,
                    "_entry": entry,
                    "_delimiter": delimiter,
                    "nth": nth,
                }
                with (
                    open_path(path) as handle,
                    zipfile.ZipFile(handle) as archive,
                    archive.open(archive.infolist()[nth]) as stream,
                ):
                    number, pending = 0, []
                    while data := stream.read(chunk_bytes):
                        cut = data.rfind(b"\n")
                        if cut < 0:
                            pending.append(data)
                            continue
                        yield block(origin, number, b"".join([*pending, data[:cut]]))
                        number, pending = number + 1, [data[cut + 1 :]]
                    rest = b"".join(pending)
                    if rest:
                        yield block(origin, number, rest)

    dealt = work.repartitionById(tasks, "_task")
    return dealt.select("path", "entity", "archive", "entry", "nth", "delimiter").mapInArrow(inflate, _CHUNK)


def entry_lines(chunks: DataFrame, encoding: str = "ISO-8859-1") -> DataFrame:
    """Decoded lines of expanded blocks, numbered within their block; split in the JVM."""
    text = F.decode("content", encoding)
    lines = chunks.select("_archive", "_entry", "nth", "chunk", F.posexplode(F.split(text, "\n")).alias("line", "value"))
    return lines.withColumn("value", F.rtrim("value", F.lit("\r")))
