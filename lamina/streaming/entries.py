"""Archives as a streaming source: batches of entries of a bounded size, as archives arrive.

``land_archives_stream`` takes all that has arrived at once. Here what has arrived is cut into steps whose inflated size is
bounded, and a micro-batch is a step, so a backlog is worked off in pieces that fit the cluster.

A step is planned from names: archives are taken in order of their names, their directories are read until the step is
full, and the entries are packed into partitions. The step is stored in a folder before it is offered, so the offset of
the stream is its number, a batch that is replayed reads the entries that it read before, and a name is planned
once. An archive may be spread over steps; the last step tells where it goes on.

The source is made of local classes over the standard library and Arrow, so executors need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lamina.sources.archives import TASK_BYTES, file_opener

# Inflated bytes of the entries of one batch.
BATCH_BYTES = 64 << 30

# Bytes that an entry counts as at least, so that the number of small ones in a step is bounded too.
ENTRY_BYTES = 4096

CHUNKS = "path string, _archive string, _entry string, nth int, chunk int, content binary"


def _entry_source(open_path: Callable) -> type[DataSource]:
    class Entries(InputPartition):
        def __init__(self, entries):
            self.entries = entries

    class Folder:
        """Files of a folder through Arrow, whatever its file system."""

        def __init__(self, path):
            from pyarrow import fs

            self.path = path.rstrip("/")
            place = self.path if "://" in path else "file://" + "/" + self.path.removeprefix("file:").lstrip("/")
            self.system, self.inner = fs.FileSystem.from_uri(place)

        def names(self, suffix):
            """Names below the folder that end in the suffix, ignoring case; none where it is missing."""
            from pyarrow import fs

            found = self.system.get_file_info(fs.FileSelector(self.inner, recursive=True, allow_not_found=True))
            below = [f.path[len(self.inner) :].lstrip("/") for f in found if f.type == fs.FileType.File]
            return sorted(n for n in below if n.lower().endswith(suffix.lower()))

        def read(self, name):
            import json

            with self.system.open_input_stream(f"{self.inner}/{name}") as handle:
                return json.loads(handle.read())

        def store(self, name, value):
            """The file is there as a whole or not at all."""
            import json

            self.system.create_dir(self.inner, recursive=True)
            with self.system.open_output_stream(f"{self.inner}/{name}.part") as out:
                out.write(json.dumps(value).encode())
            self.system.move(f"{self.inner}/{name}.part", f"{self.inner}/{name}")

    class EntryReader(DataSourceStreamReader):
        def __init__(self, options):
            self.raw, self.plan = options["path"], options["plan"]
            self.suffix, self.entry_suffix = options["archivesuffix"], options["entrysuffix"].lower()
            self.batch_bytes, self.task_bytes = int(options["batchbytes"]), int(options["taskbytes"])
            self.chunk_bytes = int(options["chunkbytes"])
            # Names of the archives that were planned, once the steps have been read, and the last step.
            self.known, self.last, self.rest = None, 0, None

        @staticmethod
        def _name(step):
            return f"step-{step:010d}.json"

        def initialOffset(self):  # noqa: N802
            return {"step": 0}

        def latestOffset(self):  # noqa: N802
            """Plans one more step if there is something to plan.

            The engine asks again once the step it was told of is done, so a batch is one step. After a restart it may be
            two: one that was planned and not begun, and this one.
            """
            steps = Folder(self.plan)
            if self.known is None:
                self.known = set()
                for name in steps.names(".json"):
                    step = steps.read(name)
                    self.known.update(step["archives"])
                    self.last, self.rest = step["step"], step["rest"]
            new = [n for n in Folder(self.raw).names(self.suffix) if n not in self.known]
            entries, archives, rest = self._step(new)
            if archives:
                step = {"step": self.last + 1, "archives": archives, "entries": entries, "rest": rest}
                steps.store(self._name(self.last + 1), step)
                self.last, self.rest = self.last + 1, rest
                self.known.update(archives)
            return {"step": self.last}

        def _step(self, new):
            """Entries up to the bound, one at least; the archives begun in it; where the last one goes on."""
            import zipfile

            entries, archives, taken = [], [], 0
            open_ = [] if self.rest is None else [tuple(self.rest)]
            for name, begin in [*open_, *((n, 0) for n in new)]:
                path = f"{Folder(self.raw).path}/{name}"
                archives.append(name)
                with open_path(path) as handle, zipfile.ZipFile(handle) as archive:
                    infos = archive.infolist()
                for nth in range(begin, len(infos)):
                    info = infos[nth]
                    if info.is_dir() or not info.filename.lower().endswith(self.entry_suffix):
                        continue
                    size = max(info.file_size, ENTRY_BYTES)
                    if entries and taken + size > self.batch_bytes:
                        return entries, archives, [name, nth]
                    entries.append([path, name, info.filename, nth, size])
                    taken += size
                if taken >= self.batch_bytes:
                    break
            return entries, archives, None

        def partitions(self, start, end):
            """Large entries alone, smaller ones together up to the bytes of a task."""
            steps, parts, filled = Folder(self.plan), [], None
            for number in range(start["step"] + 1, end["step"] + 1):
                for *entry, size in steps.read(self._name(number))["entries"]:
                    if filled is None or filled + size > self.task_bytes:
                        parts.append([])
                        filled = 0
                    parts[-1].append(entry)
                    filled += size
            return [Entries(p) for p in parts]

        def read(self, partition):
            import zipfile

            import pyarrow as pa

            def block(origin, number, content):
                path, archive, entry, nth = origin
                strings = [pa.array([v], pa.string()) for v in (path, archive, entry)]
                numbers = [pa.array([v], pa.int32()) for v in (nth, number)]
                names = ["path", "_archive", "_entry", "nth", "chunk", "content"]
                return pa.record_batch([*strings, *numbers, pa.array([content], pa.binary())], names=names)

            for origin in partition.entries:
                path, _, entry, nth = origin
                with open_path(path) as handle, zipfile.ZipFile(handle) as archive:
                    infos = archive.infolist()
                    if nth >= len(infos) or infos[nth].filename != entry:
                        raise ValueError(f"{path} was replaced after it was planned: {entry} is not its entry {nth}")
                    with archive.open(infos[nth]) as stream:
                        number, pending = 0, []
                        while data := stream.read(self.chunk_bytes):
                            cut = data.rfind(b"\n")
                            if cut < 0:
                                pending.append(data)
                                continue
                            yield block(origin, number, b"".join([*pending, data[:cut]]))
                            number, pending = number + 1, [data[cut + 1 :]]
                        rest = b"".join(pending)
                        if rest:
                            yield block(origin, number, rest)

    class EntrySource(DataSource):
        @classmethod
        def name(cls):
            return "archive_entries"

        def schema(self):
            return CHUNKS

        def streamReader(self, schema):  # noqa: N802
            return EntryReader({k.lower(): v for k, v in self.options.items()})

    return EntrySource


def entry_stream(
    spark: SparkSession,
    raw: str,
    plan: str,
    batch_bytes: int = BATCH_BYTES,
    task_bytes: int = TASK_BYTES,
    chunk_bytes: int = 1 << 20,
    archive_suffix: str = ".zip",
    entry_suffix: str = ".csv",
    opener: Callable | None = None,
) -> DataFrame:
    """Blocks of whole lines of the entries below ``raw``, as ``expand_entries`` gives them, as archives arrive.

    A batch holds entries of ``batch_bytes`` inflated bytes at most, or one entry where that is larger, and a task
    ``task_bytes`` of them. ``plan`` is a folder of the stream's own that its driver and nobody else writes, as with a checkpoint;
    the two belong together. An archive is its name below ``raw`` and is taken once; one that is replaced while its batch is
    read stops the stream. A missing folder, and an archive without such an entry, give nothing. An archive is to
    appear as a whole (moved to its name), as one without a readable directory stops the stream.

    Names of archives are kept by the driver, as Spark's own file source does; directories are read there, those of one step
    at a time.
    """
    spark.dataSource.register(_entry_source(opener or file_opener(read_ahead=1 << 16)))
    options = {"plan": plan, "archiveSuffix": archive_suffix, "entrySuffix": entry_suffix}
    sizes = {"batchBytes": str(batch_bytes), "taskBytes": str(task_bytes), "chunkBytes": str(chunk_bytes)}
    return spark.readStream.format("archive_entries").options(**options, **sizes).load(raw)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append batch after batch to a Parquet table until nothing is left.

    For sources that bound their batches: these hand out one batch where all that is available is asked for at once.
    """
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
