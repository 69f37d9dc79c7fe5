"""Records of delimited text whose quoted fields may hold line breaks, read by many tasks per file.

Whether a line break ends a record depends on the quotes before it, back to the file's first byte. A file is cut
into byte ranges all the same: each range first tells, for every state that it may begin in, the state that it
ends in. These small maps are put together along the file, which gives each range the state it does begin in, and then
the ranges are read side by side. A record belongs to the range that holds its first byte.

States: N before a record, S before another field, U in a field without quotes, Q in quotes, E after a quote within
quotes, which closes the field unless another follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType

from lamina.session import MOST_PARTITIONS, scratch_dir
from lamina.sources.archives import file_opener

STATES = "NSUQE"

# Bytes of a file that a task reads, records in a batch and bytes that end one.
RANGE_BYTES = 32 << 20
BATCH_ROWS = 10_000
BATCH_BYTES = 4 << 20


def scanner_maker() -> Callable:
    """A function that gives the functions for a separator; a closure, so that executors need no copy of this package."""

    def scanner(sep: str):
        """The state that a text ends in, where its first record begins, and the patterns of records and fields."""
        import re
        from collections import deque

        s = re.escape(sep.encode())
        stop = rb"[" + s + rb"\n]"
        field = rb'(?:"(?:[^"]++|"")*+(?:"|\Z))?+[^' + s + rb"\n]*+"
        fields = re.compile(rb"(?:" + field + s + rb")*+")
        record = re.compile(rb"(?:" + field + s + rb")*+" + field + rb"(\n)?")
        ends = re.compile(stop)
        quoted = re.compile(rb'(?:[^"]++|"")*+')

        def run(data, begin: int, state: str) -> str:
            """The end state of what follows a place before a field."""
            if begin == len(data):
                return state
            last = deque(record.finditer(data, begin, len(data)), maxlen=2)
            # The last match may be an empty one behind the last record.
            found = next(m for m in reversed(last) if m.end() > m.start() or m.start() == begin)
            if found.group(1):
                return "N"
            at = fields.match(data, found.start()).end()
            if at == len(data):
                return "S" if at > found.start() else state
            if data[at] != 34:
                return "U"
            close = quoted.match(data, at + 1).end()
            return "Q" if close == len(data) else "E" if close + 1 == len(data) else "U"

        def settle(data, state: str) -> tuple[int, str]:
            """The first place before a field or record, and which of the two; the end of the data with its state if there is none."""
            at = 0
            if state in "QE":
                if state == "E" and data[:1] != b'"':
                    state = "U" if len(data) else "E"
                elif len(data):
                    at = quoted.match(data, 0 if state == "Q" else 1).end()
                    state = "Q" if at == len(data) else "E" if at + 1 == len(data) else "U"
                    at += 1
            if state == "U":
                found = ends.search(data, at)
                if found:
                    return found.end(), "N" if found.group() == b"\n" else "S"
            return (0, state) if state in "NS" else (len(data), state)

        def ending(data) -> str:
            """The end state for each state to begin in, as a text in the order of ``STATES``."""
            known: dict[tuple[int, bool], str] = {}
            out = []
            for state in STATES:
                at, now = settle(data, state)
                if now in "NS" and at < len(data):
                    if at not in known:
                        known[at] = run(data, at, now)
                    now = known[at]
                out.append(now)
            return "".join(out)

        def first(data, state: str) -> int | None:
            """Where the first record begins that the data hold the first byte of, unless they may end before."""
            at, now = settle(data, state)
            if now == "N":
                return at
            if now != "S":
                return None
            found = record.match(data, at)
            return found.end() if found.group(1) else None

        return ending, first, record, re.compile(field + s)

    return scanner


def file_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The files of ``path`` and ``length`` cut into ranges: all columns, and ``begin``, ``stop``; empty files have none."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    cut = files.filter(F.col("length") > 0).withColumn("begin", F.explode(starts))
    return cut.withColumn("stop", F.least(F.col("length"), F.col("begin") + range_bytes))


def range_states(ranges: DataFrame, opener: Callable | None = None) -> DataFrame:
    """(path, begin, state): the state that each range of ``path, sep, begin, stop`` begins in.

    The maps of one file's ranges, a few bytes each, are put together by one task.
    """
    open_path, scanner = opener or file_opener(), scanner_maker()

    def maps(batches):
        import pyarrow as pa

        scanners: dict = {}
        for batch in batches:
            found = []
            for path, sep, begin, stop in zip(*(c.to_pylist() for c in batch.columns)):
                if sep not in scanners:
                    scanners[sep] = scanner(sep)[0]
                with open_path(path) as handle:
                    handle.seek(begin)
                    found.append(scanners[sep](handle.read(stop - begin)))
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.string())], names=["path", "begin", "map"])

    def along(table):
        import pyarrow as pa

        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("begin", "map"))))
        state, states = "N", []
        for _, ends in rows:
            states.append(state)
            state = ends[STATES.index(state)]
        path = [table.column("path")[0].as_py()] * len(rows)
        return pa.table([pa.array(path, pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array(states, pa.string())], names=["path", "begin", "state"])

    found = ranges.select("path", "sep", "begin", "stop").mapInArrow(maps, "path string, begin long, map string")
    return found.groupBy("path").applyInArrow(along, "path string, begin long, state string")


def read_records(
    files: DataFrame,
    columns: list[str],
    range_bytes: int = RANGE_BYTES,
    opener: Callable | None = None,
) -> DataFrame:
    """One row per record of the files: ``_line`` (bytes), ``_fields`` (how many), and the files' ``columns``.

    ``files`` holds a file per row: ``path``, ``length`` and the ``sep`` of its fields, one byte. A record ends at a
    line break outside quotes, which it does not include, nor a carriage return before it; quotes within quotes are doubled, and a quote elsewhere than around a
    field is a plain character, as Spark's own scan takes them. Encodings in which line break, quote and separator are
    single bytes are read. A record that is longer than a range is read by the task that holds its beginning.
    """
    spark = files.sparkSession
    place = scratch_dir(spark, "ranges")
    # Numbered and stored: each range is read by a task of its own, twice.
    order = Window.partitionBy(F.pmod(F.xxhash64("path"), F.lit(64))).orderBy("path", "begin")
    ranges = file_ranges(files, range_bytes).withColumn("_group", F.pmod(F.xxhash64("path"), F.lit(64)).cast("int"))
    ranges.withColumn("_nth", F.row_number().over(order) - 1).write.parquet(f"{place}/cut")
    cut = spark.read.parquet(f"{place}/cut")
    sizes = dict(cut.groupBy("_group").count().collect())
    starts, total = {}, 0
    for group in sorted(sizes):
        starts[group], total = total, total + sizes[group]
    if not total:
        kept = files.select(*columns).schema
        return spark.createDataFrame([], kept.add("_line", BinaryType()).add("_fields", IntegerType()))
    first_of = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    # Neighbouring ranges share a task where there are more of them than partitions should be.
    tasks = min(total, int(spark.conf.get("lamina.shuffle.mostPartitions", str(MOST_PARTITIONS))))
    number = first_of[F.col("_group")] + F.col("_nth")
    dealt = cut.withColumn("_task", F.floor(number * tasks / F.lit(total)).cast("int"))
    spread = dealt.repartitionById(tasks, "_task")
    range_states(spread, opener).write.parquet(f"{place}/states")
    states = spark.read.parquet(f"{place}/states")
    known = dealt.join(states, ["path", "begin"]).select("path", "sep", "begin", "stop", "length", "state", "_task", *[F.col(c).alias(f"_own_{c}") for c in columns])
    open_path, scanner = opener or file_opener(), scanner_maker()

    def read(batches):
        import pyarrow as pa

        def rows_of(batch, k):
            path, sep, begin, stop, length, state = (batch.column(c)[k].as_py() for c in range(6))
            _, first, record, single = scanner(sep)
            with open_path(path) as handle:
                handle.seek(begin)
                data = handle.read(stop - begin)
                own, place = len(data), begin + len(data)
                at = first(data, state)
                while at is not None and at < own:
                    found = record.match(data, at)
                    if not found.group(1) and place < length:
                        # The last record goes on; each time as much again is read.
                        more = handle.read(min(max(1 << 16, len(data) - at), length - place))
                        if not more:
                            break
                        data, place, own, at = data[at:] + more, place + len(more), own - at, 0
                        continue
                    end = found.end() - (1 if found.group(1) else 0)
                    line = data[at : end - 1] if data[end - 1 : end] == b"\r" and end > at else data[at:end]
                    yield line, len(single.findall(data, at, end)) + 1
                    at = found.end()

        def handed(lines, counts, batch, k):
            many = len(lines)
            same = [pa.array([batch.column(c)[k].as_py()] * many, batch.column(c).type) for c in range(7, batch.num_columns)]
            return pa.record_batch([*same, pa.array(lines, pa.binary()), pa.array(counts, pa.int32())], names=[*columns, "_line", "_fields"])

        for batch in batches:
            for k in range(batch.num_rows):
                lines, counts, held = [], [], 0
                for line, many in rows_of(batch, k):
                    lines.append(line)
                    counts.append(many)
                    held += len(line)
                    if len(lines) >= BATCH_ROWS or held > BATCH_BYTES:
                        yield handed(lines, counts, batch, k)
                        lines, counts, held = [], [], 0
                if lines:
                    yield handed(lines, counts, batch, k)

    schema = files.select(*columns).schema.add("_line", BinaryType()).add("_fields", IntegerType())
    return known.repartitionById(tasks, "_task").mapInArrow(read, schema)
