"""Token ids as flat binary files.

A data set is a folder of parts. ``part-N.bin`` holds the ids of the part's documents one after the
other, as unsigned 16-bit integers where the vocabulary allows, else 32-bit, little-endian; ``part-N.idx`` holds 64-bit
offsets into it, one more than documents; ``part-N.ids`` the 64-bit document ids. The table ``bases`` names each
part's first document and id: the sums over the parts before it. Files are memory-mapped for reading.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lamina.llm.common import small_batches, worker_cache
from lamina.llm.files import mapped, written
from lamina.llm.tokens import Encoder, Memory
from lamina.session import scratch_dir

# Bytes of text of one part.
PART_BYTES = 32 << 20

# Ids that a reader checks at a time.
READ_IDS = 1 << 22


@dataclass(frozen=True)
class TokenFiles:
    """A written data set: its folder, and the integer type of the ids."""

    path: str
    kind: str


def write_tokens(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    path: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
) -> TokenFiles:
    """Encode every text, append ``end_id`` to each, and write the ids in ascending order of ``doc_id``.

    A NULL text is empty, and so has the end id only. Rows with equal ids are ordered by a hash of their text; NULL ids
    come first and are stored as the smallest number. An empty table gives no parts.

    The documents are dealt by ranges of their id and sorted within these, so parts follow each other
    and tasks write side by side. A part's files appear under their names when they are complete;
    a task that runs again writes the same bytes.
    """
    from tokenizers import Tokenizer

    small_batches(docs.sparkSession)
    path = path or scratch_dir(docs.sparkSession, "tokens")
    largest = max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1)
    kind = "<u2" if largest <= 1 << 16 else "<u4"

    def write(batches):
        from array import array

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        stored = "H" if kind == "<u2" else "I"
        memory = worker_cache("tokens", f"{vocabulary} {stored}", lambda: Memory(Encoder(vocabulary), stored))
        end = array(stored, [end_id]).tobytes()
        width = np.dtype(kind).itemsize
        names, counts = [], []
        name = f"{path}/part-{part:06d}"
        with written(f"{name}.bin") as handle:
            for batch in batches:
                names += batch.column(0).to_pylist()
                for value in batch.column(1).to_pylist():
                    line = memory.packed(value) + end if value else end
                    handle.write(line)
                    counts.append(len(line) // width)
        if not names:
            return
        offsets = np.zeros(len(counts) + 1, "<i8")
        np.cumsum(counts, out=offsets[1:])
        for suffix, values in (("idx", offsets), ("ids", np.array(names, "<i8"))):
            with written(f"{name}.{suffix}") as handle:
                handle.write(values.tobytes())
        columns = [pa.array([x], pa.int64()) for x in (part, len(names), int(offsets[-1]))]
        yield pa.record_batch(columns, names=["part", "docs", "ids"])

    numbered = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("id"), F.col(text).alias("text"))
    if parts is None:
        size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = numbered.withColumn("hash", F.xxhash64("text"))
    order = ("id", "hash", "text")
    dealt = numbered.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order).select("id", "text")
    totals = dealt.mapInArrow(write, "part long, docs long, ids long")
    totals.write.parquet(f"{path}/totals")
    # One row per part. The window runs over these rows only.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"first_{c[:-1]}") for c in ("docs", "ids")]
    bases = docs.sparkSession.read.parquet(f"{path}/totals").select("part", "docs", "ids", *sums)
    bases.coalesce(1).write.parquet(f"{path}/bases")
    return TokenFiles(path, kind)


def read_tokens(spark: SparkSession, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids before it), ``n_tokens``, ``ids_crc32``, and ``ids`` on request.

    ``ids_crc32`` is the checksum of the ids as unsigned 32-bit little-endian integers. A document whose id was
    NULL has NULL. Each task maps its parts' files; nothing is read but the ids themselves.
    """
    path, kind = files.path, files.kind
    tail = ", ids array<long>" if with_ids else ""

    def read(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{path}/part-{part:06d}"
                ids, offsets, names = mapped(f"{name}.bin", kind), mapped(f"{name}.idx", "<i8"), mapped(f"{name}.ids", "<i8")
                for i in range(0, len(names), 4096):
                    stops = offsets[i : i + 4097]
                    sums, values = [], []
                    for a, b in zip(stops[:-1].tolist(), stops[1:].tolist()):
                        crc = 0
                        for c in range(a, b, READ_IDS):
                            crc = zlib.crc32(ids[c : min(b, c + READ_IDS)].astype("<u4").tobytes(), crc)
                        sums.append(crc)
                        if with_ids:
                            values.append(ids[a:b].astype(np.int64))
                    own = names[i : i + 4096]
                    columns = [
                        pa.array(own, mask=own == -(2**63)),
                        pa.array(base + stops[:-1]),
                        pa.array(stops[1:] - stops[:-1]),
                        pa.array(sums, pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array(values, pa.list_(pa.int64())))
                    fields = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)]
                    yield pa.record_batch(columns, names=fields)

    bases = spark.read.parquet(f"{path}/bases").select("part", "first_id")
    dealt = bases.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + tail)
