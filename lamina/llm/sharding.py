"""Shards by rendezvous hashing, with DataFrame functions only.

A row goes to the shard with the greatest ``-weight / ln(u)``, where ``u`` in (0, 1) comes from a hash of the row's
key and the shard's number. A shard's share is its weight's, and a further shard takes rows
only into itself: nothing else about the other shards' scores changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.llm.common import stash

LAW = "key"

# Runs that the rows of a shard are numbered in, side by side.
RUNS = 64

# Copies of one row that are written out at a time.
COPIES = 10_000


def shard_of(key: Sequence[str | Column], weights: Sequence[float]) -> Column:
    """The shard of a key, 0 to ``len(weights) - 1``.

    The key's columns should not change over time; NULL is a value like any other. Of equal scores the
    greatest shard number wins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    columns = [F.col(c) if isinstance(c, str) else c for c in key]
    base = F.xxhash64(*columns, *[c.isNull() for c in columns])
    scores = []
    for shard, weight in enumerate(weights):
        draw = F.shiftrightunsigned(F.xxhash64(base, F.lit(shard)), 11)
        # The greatest draw would be rounded to 1, which has no logarithm to divide by.
        unit = F.least((draw.cast("double") + 0.5) / float(1 << 53), F.lit(1 - 2.0**-53))
        scores.append(F.struct((-F.lit(float(weight)) / F.ln(unit)).alias("score"), F.lit(shard).alias("shard")))
    return F.array_max(F.array(*scores))["shard"]


def shard_rows(
    docs: DataFrame,
    weights: Sequence[float],
    doc_id: str = "doc_id",
    text: str = "text",
    grown: Sequence[float] | None = None,
    runs: int = RUNS,
) -> DataFrame:
    """Shard and place of each row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 16, ``text_crc32`` their checksum; a NULL text has no
    bytes, like an empty one. ``slot`` numbers the rows of a shard from 0 without gaps. ``grown_shard`` is the
    shard under the weights ``grown``, by default with one more shard of the mean weight. Rows with equal ids
    share a shard, NULL being an id of its own. An empty table gives no rows.

    A shard is numbered in ``runs`` runs, dealt by a hash of the row: equal rows are counted before the shuffle, each run
    is numbered by itself and begins where the runs before it end. So neither a large shard nor a row
    that occurs very often is sorted in one task.
    """
    grown = [*weights, sum(weights) / len(weights)] if grown is None else grown
    octets = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(octets) + 16).cast("long").alias("size"), F.crc32(octets).alias("text_crc32")
    )
    once = plain.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    run = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(runs)).cast("int")
    placed = stash(once.withColumns({"shard": shard_of(["doc_id"], weights), "run": run}), "shards")
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards times runs rows, so this window is small and its result can be broadcast.
    totals = placed.groupBy("shard", "run").agg(F.sum("n").alias("rows"))
    bases = totals.select("shard", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "run").orderBy("doc_id", "size", "text_crc32")
    first = F.coalesce(F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("first", first).join(F.broadcast(bases), ["shard", "run"])
    blocks = numbered.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))))
    size = F.least(F.lit(COPIES).cast("long"), F.col("n") - F.col("block") * COPIES)
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    return copies.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("base") + F.col("first") + F.col("block") * COPIES + F.col("copy")).cast("long").alias("slot"),
        shard_of(["doc_id"], grown).alias("grown_shard"),
    )
