"""Rows without a parent, left out before they are shuffled.

A left join needs the summaries of those children only whose parent is in the table, but which these are is known after
the shuffle at the earliest; Spark's own runtime filters do not serve the right side of a left join. So the parents' keys are
put into a Bloom filter first, of a size that is bounded whatever their number: a table of blocks of 32,768 bits, each key
with two bits of one block. Children meet it in a broadcast join below the partial aggregate. A key
that is no parent's may pass, a parent's key never fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lamina.operators.joins import key_columns
from lamina.operators.keys import as_list
from lamina.session import scratch_dir

# Bits of a block, most blocks of a filter (32 MB of bits), bits per key that are aimed at, and the share of bits set beyond which it is not
# worth its join: a quarter of the orphans pass there.
BLOCK_BITS = 32_768
MOST_BLOCKS = 8_192
BITS_PER_KEY = 16
SATURATED = 0.5


@dataclass(frozen=True)
class KeyFilter:
    """``blocks``: (block, bits), stored; ``many`` of them are addressed; ``fill`` is the share of bits that are set."""

    blocks: DataFrame
    many: int
    fill: float


def _places(keys: Sequence[Column], blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its two bits there."""
    hashed = F.xxhash64(*keys)
    block = F.pmod(hashed, F.lit(blocks)).cast("int")
    # Other parts of the same hash, mixed once more.
    mixed = F.xxhash64(hashed, F.lit(1))
    bits = [F.pmod(F.shiftrightunsigned(mixed, s), F.lit(BLOCK_BITS)).cast("long") for s in (0, 32)]
    return block, bits


def key_filter(parent: DataFrame, child: DataFrame, key: str | Sequence[str], most_blocks: int = MOST_BLOCKS) -> KeyFilter | None:
    """The filter of the parents' keys, or None if the keys' types cannot be hashed alike.

    One scan of the key columns counts them, another sets the bits, by one aggregate whose result has ``most_blocks`` rows of
    4 KB at most.
    """
    names = as_list(key)
    keys = key_columns(parent, child, names)
    if keys is None:
        return None
    known = parent.select(*names).dropna()
    wanted = -(-known.count() * BITS_PER_KEY // BLOCK_BITS)
    blocks = max(1, min(most_blocks, 1 << max(0, wanted - 1).bit_length()))
    block, bits = _places(keys, blocks)
    single = known.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    built = single.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    seen, place = Observation(), scratch_dir(parent.sparkSession, "key-filter")
    # As an array of bytes a bit is found by position.
    byte = lambda i: F.conv(F.hex(F.substring("_bitmap", i, F.lit(1))), 16, 10).cast("smallint")
    table = built.observe(seen, F.sum(F.bitmap_count("_bitmap")).alias("set")).select(
        "_block", F.transform(F.sequence(F.lit(1), F.lit(BLOCK_BITS // 8)), byte).alias("_bytes")
    )
    table.write.parquet(place)
    stored = parent.sparkSession.read.schema(table.schema).parquet(place)
    return KeyFilter(stored, blocks, (seen.get["set"] or 0) / (blocks * BLOCK_BITS))


def drop_orphans(child: DataFrame, parent: DataFrame, key: str | Sequence[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows of ``child`` that may have a parent; of the others few are left, and rows with a NULL key none.

    Where so many parents are known that most bits of the filter are set, or keys are of types that hash differently, all rows stay.
    The filter is built when this is called, what it does to the child is lazy.
    """
    names = as_list(key)
    built = key_filter(parent, child, names, most_blocks)
    if built is None or built.fill > SATURATED:
        return child
    keys = key_columns(child, parent, names)
    block, bits = _places(keys, built.many)
    joined = child.withColumns({"_block": block, "_first": bits[0], "_second": bits[1]})
    for name in names:
        joined = joined.filter(F.col(name).isNotNull())
    # At most MOST_BLOCKS rows of 8 KB.
    met = joined.join(F.broadcast(built.blocks), "_block")

    def is_set(bit: str) -> Column:
        octet = F.get("_bytes", F.shiftright(bit, 3).cast("int"))
        return F.getbit(octet, (F.col(bit) % 8).cast("int")) == 1

    return met.filter(is_set("_first") & is_set("_second")).select(*child.columns)
