"""Summaries that are kept up to date by additions and retractions.

A key's state is a number of rows and sums over them. Adding rows adds to it and taking rows back subtracts, in any
order, so a batch of changes is summed by key first and touches the states of its own keys only. A flag such as "any row matches" is the
sign of a count of matches, since a flag alone could not be taken back; a maximum cannot be kept this way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lamina.operators.keys import as_list

ROWS = "n_rows"
BATCH = "_batch"


def state_changes(changes: DataFrame, key: str | Sequence[str], sign: Column, **sums: Column) -> DataFrame:
    """One row per key: by how much its number of rows and each of ``sums`` change.

    ``sign`` is 1 for a row that is added and -1 for one that is taken back. What is NULL counts as 0. Partial sums are made before the
    shuffle, so a hot key sends one row per task.
    """
    signed = {name: F.sum(F.coalesce(value, F.lit(0)) * sign).alias(name) for name, value in sums.items()}
    return changes.groupBy(*as_list(key)).agg(F.sum(sign).cast("long").alias(ROWS), *signed.values())


def matches(predicate: Column) -> Column:
    """1 where the predicate holds, else 0: a flag as something that can be added and taken back."""
    return F.coalesce(predicate, F.lit(False)).cast("long")


def merged_states(stored: DataFrame, changes: DataFrame, key: str | Sequence[str], batch: int) -> DataFrame:
    """The stored states with the changes of ``batch`` added, in the columns of ``stored``, ``_batch`` among them.

    A state remembers the last batch that changed it, and a batch that a state has seen does nothing to it. So a batch may be done again after a failure; batches
    come in the order of their numbers. States whose rows have all been taken back stay, with 0 rows. One join, of one row per key
    on either side; keys that are NULL are a key like any other.
    """
    keys = as_list(key)
    numbers = [c for c in changes.columns if c not in keys]
    rest = [c for c in stored.columns if c not in (*keys, *numbers, BATCH)]
    old = stored.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)], F.struct(*numbers, BATCH, *rest).alias("_old"))
    new = changes.withColumn("_new", F.struct(*numbers)).select(*keys, "_new")
    same = [F.col(f"_key{i}").eqNullSafe(F.col(c)) for i, c in enumerate(keys)]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    both = old.join(new, condition, "full_outer")
    seen = F.col("_old").isNotNull() & (F.col(f"_old.{BATCH}") >= batch)
    moved = F.col("_new").isNotNull() & ~seen

    def number(name: str) -> Column:
        before = F.coalesce(F.col(f"_old.{name}"), F.lit(0))
        return F.when(moved, before + F.coalesce(F.col(f"_new.{name}"), F.lit(0))).otherwise(before).cast(stored.schema[name].dataType).alias(name)

    known = {k: F.when(F.col("_old").isNotNull(), F.col(f"_key{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)}
    columns = {
        **known,
        **{c: number(c) for c in numbers},
        **{c: F.col(f"_old.{c}").alias(c) for c in rest},
        BATCH: F.when(moved, F.lit(batch).cast("long")).otherwise(F.col(f"_old.{BATCH}")).alias(BATCH),
    }
    return both.select(*[columns[c] for c in stored.columns])
