"""Column expressions over field values. All of them stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType

# Candidate separators in tie order, and the one used when none occurs.
SEPARATORS = ("|", ";", ",")
DEFAULT_SEPARATOR = ";"

# What a cast accepts as an integer, and how anything it accepts as a number begins. A failed cast
# costs an exception; text that cannot succeed is turned away before.
_INTEGER = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"
_NUMBER_START = r"^[\s\p{Cntrl}]*[+-]?[.0-9IiNn]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_comma(c: str | Column, thousands: str | None = None, to: DataType | None = None) -> Column:
    """Text with a decimal comma to a number; anything that is not a number becomes NULL.

    ``thousands`` names a grouping mark to strip first (``1.000,50``); without it such text is NULL.
    ``to`` may be a ``DecimalType`` where money must not be a double.
    """
    text = _col(c)
    if thousands:
        text = F.replace(text, F.lit(thousands), F.lit(""))
    number = F.replace(text, F.lit(","), F.lit("."))
    return F.when(number.rlike(_NUMBER_START), number.try_cast(to or DoubleType()))


def code_int(c: str | Column) -> Column:
    """Text code to int. A code is an integer or unknown: ``12.7`` and ``1e3`` are NULL."""
    text = _col(c)
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def separator_of(
    c: str | Column,
    candidates: Sequence[str] = SEPARATORS,
    default: str = DEFAULT_SEPARATOR,
) -> Column:
    """The most frequent candidate character; ties go to the earlier one, none at all to ``default``."""
    text = _col(c)

    def ranked(count: Column, rank: int, s: str) -> Column:
        return F.struct(count.alias("n"), F.lit(rank).alias("rank"), F.lit(s).alias("sep"))

    def occurrences(s: str) -> Column:
        without = F.octet_length(F.replace(text, F.lit(s), F.lit("")))
        return ((F.octet_length(text) - without) / len(s.encode())).cast("int")

    # Rank decides between equal counts; the default outranks every candidate that does not occur.
    options = [ranked(occurrences(s), -i, s) for i, s in enumerate(candidates)]
    return F.greatest(ranked(F.lit(0), 1, default), *options)["sep"]


def row_count() -> Column:
    """Rows per group, null or not, as bigint."""
    return F.count(F.lit(1))


def any_match(predicate: Column) -> Column:
    """Aggregate: true if any row of the group matches; a null predicate is no match."""
    return F.bool_or(F.coalesce(predicate, F.lit(False)))


def target_rule(code: str | Column, wanted: str, count: str | Column, more_than: int = 1) -> Column:
    """True iff the code is the wanted one and the count exceeds the bound; never NULL."""
    return F.coalesce((_col(code) == F.lit(wanted)) & (_col(count) > F.lit(more_than)), F.lit(False))
