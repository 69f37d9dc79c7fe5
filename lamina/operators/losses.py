"""Values that a cast turns into NULL, counted in the write that casts them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lamina.operators.guards import ExpectationError


@dataclass(frozen=True)
class Losses:
    """Per column how many values were set before the cast, and how many of them are NULL after it."""

    set: dict[str, int]
    lost: dict[str, int]

    def share(self, column: str) -> float:
        return self.lost[column] / self.set[column] if self.set[column] else 0.0

    def require(self, most: float | Mapping[str, float]) -> Losses:
        """Raise if a column has lost more than a share, one for all columns or one for each that is named."""
        limits = most if isinstance(most, Mapping) else dict.fromkeys(self.lost, most)
        over = {c: f"{self.lost[c]} of {self.set[c]}" for c, limit in limits.items() if self.share(c) > limit}
        if over:
            raise ExpectationError(f"values lost by casts: {over}")
        return self


class WatchedCasts:
    """Columns replaced by casts of themselves. ``losses()`` is known once ``rows`` has been written or counted in full.

    ``rows`` is to be used by one action. A blank text is not set, so it may become NULL; a value of another type is set unless it is NULL.
    """

    def __init__(self, df: DataFrame, casts: Mapping[str, Column]):
        self._seen = Observation()
        self._columns = list(casts)
        texts = {f.name for f in df.schema if f.dataType.typeName() == "string"}
        given = {c: F.coalesce(F.btrim(c, F.lit(" \t\r\n")) != "", F.lit(False)) if c in texts else F.col(c).isNotNull() for c in casts}
        marks = {f"_given_{i}": given[c] for i, c in enumerate(casts)}
        cast = df.withColumns(marks).withColumns(dict(casts))
        counts = []
        for i, c in enumerate(casts):
            counts += [F.count_if(F.col(f"_given_{i}")).alias(f"set_{i}"), F.count_if(F.col(f"_given_{i}") & F.col(c).isNull()).alias(f"lost_{i}")]
        self.rows = cast.observe(self._seen, *counts).drop(*marks) if counts else cast

    def losses(self) -> Losses:
        found = self._seen.get if self._columns else {}
        many = lambda kind: {c: found.get(f"{kind}_{i}") or 0 for i, c in enumerate(self._columns)}
        return Losses(many("set"), many("lost"))
