"""Column expressions over file names, URLs and request fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: name given to a download whose URL has no last segment.
UNNAMED_FILE = "file.bin"

# Fixed value: what stands between a table's name and the run's in the name of a staging table.
STAGING = "_stg_"

# A table's name, perhaps after that of its schema.
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(c: str | Column) -> Column:
    """Last ``/`` segment of a path."""
    return F.substring_index(_col(c), "/", -1)


def url_basename(c: str | Column) -> Column:
    """File name of a URL: query cut off, trailing slashes dropped, last segment, never empty."""
    name = base_name(F.rtrim(F.substring_index(_col(c), "?", 1), F.lit("/")))
    return F.when(name == "", F.lit(UNNAMED_FILE)).otherwise(name)


def normalise_prefix(c: str | Column) -> Column:
    """The prefix with exactly one trailing slash."""
    return F.concat(F.rtrim(_col(c), F.lit("/")), F.lit("/"))


def landing_target(prefix: str | Column, url: str | Column) -> Column:
    """Where a URL lands below a prefix."""
    return F.concat(normalise_prefix(prefix), url_basename(url))


def uri_parts(c: str | Column, scheme: str | None = None, strict: bool = False) -> Column:
    """``scheme://container/object`` as a struct; no match is NULL, or an error when ``strict``."""
    uri = _col(c)
    pattern = f"^({scheme or '[A-Za-z][A-Za-z0-9+.-]*'})://([^/]+)/(.+)$"
    parts = F.struct(
        F.regexp_extract(uri, pattern, 1).alias("scheme"),
        F.regexp_extract(uri, pattern, 2).alias("container"),
        F.regexp_extract(uri, pattern, 3).alias("object"),
    )
    matched = F.when(uri.rlike(pattern), parts)
    if not strict:
        return matched
    return matched.otherwise(F.raise_error(F.concat(F.lit("not an object URI: "), F.coalesce(uri, F.lit("NULL")))))


def classify_name(c: str | Column, rules: Mapping[str, Sequence[str]]) -> Column:
    """Entity of the first rule one of whose words occurs in the name, ignoring case; else NULL."""
    name = F.lower(_col(c))
    picked = None
    for entity, words in rules.items():
        hit = reduce(lambda a, b: a | b, [name.contains(w.lower()) for w in words])
        picked = F.when(hit, F.lit(entity)) if picked is None else picked.when(hit, F.lit(entity))
    return picked


def staging_table(table: str | Column, run_id: str | Column) -> Column:
    """Name of the staging table of a run: a dash in the run id becomes an underscore; NULL if that is no plain identifier."""
    plain = lambda c: F.when(c.rlike(f"^(?:{IDENTIFIER})\\z"), c)
    return plain(F.concat(plain(_col(table)), F.lit(STAGING), F.translate(_col(run_id), "-", "_")))


def first_missing(fields: Mapping[str, Column] | Sequence[str]) -> Column:
    """Name of the first required field that is NULL or empty text; NULL when all are present."""
    columns = fields if isinstance(fields, Mapping) else {f: F.col(f) for f in fields}
    return F.coalesce(
        *[F.when(c.isNull() | (c.cast("string") == F.lit("")), F.lit(name)) for name, c in columns.items()]
    )
