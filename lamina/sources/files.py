"""Listing files and deciding which entity each one holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from lamina.functions.names import base_name, classify_name
from lamina.sources.tables import load_if_present, rows_of

_LISTING = StructType(
    [
        StructField("path", StringType()),
        StructField("archive", StringType()),
        StructField("uri", StringType()),
        StructField("name", StringType()),
        StructField("length", LongType()),
        StructField("modified", TimestampType()),
    ]
)


def path_below(c: str | Column, root: str) -> Column:
    """The part of a path below ``root``, whether or not either names the file system; else the base name."""
    bare = lambda path: F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/+", "/")
    path, start = bare(F.col(c) if isinstance(c, str) else c), F.concat(F.rtrim(bare(F.lit(root)), F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, start), F.substring(path, F.length(start) + 1, F.length(path))).otherwise(base_name(path))


def list_files(spark: SparkSession, root: str | Sequence[str], suffix: str = "") -> DataFrame:
    """Files below ``root`` whose name ends in ``suffix``, ignoring case.

    ``archive`` is the path below the root, the base name for explicitly named files; ``uri`` is the path as scans
    report it. Names and sizes only: file contents are pruned from the scan. A missing root lists nothing;
    explicitly named files must exist.
    """
    options = {"recursiveFileLookup": "true"}
    if isinstance(root, str):
        files = load_if_present(spark, root, "binaryFile", options)
        if files is None:
            return rows_of(spark, _LISTING)
    else:
        files = spark.read.format("binaryFile").options(**options).load(sorted(set(root)))
    below = path_below("path", root) if isinstance(root, str) else base_name("path")
    uri = F.col("_metadata.file_path").alias("uri")
    listed = files.select(
        "path", below.alias("archive"), uri, base_name("path").alias("name"), "length", F.col("modificationTime").alias("modified")
    )
    return listed.filter(F.lower("name").endswith(suffix.lower())) if suffix else listed


def bytes_of(spark: SparkSession, *paths: str) -> int:
    """Size of the files below the paths, from their listing."""
    return sum(list_files(spark, p).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] for p in paths)


def classify_archives(
    files: DataFrame, rules: Mapping[str, Sequence[str]], positional: Sequence[str] = ()
) -> DataFrame:
    """Adds ``entity`` by file name and drops files of no entity.

    If no name matches and there are exactly as many files as ``positional`` entities, they are
    assigned in path order. One summary row decides that, whatever the number of files.
    """
    tagged = files.withColumn("entity", classify_name("name", rules))
    known = tagged.filter(F.col("entity").isNotNull())
    if not positional:
        return known
    seen = tagged.agg(F.count(F.lit(1)).alias("n"), F.count("entity").alias("matched")).first()
    if seen["matched"] or seen["n"] != len(positional):
        return known
    paths = [r["path"] for r in files.select("path").sort("path").take(len(positional))]
    by_path = F.create_map(*[F.lit(v) for pair in zip(paths, positional) for v in pair])
    return files.withColumn("entity", by_path[F.col("path")])


def resolve_archives(
    spark: SparkSession,
    roots: Sequence[str],
    rules: Mapping[str, Sequence[str]],
    explicit: Mapping[str, Sequence[str]] | None = None,
    suffix: str = ".zip",
) -> tuple[DataFrame, str]:
    """Classified archives and where they were found.

    Explicit paths per entity win; else the first root in which at least one archive gets an
    entity, falling back on position when nothing matches; else this raises.
    """
    named = {entity: list(paths) for entity, paths in (explicit or {}).items() if paths}
    if named:
        tables = [
            list_files(spark, paths).withColumn("entity", F.lit(entity)) for entity, paths in named.items()
        ]
        archives = tables[0]
        for table in tables[1:]:
            archives = archives.unionByName(table)
        return archives, "explicit"
    for root in roots:
        archives = classify_archives(list_files(spark, root, suffix), rules, positional=tuple(rules))
        if not archives.isEmpty():
            return archives, root
    raise FileNotFoundError(f"no {suffix} archive of a known entity in {list(roots)}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a manifest file, one per line; blank lines are skipped."""
    lines = spark.read.text(path).select(F.btrim("value", F.lit(" \t\r\n")).alias("url"))
    return lines.filter(F.col("url") != "")
