"""Delimited text without a header."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from lamina.functions.values import DEFAULT_SEPARATOR, SEPARATORS, separator_of
from lamina.operators.joins import lookup_join
from lamina.schemas import raw_schema
from lamina.session import scratch_dir, session_setting
from lamina.sources.archives import DELIMITER_NAMES, SAMPLE_BYTES, UNCLASSIFIED, file_opener
from lamina.sources.files import list_files
from lamina.sources.records import RANGE_BYTES, read_records
from lamina.sources.tables import load_if_present

ENCODING = "ISO-8859-1"


def _options(sep: str, encoding: str) -> dict[str, str]:
    return {
        "sep": sep,
        "header": "false",
        "inferSchema": "false",
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
    }


def _scan(
    reader: DataFrameReader,
    paths: Sequence[str],
    sep: str,
    schema: StructType | None = None,
    encoding: str = ENCODING,
    corrupt: str | None = None,
) -> DataFrame:
    reader = reader.options(**_options(sep, encoding))
    if corrupt:
        if schema is None:
            raise ValueError("rows of the wrong width can only be told with a schema")
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        # A scan of fewer columns would not see the width of a row.
        reader = reader.option("columnPruning", "false")
    if schema is not None:
        reader = reader.schema(schema)
    # Unlike a metadata column, this is pruned from the scan where it is not used.
    return reader.csv(list(dict.fromkeys(paths))).select("*", F.input_file_name().alias("_file"))


def _parse(lines: DataFrame, seps: Sequence[str], schema: StructType, corrupt: str | None) -> DataFrame:
    """The fields of ``_line``, each parsed with its ``_sep``, before the other columns."""
    wanted = schema if not corrupt else StructType([*schema.fields, StructField(corrupt, StringType())])
    options = {k: v for k, v in _options("", "").items() if k in ("quote", "escape")}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.coalesce(
        *[F.when(F.col("_sep") == s, F.from_csv("_line", wanted.toDDL(), {**options, "sep": s})) for s in seps]
    )
    rows = lines.withColumn("_row", parsed)
    rest = [c for c in lines.columns if c not in ("_line", "_sep", "_fields")]
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in wanted.fieldNames()], *rest)


def _records(
    files: DataFrame, seps: Sequence[str], schema: StructType | None, encoding: str, corrupt: str | None, range_bytes: int
) -> DataFrame:
    """Rows of files with ``path, length, sep``, whose quoted fields may hold line breaks; the other columns follow."""
    rest = [c for c in files.columns if c not in ("path", "length", "sep")]
    records = read_records(files.withColumn("_sep", F.col("sep")), [*rest, "_sep"], range_bytes)
    # A scan of records passes over empty ones, one of lines over blank ones, too.
    lines = records.filter(F.octet_length("_line") > 0).withColumn("_line", F.decode("_line", encoding))
    if schema is None:
        schema = raw_schema(records.agg(F.max("_fields")).first()[0] or 0)
    return _parse(lines, seps, schema, corrupt)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = DEFAULT_SEPARATOR,
    schema: StructType | None = None,
    encoding: str = ENCODING,
    multi_line: bool = False,
    corrupt: str | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Rows as strings, plus the source file in ``_file``.

    Without a schema the width is that of the first row, with ``multi_line`` that of the widest, and columns are ``_c0``, ``_c1``, ... Short
    rows are filled with NULL and long ones cut. ``corrupt`` names a column that receives the text
    of rows of the wrong width instead; it needs a schema. A path given twice is read once.
    ``multi_line`` allows line breaks inside quotes; such files are read in ranges of ``range_bytes``, twice.
    """
    named = [paths] if isinstance(paths, str) else paths
    if not multi_line:
        return _scan(spark.read, named, sep, schema, encoding, corrupt)
    if corrupt and schema is None:
        raise ValueError("rows of the wrong width can only be told with a schema")
    # Names and sizes only; columns of the folders' names come along.
    files = spark.read.format("binaryFile").load(list(dict.fromkeys(named)))
    folders = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    listed = files.select("path", "length", F.lit(sep).alias("sep"), *folders, F.col("_metadata.file_path").alias("_file"))
    return _records(listed, [sep], schema, encoding, corrupt, range_bytes)


def file_heads(files: DataFrame, size: int = SAMPLE_BYTES, opener: Callable | None = None) -> DataFrame:
    """First bytes of the files in ``path``, with their ``uri`` if there is one; nothing beyond them is read."""
    open_path = opener or file_opener(read_ahead=size)
    names = [c for c in ("path", "uri") if c in files.columns]

    def read_heads(batches):
        import pyarrow as pa

        for batch in batches:
            heads = []
            for path in batch.column(0).to_pylist():
                with open_path(path) as handle:
                    heads.append(handle.read(size))
            yield pa.record_batch([*batch.columns, pa.array(heads, pa.binary())], names=[*names, "head"])

    schema = StructType([*[StructField(c, StringType()) for c in names], StructField("head", BinaryType())])
    return files.select(*names).mapInArrow(read_heads, schema)


def detect_separators(files: DataFrame, encoding: str = ENCODING, size: int = SAMPLE_BYTES) -> DataFrame:
    """Separator of each file in ``path``, from its first bytes."""
    return file_heads(files, size).withColumn("sep", separator_of(F.decode("head", encoding))).drop("head")


def separators_by_agreement(
    lines: DataFrame, candidates: Sequence[str] = SEPARATORS, fraction: float = 1.0
) -> DataFrame:
    """(_file, sep): the candidate that most lines of a file agree on, of lines in ``_line``.

    A candidate's agreement is the share of lines that have the most common number of its fields, if that is two or more; of equal shares the one with more
    fields wins, then the earlier candidate. A candidate that stands in no line agrees on nothing, and a file without any has the
    default. Separators inside quotes do not count. ``fraction`` is the share of lines that is looked at, drawn over the whole
    file. Per file and candidate one number per field count is shuffled.
    """
    seen = lines if fraction >= 1 else lines.sample(fraction, seed=7)
    counts = F.array(*[F.struct(F.lit(-i).alias("rank"), _fields("_line", F.lit(s)).alias("n")) for i, s in enumerate(candidates)])
    single = seen.filter(F.col("_line").rlike("[^\\x00-\\x20]")).select("_file", F.explode(counts).alias("c")).select("_file", "c.*")
    many = single.groupBy("_file", "rank", "n").agg(F.count(F.lit(1)).alias("lines"))
    # The most common number of fields of each candidate, then the best candidate.
    common = many.groupBy("_file", "rank").agg(F.max(F.struct("lines", "n")).alias("top"))
    agreed = common.select("_file", F.when(F.col("top.n") > 1, F.struct("top.lines", "top.n", "rank")).alias("agreed"))
    best = agreed.groupBy("_file").agg(F.max("agreed").alias("best"))
    named = F.create_map(*[F.lit(x) for i, s in enumerate(candidates) for x in (-i, s)])
    return best.select("_file", F.coalesce(named[F.col("best.rank")], F.lit(DEFAULT_SEPARATOR)).alias("sep"))


def _stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of scans of different widths: data columns by position, then lineage columns."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    data = sorted((c for c in stacked.columns if c[:2] == "_c" and c[2:].isdigit()), key=lambda c: int(c[2:]))
    return stacked.select(*data, *[c for c in stacked.columns if c not in data])


def _fields(line: str, sep: str | Column) -> Column:
    """Number of fields of a line; a separator inside quotes does not count."""
    unquoted = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, sep)) + 1


def read_detected(
    spark: SparkSession,
    root: str,
    suffix: str = ".csv",
    schema: StructType | None = None,
    encoding: str = ENCODING,
    multi_line: bool = False,
    corrupt: str | None = None,
    sample_bytes: int = SAMPLE_BYTES,
    range_bytes: int = RANGE_BYTES,
    agreement: float | None = None,
) -> DataFrame:
    """Scan of the files below ``root``, each with its own separator, as strings with the file in ``_file``.

    Without a schema the width is that of the widest row, found by a scan of its own. The other options are those of
    ``read_delimited``. Of files with several separators the folder is scanned once as text; each line meets its
    file's separator and is parsed with it, so no list of files goes through the driver. Encodings in
    which a line break is the byte 10 are read. With ``agreement`` separators are not those of the first bytes but those that
    a share of all lines, up to 1, agrees on.
    """
    if corrupt and schema is None:
        raise ValueError("rows of the wrong width can only be told with a schema")
    place = scratch_dir(spark, "separators")
    files = list_files(spark, root, suffix)
    glob = "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    folder = {"recursiveFileLookup": "true", "pathGlobFilter": glob}

    def text() -> DataFrame:
        decoded = F.decode(F.col("value").cast("binary"), encoding).alias("_line")
        return spark.read.options(**folder).text(root).select(decoded, F.col("_metadata.file_path").alias("_file"))

    # Stored, so that its size is known when the join with the lines is planned.
    if agreement is None:
        detected = detect_separators(files, encoding, sample_bytes).select(F.col("uri").alias("_file"), F.col("sep").alias("_sep"))
    else:
        agreed = separators_by_agreement(text(), fraction=agreement)
        # Files of which no line was drawn have the default.
        detected = files.select(F.col("uri").alias("_file")).join(agreed, "_file", "left").select(
            "_file", F.coalesce("sep", F.lit(DEFAULT_SEPARATOR)).alias("_sep")
        )
    detected.write.parquet(place)
    seps = spark.read.schema("_file string, _sep string").parquet(place)
    found = sorted(r["_sep"] for r in seps.select("_sep").distinct().collect())
    if not found:
        raise FileNotFoundError(f"no {suffix} file in {root}")
    if multi_line:
        listed = files.select("path", "length", F.col("uri").alias("_file")).join(seps.withColumnRenamed("_sep", "sep"), "_file")
        return _records(listed, found, schema, encoding, corrupt, range_bytes)
    mixed = len(found) > 1
    lines = lookup_join(text(), seps, "_file", "inner") if mixed else text().withColumn("_sep", F.lit(found[0]))
    if schema is None:
        schema = raw_schema(lines.agg(F.max(_fields("_line", F.col("_sep")))).first()[0] or 0)
    if not mixed:
        return _scan(spark.read.options(**folder), [root], found[0], schema, encoding, corrupt)
    lines = lines.filter(F.col("_line").rlike("[^\\x00-\\x20]"))
    return _parse(lines, found, schema, corrupt).select(*schema.fieldNames(), *([corrupt] if corrupt else []), "_file")


def read_landing(
    spark: SparkSession,
    path: str,
    entity: str = UNCLASSIFIED,
    schema: StructType | None = None,
    encoding: str = ENCODING,
    multi_line: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """One entity of a landing written by ``land_entries``; archive and entry come back as columns.

    Only the folders of the entity are read, each with its own separator. Archive and entry are texts, whatever
    their names look like. ``corrupt`` is that of ``read_delimited``.
    """
    tables = []
    for sep, name in DELIMITER_NAMES.items():
        folder = f"{path}/_entity={entity}/_delimiter={name}"
        if load_if_present(spark, folder, "text") is None:
            continue
        with session_setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
            rows = read_delimited(spark, folder, sep, schema, encoding, multi_line, corrupt)
        if "_batch" in rows.columns:
            rows = rows.withColumn("_batch", F.col("_batch").cast("int"))
        tables.append(rows)
    if not tables:
        raise FileNotFoundError(f"nothing of {entity} landed in {path}")
    return _stack(tables)
