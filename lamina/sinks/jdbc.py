"""Publishing a keyed table to a relational database: parallel staging write, then one upsert there.

Executors write the staging table; the driver sends only statements. Identifiers are checked, as
they cannot be bound as parameters.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from lamina.functions.names import IDENTIFIER, STAGING
from lamina.operators.guards import require_set_key, require_unique_key
from lamina.operators.keys import latest_per_key
from lamina.operators.normalize import coerce_schema

# Column types of the target database.
_SQL_TYPES = {
    StringType: "TEXT",
    IntegerType: "INTEGER",
    LongType: "BIGINT",
    DoubleType: "DOUBLE PRECISION",
    BooleanType: "BOOLEAN",
    TimestampType: "TIMESTAMPTZ",
}

_IDENTIFIER = re.compile(IDENTIFIER)


def _identifier(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain SQL identifier: {name!r}")
    return name


def _sql_type(kind: DataType) -> str:
    if isinstance(kind, DecimalType):
        return f"NUMERIC({kind.precision},{kind.scale})"
    if type(kind) not in _SQL_TYPES:
        raise ValueError(f"no column type for {kind.simpleString()}")
    return _SQL_TYPES[type(kind)]


def staging_name(table: str, run_id: str) -> str:
    """Staging table of a run; a dash in the run id becomes an underscore."""
    return _identifier(f"{_identifier(table)}{STAGING}{run_id.replace('-', '_')}")


def create_table_sql(table: str, schema: StructType, key: str, stamp: str = "updated_at") -> str:
    """Statement that creates the target, with its key and update time, if it is missing."""
    if key not in schema.fieldNames():
        raise ValueError(f"key {key} is not a column")
    columns = [
        f"{_identifier(f.name)} {_sql_type(f.dataType)}{' PRIMARY KEY' if f.name == key else ''}" for f in schema
    ]
    columns.append(f"{_identifier(stamp)} TIMESTAMPTZ DEFAULT now()")
    return f"CREATE TABLE IF NOT EXISTS {_identifier(table)} ({', '.join(columns)})"


def upsert_sql(table: str, staging: str, columns: Sequence[str], key: str, stamp: str = "updated_at") -> str:
    """Statement that moves all staged rows into the target, replacing rows of the same key.

    A staging task that is run again after a lost executor may have stored its rows twice. Keys were
    unique before staging, so such rows are equal and DISTINCT restores the table as it was sent.
    """
    names = [_identifier(c) for c in columns]
    listed = ", ".join(names)
    stamp = _identifier(stamp)
    changes = ", ".join([f"{c} = EXCLUDED.{c}" for c in names if c != key] + [f"{stamp} = EXCLUDED.{stamp}"])
    return (
        f"INSERT INTO {_identifier(table)} ({listed}, {stamp}) "
        f"SELECT {listed}, now() FROM (SELECT DISTINCT {listed} FROM {_identifier(staging)}) staged "
        f"ON CONFLICT ({_identifier(key)}) DO UPDATE SET {changes}"
    )


def drop_table_sql(table: str) -> str:
    return f"DROP TABLE IF EXISTS {_identifier(table)}"


class _JdbcConnection:
    """The calls of a Python database connection that ``run_in_transaction`` uses, over JDBC."""

    def __init__(self, connection):
        self._connection = connection
        connection.setAutoCommit(False)

    def execute(self, sql: str) -> None:
        statement = self._connection.createStatement()
        try:
            statement.execute(sql)
        finally:
            statement.close()

    def commit(self) -> None:
        self._connection.commit()

    def rollback(self) -> None:
        self._connection.rollback()

    def close(self) -> None:
        self._connection.close()


def jdbc_connection(spark: SparkSession, url: str, properties: Mapping[str, str]) -> _JdbcConnection:
    """A connection of the driver process, through the JDBC driver Spark has loaded for writing."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    return _JdbcConnection(jvm.java.sql.DriverManager.getConnection(url, settings))


def run_in_transaction(connect: Callable, statements: Sequence[str]) -> None:
    """All statements on one connection, or none of them."""
    connection = connect()
    try:
        for sql in statements:
            connection.execute(sql)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    schema: StructType,
    key: str,
    run_id: str,
    properties: Mapping[str, str],
    order_by: str | Sequence[str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
    connect: Callable | None = None,
    write: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Stage ``df`` in a table of its run and upsert it into ``table`` in one transaction.

    Keys must be set and unique, or ``order_by`` says which row of a key to take. ``connections``
    bounds how many executors write at once. ``properties`` holds the driver class and credentials;
    none is stored. The staging table is dropped whether or not the upsert succeeds. ``connect`` and
    ``write`` replace the JDBC connection and staging write.
    """
    staging = staging_name(table, run_id)
    # Keys are checked as they will be stored: different texts may be one number, or none.
    if order_by is not None:
        order = [order_by] if isinstance(order_by, str) else list(order_by)
        others = [c for c in order if c not in schema.fieldNames()]
        typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *others)
        rows = latest_per_key(require_set_key(typed, key), key, order).select(*schema.fieldNames())
    else:
        rows = require_unique_key(coerce_schema(df, schema), key)
    open_connection = connect or (lambda: jdbc_connection(df.sparkSession, url, properties))

    def write_jdbc(staged: DataFrame, name: str) -> None:
        options = {**properties, "numPartitions": str(connections), "batchsize": str(batch_size)}
        staged.write.format("jdbc").mode("overwrite").options(url=url, dbtable=name, **options).save()

    try:
        (write or write_jdbc)(rows, staging)
        run_in_transaction(
            open_connection,
            [create_table_sql(table, schema, key), upsert_sql(table, staging, schema.fieldNames(), key)],
        )
    except BaseException as error:
        try:
            run_in_transaction(open_connection, [drop_table_sql(staging)])
        except Exception as second:
            error.add_note(f"the staging table {staging} could not be dropped: {second}")
        raise
    run_in_transaction(open_connection, [drop_table_sql(staging)])
