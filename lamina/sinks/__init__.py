from lamina.sinks.buckets import change_rollup, read_buckets, read_rollup, upsert_buckets
from lamina.sinks.jdbc import (
    create_table_sql,
    jdbc_connection,
    publish_jdbc,
    run_in_transaction,
    staging_name,
    upsert_sql,
)
from lamina.sinks.landing import land_archives, land_entries
from lamina.sinks.runs import append_new, overwrite_partitions, write_run

__all__ = [
    "append_new",
    "change_rollup",
    "create_table_sql",
    "jdbc_connection",
    "land_archives",
    "land_entries",
    "overwrite_partitions",
    "publish_jdbc",
    "read_buckets",
    "read_rollup",
    "run_in_transaction",
    "staging_name",
    "upsert_buckets",
    "upsert_sql",
    "write_run",
]
