"""The operators bound to the supplied tables, one query per operator or group of operators."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lamina.functions import (
    any_match,
    classify_name,
    code_int,
    decimal_comma,
    first_missing,
    landing_target,
    row_count,
    separator_of,
    staging_table,
    target_rule,
    uri_parts,
    url_basename,
)
from lamina.operators import (
    child_rollup,
    coerce_schema,
    duplicate_keys,
    enrich,
    keyed_upsert,
    latest_per_key,
    lookup_join,
    missing_from,
    positional_rename,
    require_rows,
    require_unique_key,
    split_rows,
)
from lamina.operators.guards import ExpectationError
from lamina.operators.incremental import matches
from lamina.operators.losses import WatchedCasts
from lamina.plans import ledger, registry
from lamina.plans.layout import run_path
from lamina.schemas import ENTITY_WORDS, raw_schema
from lamina.session import measured_broadcasts, scratch_dir, session_setting
from lamina.sinks import (
    append_new,
    change_rollup,
    land_archives,
    overwrite_partitions,
    read_buckets,
    read_rollup,
    upsert_buckets,
    write_run,
)
from lamina.sources import (
    bytes_of,
    entry_lines,
    expand_entries,
    list_entries,
    list_files,
    read_delimited,
    read_detected,
    read_first_available,
    read_landing,
    read_manifest,
    resolve_archives,
)
from lamina.sources.records import RANGE_BYTES
from lamina.sources.tables import rows_of
from lamina.streaming import (
    drain_to_table,
    entry_stream,
    land_archives_stream,
    run_gate,
    stream_to_table,
    upsert_stream,
)
from lamina.streaming.gate import STATE_STORE

URGENT = "1-URGENT"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a query under its function's name, or ``name`` where an operator already has that."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if oracle:
            ORACLE[key] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


def _orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")


def _ts_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("string"))


# --- enrichment: left joins, aggregates, defaults, business rule ---------------------------------

_ENRICHED_SQL = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       coalesce(o.n_orders, 0) AS n_orders,
       coalesce(o.has_urgent, false) AS has_urgent,
       coalesce(c.c_mktsegment = 'BUILDING' AND coalesce(o.n_orders, 0) > 1, false) AS is_target
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders,
                  max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) = 1 AS has_urgent
           FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
"""


@query(_ENRICHED_SQL)
def company_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich(
        _customers(spark, sf_dir),
        _orders_by_customer(spark, sf_dir),
        "c_custkey",
        aggregates={"n_orders": row_count(), "has_urgent": any_match(F.col("o_orderpriority") == URGENT)},
        defaults={"n_orders": 0, "has_urgent": False},
    )
    return joined.withColumn("is_target", target_rule("c_mktsegment", "BUILDING", "n_orders"))


@query("""
SELECT c.c_custkey, coalesce(o.n_orders, 0) AS n_orders, coalesce(o.big_order, false) AS big_order
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, bool_or(o_totalprice > 300000) AS big_order
           FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1996-07-01'
           GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
""")
def left_enrich_zero_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = _orders_by_customer(spark, sf_dir).filter(
        (F.col("o_orderpriority") == URGENT) & (F.col("o_orderdate") < F.lit("1996-07-01").cast("timestamp_ntz"))
    )
    return enrich(
        _customers(spark, sf_dir).select("c_custkey"),
        early,
        "c_custkey",
        aggregates={"n_orders": row_count(), "big_order": any_match(F.col("o_totalprice") > 300000)},
        defaults={"n_orders": 0, "big_order": False},
    )


@query("""
WITH parent AS (
  SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 0
                        WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id, event_type
  FROM events),
child AS (SELECT user_id, count(*) AS n_purchases, bool_or(value > 50) AS any_large
          FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT p.event_id, coalesce(p.user_id, -1) AS user_id, p.event_type,
       coalesce(c.n_purchases, 0) AS n_purchases, coalesce(c.any_large, false) AS any_large
FROM parent p LEFT JOIN child c ON p.user_id = c.user_id
""")
def enrich_hot_and_null_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fifths of the parent rows share one key and a fifth has none; all rows stay."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user = F.when(kind.isin("view", "click"), F.lit(0).cast("long")).when(kind != "error", F.col("user_id"))
    joined = enrich(
        events.select("event_id", user.alias("user_id"), "event_type"),
        events.filter(kind == "purchase"),
        "user_id",
        aggregates={"n_purchases": row_count(), "any_large": any_match(F.col("value") > 50)},
        defaults={"n_purchases": 0, "any_large": False},
    )
    return joined.withColumn("user_id", F.coalesce("user_id", F.lit(-1).cast("long")))


@query("""
SELECT c.c_custkey, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.any_returned, false) AS any_returned
FROM (SELECT c_custkey FROM customer WHERE c_custkey % 8 = 0) c
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, bool_or(l_returnflag = 'R') AS any_returned
           FROM lineitem GROUP BY l_orderkey) o ON c.c_custkey = o.l_orderkey
""")
def enrich_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most lines are of no parent here: they are left out by a filter of the parents' keys before they are counted."""
    parents = _customers(spark, sf_dir).select("c_custkey").filter(F.col("c_custkey") % 8 == 0)
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "c_custkey")
    return enrich(
        parents,
        lines,
        "c_custkey",
        aggregates={"n_lines": row_count(), "any_returned": any_match(F.col("l_returnflag") == "R")},
        defaults={"n_lines": 0, "any_returned": False},
        many_orphans=True,
    )


@query("SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey")
def child_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return child_rollup(_orders_by_customer(spark, sf_dir), "c_custkey", n_orders=row_count())


@query("""
SELECT o_custkey AS c_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) = 1 AS has_urgent
FROM orders GROUP BY o_custkey
""")
def child_any_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = any_match(F.col("o_orderpriority") == URGENT)
    return child_rollup(_orders_by_customer(spark, sf_dir), "c_custkey", has_urgent=urgent)


@query("""
SELECT l_suppkey, count(*) AS n_lines, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 AS any_returned,
       max(l_quantity) AS max_quantity
FROM lineitem GROUP BY l_suppkey
""")
def fused_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return child_rollup(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        n_lines=row_count(),
        any_returned=any_match(F.col("l_returnflag") == "R"),
        max_quantity=F.max("l_quantity"),
    )


# --- values: casts, renames, schemas --------------------------------------------------------------


@query("""
SELECT c_custkey,
       TRY_CAST(replace(replace(CAST(c_acctbal AS VARCHAR), '.', ','), ',', '.') AS DOUBLE) AS acctbal,
       TRY_CAST(replace(c_name, ',', '.') AS DOUBLE) IS NULL AS name_is_no_number
FROM customer
""", name="decimal_comma")
def decimal_comma_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    return _customers(spark, sf_dir).select(
        "c_custkey",
        decimal_comma(written).alias("acctbal"),
        decimal_comma("c_name").isNull().alias("name_is_no_number"),
    )


@query("""
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total FROM orders
""")
def decimal_comma_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``1.234,50``: grouping marks are stripped, and the amount is a decimal."""
    amount = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    brazilian = F.translate(amount, ",.", ".,")
    total = decimal_comma(brazilian, thousands=".", to=DecimalType(18, 2))
    return table(spark, sf_dir, "orders").select("o_orderkey", total.cast("double").alias("total"))


@query("""
SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_code,
       NOT regexp_matches(p_brand, '^[0-9]+$') AS brand_is_no_code, true AS decimal_is_no_code
FROM part
""")
def code_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        code_int(F.substring_index("p_brand", "#", -1)).alias("brand_code"),
        code_int("p_brand").isNull().alias("brand_is_no_code"),
        code_int(F.concat(F.col("p_size").cast("string"), F.lit(".7"))).isNull().alias("decimal_is_no_code"),
    )


@query("""
SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id,
       l_linenumber AS line_no, l_quantity AS quantity FROM lineitem
""", name="positional_rename")
def positional_rename_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").withColumn("_file", F.input_file_name())
    return positional_rename(lineitem, ["order_id", "part_id", "supplier_id", "line_no", "quantity"])


@query(f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, TRY_CAST(c_nationkey AS INTEGER) AS c_nationkey,
       c_acctbal, c_mktsegment, n_orders, has_urgent, is_target
FROM ({_ENRICHED_SQL})
""", name="coerce_schema")
def coerce_to_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = StructType(
        [
            StructField("c_custkey", StringType()),
            StructField("c_name", StringType()),
            StructField("c_nationkey", IntegerType()),
            StructField("c_acctbal", DoubleType()),
            StructField("c_mktsegment", StringType()),
            StructField("n_orders", LongType()),
            StructField("has_urgent", BooleanType()),
            StructField("is_target", BooleanType()),
        ]
    )
    return coerce_schema(company_enrich(spark, sf_dir).withColumn("extra", F.lit(1)), sink)


# --- keys and upserts -----------------------------------------------------------------------------

_UPSERT_SQL = """
WITH target AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer),
source AS (SELECT p_partkey + 100 AS id, p_name AS name, p_retailprice AS amount FROM part)
SELECT * FROM target WHERE id NOT IN (SELECT id FROM source)
UNION ALL SELECT * FROM source
"""


def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as the target and parts, their keys moved on, as the source: old keys, common ones and new ones."""
    columns = ["id", "name", "amount"]
    target = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_acctbal").toDF(*columns)
    parts = table(spark, sf_dir, "part")
    return target, parts.select(F.col("p_partkey") + 100, "p_name", "p_retailprice").toDF(*columns)


@query(_UPSERT_SQL, name="keyed_upsert")
def keyed_upsert_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _upsert_sides(spark, sf_dir)
    return keyed_upsert(target, source, "id")


@query(_UPSERT_SQL)
def snapshot_upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table: first load, upsert, and the same upsert again and again, which changes nothing."""
    root = scratch_dir(spark, "bucketed")
    target, source = _upsert_sides(spark, sf_dir)
    for rows in (target, source, source, source):
        upsert_buckets(spark, root, rows, "id", buckets=8)
    return read_buckets(spark, root)


@query("""
SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer
WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def upsert_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few suppliers upserted into the stored customers: the other buckets are neither read nor written."""
    root = scratch_dir(spark, "touched")
    target, _ = _upsert_sides(spark, sf_dir)
    upsert_buckets(spark, root, target, "id", buckets=64)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal").toDF(*target.columns)
    upsert_buckets(spark, root, suppliers, "id")
    return read_buckets(spark, root)


_LATEST_EVENT = """
SELECT user_id, event_id, CAST(ts AS VARCHAR) AS ts, event_type FROM (
  SELECT user_id, event_id, ts, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1
"""


@query(f"""
WITH latest AS ({_LATEST_EVENT}),
target AS (SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS event_id,
                  '2000-01-01 00:00:00' AS ts, 'none' AS event_type FROM customer)
SELECT * FROM target WHERE user_id NOT IN (SELECT user_id FROM latest WHERE user_id IS NOT NULL)
UNION ALL SELECT * FROM latest
""")
def keyed_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with many rows per key: the latest is taken."""
    target = _customers(spark, sf_dir).select(
        F.col("c_custkey").alias("user_id"),
        F.lit(-1).cast("long").alias("event_id"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit("none").alias("event_type"),
    )
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return _ts_as_text(keyed_upsert(target, events, "user_id", order_by=["ts", "event_id"]))


@query(
    "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
    name="duplicate_keys",
)
def duplicate_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def checked_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_unique_key(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("""
SELECT user_id, count(*) AS n_rows, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0 AS any_purchase,
       CAST(sum(CAST(round(coalesce(value, 0) * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events WHERE event_id % 5 <> 0 GROUP BY user_id
""")
def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches, the last of which takes some back, and one of them again: the summaries follow."""
    root = scratch_dir(spark, "rollup")
    events = table(spark, sf_dir, "events").withColumn("sign", F.lit(1))
    late = F.col("event_id") % 3 == 2
    batches = [events.filter(~late), events.filter(late), events.filter(F.col("event_id") % 5 == 0).withColumn("sign", F.lit(-1))]
    for number in (0, 1, 1, 2, 2):
        change_rollup(
            spark,
            root,
            batches[number],
            "user_id",
            number,
            F.col("sign"),
            n_purchases=matches(F.col("event_type") == "purchase"),
            cents=F.round(F.col("value") * 100).cast("long"),
        )
    any_purchase = (F.col("n_purchases") > 0).alias("any_purchase")
    return read_rollup(spark, root).select("user_id", "n_rows", any_purchase, "cents")


# --- names ----------------------------------------------------------------------------------------


@query("""
SELECT doc_id, CASE
  WHEN greatest(p, s, c) = 0 THEN ';' WHEN p = greatest(p, s, c) THEN '|'
  WHEN s = greatest(p, s, c) THEN ';' ELSE ',' END AS sep
FROM (SELECT doc_id, length(text) - length(replace(text, '|', '')) AS p,
             length(text) - length(replace(text, ';', '')) AS s,
             length(text) - length(replace(text, ',', '')) AS c FROM documents)
""")
def sep_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", separator_of("text").alias("sep"))


@query("""
SELECT page_id, CASE WHEN contains(lower(url), '/en/') OR contains(lower(url), '/fr/') THEN 'first'
                     WHEN contains(lower(url), '/de/') THEN 'second' ELSE 'none' END AS entity
FROM pages
""")
def name_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"first": ("/EN/", "/fr/"), "second": ("/de/",)}
    entity = F.coalesce(classify_name("url", rules), F.lit("none"))
    return table(spark, sf_dir, "pages").select("page_id", entity.alias("entity"))


@query("""
SELECT page_id, coalesce(nullif(split_part(rtrim(split_part(url, '?', 1), '/'), '/', -1), ''), 'file.bin') AS name
FROM pages
""", name="url_basename")
def url_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url_basename("url").alias("name"))


@query("""
SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/]+)/(.+)$', 1) AS scheme,
       regexp_extract(url, '^([a-z]+)://([^/]+)/(.+)$', 2) AS container,
       regexp_extract(url, '^([a-z]+)://([^/]+)/(.+)$', 3) AS object
FROM pages
""", name="uri_parts")
def uri_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "pages").select("page_id", uri_parts("url", strict=True).alias("parts"))
    return parts.select("page_id", "parts.*")


@query("""
SELECT page_id, rtrim(split_part(url, '#', 1), '/') || '/' ||
  coalesce(nullif(split_part(rtrim(split_part(url, '?', 1), '/'), '/', -1), ''), 'file.bin') AS target
FROM pages
""")
def landing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.substring_index("url", "#", 1)
    return table(spark, sf_dir, "pages").select("page_id", landing_target(prefix, "url").alias("target"))


@query(r"""
SELECT doc_id, trim(piece, E' \t\r\n') AS piece
FROM (SELECT doc_id, unnest(string_split(text, ',')) AS piece FROM documents)
""")
def split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "piece")


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'lang' WHEN source = 'src1' THEN 'source'
                    WHEN n_chars < 100 THEN 'n_chars' ELSE 'none' END AS missing
FROM documents
""")
def first_missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "doc_id": F.col("doc_id"),
        "lang": F.nullif(F.col("lang"), F.lit("en")),
        "source": F.when(F.col("source") == "src1", F.lit("")).otherwise(F.col("source")),
        "n_chars": F.when(F.col("n_chars") >= 100, F.col("n_chars")),
    }
    missing = F.coalesce(first_missing(fields), F.lit("none"))
    return table(spark, sf_dir, "documents").select("doc_id", missing.alias("missing"))


@query(r"""
SELECT c_custkey, CASE WHEN regexp_matches(part, '^[A-Za-z_][A-Za-z0-9_]*$') THEN part || '_stg_' || replace(run, '-', '_') END AS staging
FROM (SELECT c_custkey, lower(c_mktsegment) || CASE WHEN c_custkey % 7 = 0 THEN ' x' ELSE '' END AS part,
             '2024-' || CAST(c_custkey AS VARCHAR) AS run FROM customer)
""")
def staging_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging tables of runs; a table whose name is no plain identifier has none."""
    part = F.concat(F.lower("c_mktsegment"), F.when(F.col("c_custkey") % 7 == 0, " x").otherwise(""))
    run = F.concat(F.lit("2024-"), F.col("c_custkey").cast("string"))
    return _customers(spark, sf_dir).select("c_custkey", staging_table(part, run).alias("staging"))


@query(r"""
SELECT 'total' AS column_name, count(*) AS n_set, CAST(0 AS BIGINT) AS n_lost FROM orders
UNION ALL SELECT 'priority', count(*), count(*) FROM orders
UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus <> 'P'),
                 count(*) FILTER (o_orderstatus = 'F') FROM orders
""", name="cast_losses")
def losses_of_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What casts turn into NULL, counted by the write that casts: amounts nothing, priorities all, and a mixed column in part."""
    status = F.col("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.when(status == "O", "12").when(status == "F", "12.7").otherwise("  ").alias("status"),
    )
    watched = WatchedCasts(raw, {"total": decimal_comma("total"), "priority": code_int("priority"), "status": code_int("status")})
    write_run(watched.rows, scratch_dir(spark, "watched"))
    losses = watched.losses()
    schema = StructType([StructField("column_name", StringType()), StructField("n_set", LongType()), StructField("n_lost", LongType())])
    return rows_of(spark, schema, *[(c, losses.set[c], losses.lost[c]) for c in losses.set])


# --- ledger, manifests, no-clobber ----------------------------------------------------------------


@query("""
SELECT p_partkey + 100 AS p_partkey, p_name FROM part WHERE p_partkey + 100 NOT IN (SELECT l_partkey FROM lineitem)
""")
def landing_no_clobber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, their keys moved on, whose key no line has landed yet; offered twice over, and again, each lands once."""
    incoming = table(spark, sf_dir, "part").select((F.col("p_partkey") + 100).alias("p_partkey"), "p_name")
    landed = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.lit(None).cast("string").alias("p_name")
    )
    path = scratch_dir(spark, "no-clobber")
    append_new(landed, path, "p_partkey")
    for _ in range(2):
        append_new(incoming.unionByName(incoming), path, "p_partkey")
    return spark.read.parquet(path).filter(F.col("p_name").isNotNull())


@query("""
SELECT s.user_id FROM (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'signup' GROUP BY user_id) s
LEFT JOIN (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'purchase' GROUP BY user_id) p
  ON s.user_id = p.user_id WHERE p.ts IS NULL OR p.ts < s.ts
""")
def pending_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose newest sign-up no purchase has followed: one summary row per user, then anti-join."""
    per_user = child_rollup(
        table(spark, sf_dir, "events"),
        "user_id",
        signup=F.max(F.when(F.col("event_type") == "signup", F.col("ts"))),
        purchase=F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))),
    )
    expected = per_user.filter(F.col("signup").isNotNull()).select("user_id")
    done = per_user.filter(F.col("purchase") >= F.col("signup")).select("user_id")
    return missing_from(expected, done, "user_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def manifest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "documents").select("doc_id", "source")
    return missing_from(expected, table(spark, sf_dir, "labels"), "doc_id")


@query(_LATEST_EVENT)
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return _ts_as_text(latest_per_key(events, "user_id", ["ts", "event_id"]))


@query("""
WITH entries AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS stage,
         CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status, event_id, ts FROM events),
newest AS (SELECT *, row_number() OVER (PARTITION BY run_id, stage
                                        ORDER BY ts DESC, status DESC, event_id DESC) AS n FROM entries)
SELECT run_id, stage FROM newest WHERE n = 1 AND status <> 'SUCCESS'
""")
def ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages of runs whose newest ledger row is not a success; users stand for runs."""
    entries = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.when(F.col("value") > 20, ledger.DONE).otherwise(ledger.FAILED).alias("status"),
        F.col("event_id").alias("rows"),
        F.col("ts").alias("at"),
    )
    return ledger.pending(entries.select("run_id", "stage").distinct(), entries)


@query("""
SELECT DISTINCT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM events
""")
def log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of all events in many files, appended twice: each row once in the table that is made of it."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    path = scratch_dir(spark, "log")
    for _ in range(2):
        events.repartition(8, "event_id").write.mode("append").parquet(path)
    whole = scratch_dir(spark, "log-rows")
    write_run(spark.read.parquet(path).distinct(), whole)
    return _ts_as_text(spark.read.parquet(whole))


# --- sources and sinks: the supplied tables written out and read back -----------------------------


def _write_delimited(df: DataFrame, path: str, sep: str) -> str:
    df.write.option("sep", sep).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return path


def _orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        "o_orderpriority",
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("o_totalprice"),
        F.col("o_custkey").cast("string"),
    )


def _typed_orders(raw: DataFrame) -> DataFrame:
    named = positional_rename(raw, ["order_id", "priority", "total"])
    return named.withColumns({"order_id": F.col("order_id").try_cast("long"), "total": decimal_comma("total")})


_TYPED_ORDERS_SQL = "SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS total FROM orders"


@query(_TYPED_ORDERS_SQL)
def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-less ISO-8859-1 text, separator detected, width taken from the data."""
    path = _write_delimited(_orders_as_text(spark, sf_dir), scratch_dir(spark, "delimited"), ";")
    return _typed_orders(read_detected(spark, path))


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, nullif(source, '') AS source FROM documents
""")
def delimited_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks in quoted fields: each file is read in four ranges or more, all records and fields are found."""
    path = scratch_dir(spark, "multi-line")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "text", "lang", "source")
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    texts.write.options(sep=";", escape='"', encoding="UTF-8", **kept).csv(path)
    largest = list_files(spark, path, ".csv").agg(F.max("length")).first()[0] or 4
    size = max(1, min(RANGE_BYTES, largest // 4))
    rows = read_delimited(spark, path, ";", encoding="UTF-8", multi_line=True, range_bytes=size)
    return positional_rename(rows, ["doc_id", "text", "lang", "source"])


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, o_orderstatus AS status,
       o_orderpriority AS priority FROM orders
""")
def delimited_mixed_separators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with three separators below one folder; each is read with its own."""
    path = scratch_dir(spark, "mixed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    for sep, status in (("|", "O"), (";", "F")):
        _write_delimited(orders.filter(F.col("o_orderstatus") == status), f"{path}/{status}", sep)
    _write_delimited(orders.filter(~F.col("o_orderstatus").isin("O", "F")), f"{path}/rest", ",")
    return positional_rename(read_detected(spark, path), ["order_id", "customer_id", "status", "priority"])


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2,
       c_mktsegment AS _c3, true AS fifth_is_null, true AS has_file FROM customer
""")
def delimited_fixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed schema wider than the rows: missing fields are NULL; each row names its file."""
    written = _customers(spark, sf_dir).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = _write_delimited(written, scratch_dir(spark, "fixed"), ";")
    rows = read_delimited(spark, path, ";", raw_schema(5))
    checks = {"fifth_is_null": F.col("_c4").isNull(), "has_file": F.col("_file").contains(".csv")}
    return rows.withColumns(checks).drop("_c4", "_file")


def _joined(fields: DataFrame) -> DataFrame:
    """All columns of a row as one ``;`` line."""
    positions = [f"f{i}" for i in range(len(fields.columns))]
    return fields.toDF(*positions).select(F.concat_ws(";", *positions).alias("value"))


def _write_archives(lines: DataFrame, folder: str, name: str) -> None:
    """One ZIP per task from a column of text lines, streamed.

    A finished archive is moved to the name of its partition, so a task that runs twice leaves one.
    """

    def pack(batches):
        import uuid
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        place = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
        filesystem, inner = fs.FileSystem.from_uri(place)
        filesystem.create_dir(inner, recursive=True)
        unfinished = f"{inner}/{name}{part}-{uuid.uuid4().hex}.part"
        with filesystem.open_output_stream(unfinished) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("README.txt", "a;b\n")
            with z.open(f"data/K{part}.CSV", "w", force_zip64=True) as entry:
                for batch in batches:
                    entry.write("".join(f"{value}\n" for value in batch.column(0).to_pylist()).encode("iso-8859-1"))
        filesystem.move(unfinished, f"{inner}/{name}{part}.zip")
        yield pa.record_batch([pa.array([part])], names=["part"])

    lines.mapInArrow(pack, "part long").write.format("noop").mode("overwrite").save()


@query(_TYPED_ORDERS_SQL)
def archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZIP archives listed, expanded, landed byte for byte and read back as a table."""
    root = scratch_dir(spark, "archives")
    _write_archives(_joined(_orders_as_text(spark, sf_dir)), f"{root}/zips", "Empresas")
    if not land_archives(list_files(spark, f"{root}/zips", ".zip"), root):
        raise ExpectationError("no entry in the archives")
    return _typed_orders(read_landing(spark, f"{root}/csv"))


@query("""
SELECT value, count(*) AS n_lines FROM (
  SELECT l_returnflag || ';' || l_linestatus || ';' || l_linenumber AS value FROM lineitem) GROUP BY value
""")
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of archive entries without a landing, from blocks much smaller than an entry."""
    root = scratch_dir(spark, "lines")
    fields = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    _write_archives(_joined(fields), root, "Socios")
    listing = scratch_dir(spark, "listing")
    write_run(list_entries(list_files(spark, root, ".zip")), listing)
    lines = entry_lines(expand_entries(spark.read.parquet(listing), chunk_bytes=1 << 16))
    return lines.groupBy("value").agg(row_count().alias("n_lines"))


@query("""
WITH companies AS (
  SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer
  UNION ALL SELECT NULL, 'S' || s_suppkey, s_name, s_nationkey, s_acctbal, 'BUILDING' FROM supplier)
SELECT c.cnpj, c.c_name AS razao_social,
       c.c_nationkey AS natureza_juridica, c.c_acctbal AS capital_social,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN '03' ELSE '05' END AS cod_porte,
       coalesce(o.n, 0) AS qtde_socios, coalesce(o.f, false) AS flag_socio_estrangeiro,
       c.c_mktsegment = 'BUILDING' AND coalesce(o.n, 0) > 1 AS doc_alvo,
       '2024-02-01 12:00:00' AS updated_at
FROM companies c
LEFT JOIN (SELECT o_custkey, count(*) AS n, bool_or(o_orderpriority = '1-URGENT') AS f
           FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
""")
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: archives, raw, typed and enriched layers, published table; then a rerun with nothing to do.

    Companies are customers, and suppliers as companies without partners.
    """
    root = scratch_dir(spark, "run")
    key = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    size = F.when(F.col("c_mktsegment") == "BUILDING", "03").otherwise("05")
    capital = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    companies = _customers(spark, sf_dir).select(
        key, "c_name", F.col("c_nationkey").cast("string"), F.lit("49"), capital, size, F.lit("")
    )
    balance = F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(","))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
        "s_name",
        F.col("s_nationkey").cast("string"),
        F.lit("49"),
        balance,
        F.lit("03"),
        F.lit(""),
    )
    companies = companies.union(suppliers)
    kind = F.when(F.col("o_orderpriority") == URGENT, "3").otherwise("2")
    blank = [F.lit("").alias(f"blank{i}") for i in range(8)]
    partners = _orders_by_customer(spark, sf_dir).select(key, kind, F.col("o_orderkey").cast("string"), *blank)
    raw = run_path(root, "raw", "run-1")
    _write_archives(_joined(companies), raw, "Empresas")
    _write_archives(_joined(partners), raw, "Socios")
    registry.run(spark, root, "run-1", as_of=datetime(2024, 2, 1, 12))
    if registry.run(spark, root, "run-1"):
        raise ExpectationError("a finished run must leave nothing to do")
    return read_buckets(spark, f"{root}/published").withColumn("updated_at", F.col("updated_at").cast("string"))


@query("""
SELECT o_orderkey AS order_id, o_orderstatus <> 'O' AS wrong_width FROM orders
""")
def delimited_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are shorter or longer than the schema are marked, and none is lost."""
    path = scratch_dir(spark, "quarantine")
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").cast("string")
    short, exact = F.concat_ws(";", key, status), F.concat_ws(";", key, status, "o_orderpriority")
    line = F.when(status == "F", short).when(status == "O", exact).otherwise(F.concat(exact, F.lit(";more")))
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    rows = read_delimited(spark, path, ";", raw_schema(3), corrupt="_bad")
    return rows.select(F.col("_c0").try_cast("long").alias("order_id"), F.col("_bad").isNotNull().alias("wrong_width"))


@query("SELECT url, count(*) AS n_pages FROM pages GROUP BY url")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "manifest")
    table(spark, sf_dir, "pages").select(F.concat(F.lit("  "), "url", F.lit("\n"))).write.text(path)
    return read_manifest(spark, path).groupBy("url").agg(row_count().alias("n_pages"))


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus AS run_id FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""")
def run_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run written again replaces its own rows and no other run's."""
    path = scratch_dir(spark, "runs")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("run_id"))
    overwrite_partitions(orders, path)
    again = orders.filter(F.col("run_id") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        overwrite_partitions(again, path)
    return spark.read.parquet(path)


@query("""
SELECT 'lineitem' AS name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
""")
def counted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts taken while writing."""
    path = scratch_dir(spark, "counted")
    counts = [(n, write_run(table(spark, sf_dir, n), f"{path}/{n}")) for n in ("lineitem", "orders")]
    schema = StructType([StructField("name", StringType()), StructField("n_rows", LongType())])
    return rows_of(spark, schema, *counts)


@query(_TYPED_ORDERS_SQL)
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet is missing, so the delimited copy is read."""
    path = scratch_dir(spark, "fallback")
    _write_delimited(_orders_as_text(spark, sf_dir), f"{path}/csv", ";")
    raw = read_first_available(
        spark,
        [
            ("parquet", f"{path}/parquet", {}),
            ("csv", f"{path}/csv", {"sep": ";", "encoding": "ISO-8859-1", "escape": '"'}),
        ],
    )
    return _typed_orders(raw)


@query(r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(replace(replace(text, E'\n', ' '), ';', ','), '"', '') AS text, lang FROM documents
""")
def sep_by_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts full of commas in lines of three ``;`` fields: the first bytes speak for the comma, all lines for the semicolon."""
    path = scratch_dir(spark, "agreement")
    text = F.translate("text", '\n;"', " ,")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), text, "lang")
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(sep=";", escape='"', encoding="UTF-8", **kept).csv(path)
    found = read_detected(spark, path, schema=raw_schema(3), encoding="UTF-8", agreement=1.0)
    return positional_rename(found, ["doc_id", "text", "lang"])


# --- streams --------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A pattern, so that the table may be one file or a folder of files.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


@query("SELECT * FROM events")
def stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed as they arrive; a second pass finds nothing new."""
    path = scratch_dir(spark, "stream")
    for _ in range(2):
        stream_to_table(_event_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table")


@query(_TYPED_ORDERS_SQL)
def stream_land_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives landed as they arrive; a second pass finds nothing new, nor does one with a new checkpoint."""
    root = scratch_dir(spark, "stream-archives")
    _write_archives(_joined(_orders_as_text(spark, sf_dir)), f"{root}/raw", "Empresas")
    for checkpoint in ("checkpoint", "checkpoint", "new-checkpoint"):
        land_archives_stream(spark, f"{root}/raw", f"{root}/landing", f"{root}/{checkpoint}", ENTITY_WORDS)
    return _typed_orders(read_landing(spark, f"{root}/landing/csv", "empresas"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def stream_archive_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that arrive in two lots, read by a streaming source in batches of bounded bytes: each line once.

    The second lot's names come before the first's, and it is read by a restarted stream.
    """
    root = scratch_dir(spark, "arriving")
    orders = table(spark, sf_dir, "orders")
    late = F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0
    for name, lot in (("Socios", ~late), ("Empresas", late)):
        lines = _joined(orders.filter(lot).select(F.col("o_orderkey").cast("string"), "o_orderpriority"))
        _write_archives(lines.repartition(8, "value"), f"{root}/raw", name)
        blocks = entry_stream(spark, f"{root}/raw", f"{root}/plan", batch_bytes=bytes_of(spark, f"{root}/raw"))
        drain_to_table(entry_lines(blocks), f"{root}/lines", f"{root}/checkpoint")
    fields = F.split("value", ";")
    return spark.read.parquet(f"{root}/lines").select(fields[0].alias("o_orderkey"), fields[1].alias("o_orderpriority"))


@query(_LATEST_EVENT)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files upserted as they arrive, the latest event of each user winning."""
    path = scratch_dir(spark, "stream-upsert")
    events = _event_stream(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    for _ in range(2):
        upsert_stream(events, f"{path}/table", "user_id", ["ts", "event_id"], f"{path}/checkpoint")
    return _ts_as_text(read_buckets(spark, f"{path}/table"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS cnpj, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE '05' END AS cod_porte,
       o_orderstatus <> 'O' AS wrong_width
FROM orders
""")
def medallion_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over lines that are shorter or longer than the schema: no row is lost, and each such line is kept whole."""
    root = scratch_dir(spark, "ragged")
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    short = F.concat_ws(";", key, status)
    exact = F.concat_ws(";", short, F.lit("1;49;1,00;05;x"))
    line = F.when(status == "F", short).when(status == "O", exact).otherwise(F.concat(exact, F.lit(";more;fields")))
    raw = run_path(root, "raw", "run-1")
    _write_archives(orders.select(line.alias("value")), raw, "Empresas")
    _write_archives(orders.select(F.concat_ws(";", key, F.lit("2;A;;;;;;;;")).alias("value")), raw, "Socios")
    registry.run(spark, root, "run-1")
    wrong = registry.rejected(spark, root, "run-1", "empresas").select(F.split("text", ";")[0].alias("cnpj"))
    published = read_buckets(spark, f"{root}/published").select("cnpj", "cod_porte")
    marked = lookup_join(published, wrong.withColumn("wrong_width", F.lit(True)), "cnpj")
    # Stored, as what is returned would be joined by the sizes of files: there may be as many wrong lines as others.
    with measured_broadcasts(spark):
        write_run(marked.withColumn("wrong_width", F.coalesce("wrong_width", F.lit(False))), f"{root}/marked")
    return spark.read.parquet(f"{root}/marked")


@query(_LATEST_EVENT)
def stream_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that arrive newest first: what comes late changes nothing."""
    path = scratch_dir(spark, "stream-late")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    schema = events.schema
    for part in reversed(range(3)):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in")
        upsert_stream(stream, f"{path}/table", "user_id", ["ts", "event_id"], f"{path}/checkpoint")
    return _ts_as_text(read_buckets(spark, f"{path}/table"))


@query(_UPSERT_SQL)
def snapshot_reader_survives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged rows published by run: what a run has published stays as it is when later runs upsert."""
    root = scratch_dir(spark, "published")
    target, source = _upsert_sides(spark, sf_dir)
    write_run(keyed_upsert(target, source, "id"), run_path(root, "published", "run-1"))
    reader = spark.read.parquet(run_path(root, "published", "run-1"))
    write_run(keyed_upsert(reader, source.withColumn("amount", F.lit(0.0)), "id"), run_path(root, "published", "run-2"))
    return reader


# Runs of the gate: documents three by three, every other run due before the last third of the arrivals.
_GATE_SQL = """
WITH expected AS (
  SELECT DISTINCT CAST(doc_id // 3 AS VARCHAR) AS run_id, CAST(doc_id AS VARCHAR) AS name, CASE WHEN doc_id // 3 % 2 = 0 THEN 2 ELSE 9 END AS due
  FROM documents),
arrived AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS name, doc_id % 3 + 1 AS at FROM labels),
counted AS (
  SELECT run_id, count(*) AS n_expected, count(*) - count(a.name) AS n_missing
  FROM expected e LEFT JOIN arrived a ON e.name = a.name AND a.at <= e.due GROUP BY run_id)
SELECT run_id, CASE WHEN n_missing = 0 THEN 'complete' ELSE 'expired' END AS status, n_expected, n_missing FROM counted
"""


@query(_GATE_SQL)
def stream_run_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that wait for their documents, whose labels arrive in three batches: which are complete, and which run out of time."""
    path = scratch_dir(spark, "gate")
    hour = lambda n: F.timestamp_seconds(n * 3600)
    run = F.floor(F.col("doc_id") / 3).cast("long")
    expected = table(spark, sf_dir, "documents").select(
        run.alias("run_id"), F.col("doc_id").alias("name"), hour(F.when(run % 2 == 0, F.lit(2)).otherwise(F.lit(9))).alias("due")
    )
    at = F.col("doc_id") % 3
    labels = table(spark, sf_dir, "labels").select(run.alias("run_id"), F.col("doc_id").alias("name"), hour(at + 1).alias("at"), at.alias("_part"))
    # The last batch brings nothing that is awaited, only the time.
    end = spark.range(1).select(F.lit(-1).cast("long").alias("run_id"), F.lit(-1).cast("long").alias("name"), hour(F.lit(24)).alias("at"))
    for rows in (*[labels.filter(F.col("_part") == p).drop("_part") for p in range(3)], end):
        rows.write.mode("append").parquet(f"{path}/in")
        arrivals = spark.readStream.schema(end.schema).parquet(f"{path}/in").withWatermark("at", "0 seconds")
        with session_setting(spark, "spark.sql.streaming.stateStore.providerClass", STATE_STORE):
            stream_to_table(run_gate(arrivals, expected), f"{path}/decided", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/decided")


def _partner_lines(orders: DataFrame) -> DataFrame:
    return orders.select(F.concat_ws(";", F.col("o_orderkey").cast("string"), F.lit("2;A;;;;;;;;")).alias("value"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS cnpj, o_clerk AS razao_social FROM (
  SELECT o_orderkey, 'corrected ' || o_orderpriority AS o_clerk FROM orders)
""")
def rerun_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished run whose archives are corrected: once bronze has run again, the next run redoes what follows it."""
    root = scratch_dir(spark, "rerun")
    orders = table(spark, sf_dir, "orders")
    key, raw = F.col("o_orderkey").cast("string"), run_path(root, "raw", "run-1")
    _write_archives(_partner_lines(orders), raw, "Socios")
    for attempt, prefix in enumerate(("", "corrected ")):
        name = F.concat(F.lit(prefix), "o_orderpriority")
        _write_archives(orders.select(F.concat_ws(";", key, name, F.lit("1;49;1,00;05;x")).alias("value")), raw, "Empresas")
        if attempt:
            registry.run(spark, root, "run-1", stages=["bronze"], again=True)
        registry.run(spark, root, "run-1")
    return read_buckets(spark, f"{root}/published").select("cnpj", "razao_social")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS cnpj, o_orderpriority AS razao_social, '2024-02-01 12:00:00' AS updated_at FROM orders
""")
def rerun_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same archives land again in other files: bronze finds the same rows, so nothing after it is redone."""
    root = scratch_dir(spark, "unchanged")
    orders = table(spark, sf_dir, "orders")
    raw = run_path(root, "raw", "run-1")
    lines = orders.select(F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority", F.lit("1;49;1,00;05;x")).alias("value"))
    for hour, again in ((12, False), (13, True)):
        _write_archives(lines, raw, "Empresas")
        _write_archives(_partner_lines(orders), raw, "Socios")
        if again:
            registry.run(spark, root, "run-1", stages=["bronze"], again=True)
        redone = registry.run(spark, root, "run-1", as_of=datetime(2024, 2, 1, hour))
    if redone:
        raise ExpectationError(f"nothing has changed, but {redone} were redone")
    published = read_buckets(spark, f"{root}/published")
    return published.select("cnpj", "razao_social", F.col("updated_at").cast("string").alias("updated_at"))


def _write_twin_archives(lines: DataFrame, folder: str) -> None:
    """As ``_write_archives``, with the lines alternating between two entries of one name."""

    def pack(batches):
        import io
        import uuid
        import warnings
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        warnings.simplefilter("ignore")
        part = TaskContext.get().partitionId()
        place = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
        filesystem, inner = fs.FileSystem.from_uri(place)
        filesystem.create_dir(inner, recursive=True)
        unfinished = f"{inner}/E{part}-{uuid.uuid4().hex}.part"
        with filesystem.open_output_stream(unfinished) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for batch in batches:
                values = batch.column(0).to_pylist()
                for half in (values[::2], values[1::2]):
                    with z.open("K.CSV", "w", force_zip64=True) as entry:
                        io.TextIOWrapper(entry, "iso-8859-1", newline="\n").writelines(f"{v}\n" for v in half)
        filesystem.move(unfinished, f"{inner}/E{part}.zip")
        yield pa.record_batch([pa.array([part])], names=["part"])

    lines.mapInArrow(pack, "part long").write.format("noop").mode("overwrite").save()


@query("""
SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS folder, 'K.CSV' AS entry, o_orderkey AS order_id,
       o_orderpriority AS priority, o_totalprice AS total FROM orders
""")
def archive_same_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of one name, inside an archive and in archives of one name in two folders: all rows, with their lineage."""
    root = scratch_dir(spark, "same-names")
    orders, is_open = table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "O"
    for folder, chosen in (("open", is_open), ("other", ~is_open)):
        rows = orders.filter(chosen).select("o_orderkey", "o_orderpriority", "o_totalprice")
        texts = rows.withColumn("o_totalprice", F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")))
        _write_twin_archives(_joined(texts.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))), f"{root}/zips/{folder}")
    land_archives(list_files(spark, f"{root}/zips", ".zip"), root)
    landed = read_landing(spark, f"{root}/csv", schema=raw_schema(3))
    return landed.select(
        F.substring_index("_archive", "/", 1).alias("folder"),
        F.col("_entry").alias("entry"),
        F.col("_c0").cast("long").alias("order_id"),
        F.col("_c1").alias("priority"),
        decimal_comma("_c2").alias("total"),
    )


@query(_TYPED_ORDERS_SQL)
def landing_keeps_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that come again with other contents: what landed first under a name stays, and new names are added."""
    root = scratch_dir(spark, "keeps-first")
    orders = _orders_as_text(spark, sf_dir)
    even = F.col("o_orderkey").cast("long") % 2 == 0
    for attempt, (name, rows) in enumerate(
        (("A", orders.filter(even)), ("A", orders.withColumn("o_orderpriority", F.lit("new"))), ("B", orders.filter(~even)))
    ):
        _write_archives(_joined(rows), f"{root}/zips-{attempt}", name)
        land_archives(list_files(spark, f"{root}/zips-{attempt}", ".zip"), root, keep_landed=True)
    return _typed_orders(read_landing(spark, f"{root}/csv"))


@query("""
SELECT 'explicit' AS origin, 'empresas' AS entity, o_orderkey AS order_id FROM orders
UNION ALL SELECT 'raw_zips', 'socios', o_orderkey FROM orders
""")
def archive_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that are named, whatever they are called, and those of the spare folder where nothing has arrived."""
    root = scratch_dir(spark, "sources")
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("value"))
    _write_archives(keys, f"{root}/named", "x")
    _write_archives(keys, f"{root}/raw_zips", "Socios")
    roots = [f"{root}/raw", f"{root}/raw_zips"]
    found = None
    for explicit, entity in (({"empresas": [f"{root}/named"]}, "empresas"), (None, "socios")):
        archives, origin = resolve_archives(spark, roots, ENTITY_WORDS, explicit)
        land_archives(archives, f"{root}/{entity}")
        landed = read_landing(spark, f"{root}/{entity}/csv", entity, raw_schema(1))
        rows = landed.select(
            F.lit(origin.removeprefix(f"{root}/")).alias("origin"), F.lit(entity).alias("entity"), F.col("_c0").cast("long").alias("order_id")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@query("""
SELECT 'rows' AS guard, 'orders' AS name, true AS met, count(*) AS n_rows FROM orders
UNION ALL SELECT 'rows', 'lines of negative quantity', false, count(*) FROM lineitem WHERE l_quantity < 0
UNION ALL SELECT 'width', 'part', true, count(*) FROM part
UNION ALL SELECT 'width', 'nation', false, count(*) FROM nation
""")
def guard_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say of tables that have rows and width enough, and of tables that have not."""
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity < 0")
    cases = [
        ("rows", "orders", table(spark, sf_dir, "orders"), lambda df: require_rows(df, "orders are empty")),
        ("rows", "lines of negative quantity", lines, lambda df: require_rows(df, "no such line")),
        ("width", "part", table(spark, sf_dir, "part"), lambda df: positional_rename(df, ["key", "name"])),
        ("width", "nation", table(spark, sf_dir, "nation"), lambda df: positional_rename(df, [f"f{i}" for i in range(40)])),
    ]
    found = None
    for guard, name, df, check in cases:
        try:
            df, met = check(df), True
        except (ExpectationError, ValueError):
            met = False
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(guard).alias("guard"), F.lit(name).alias("name"), F.lit(met).alias("met"), "n_rows"
        )
        found = row if found is None else found.unionByName(row)
    return found
