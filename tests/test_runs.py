"""Sinks, ledger, whole runs and streams."""

import re
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lamina.__main__ import arguments, execute
from lamina.operators.guards import ExpectationError
from lamina.plans import ledger, registry, table_queries
from lamina.plans.layout import run_path
from lamina.schemas import ENRICHED, ENTITY_WORDS
from lamina.session import scratch_dir, scratch_scope, wide_shuffle
from lamina.sinks import (
    create_table_sql,
    jdbc_connection,
    land_archives,
    overwrite_partitions,
    publish_jdbc,
    read_buckets,
    run_in_transaction,
    staging_name,
    upsert_buckets,
    upsert_sql,
    write_run,
)
from lamina.sinks.jdbc import _JdbcConnection
from lamina.sinks.buckets import merged_buckets
from lamina.sources import list_files, read_landing
from lamina.streaming import land_archives_stream, stream_to_table, upsert_stream

COMPANY_LINES = [
    '"00000001";"AÇÃO; LTDA";"2062";"49";"1000,50";"03";""',
    '"00000002";"B ""X"" ME";"2135";"50";"0,00";"03"',
    '"00000003";"C";"x";"50";"bad";"05";"SP"',
]
PARTNER_LINES = [
    "00000001;2;ANA;***1;49;20200101;;;;;4",
    "00000001;3;BOB;***2;22;20200101;249;;;;0",
    "00000002;2;CID;***3;49;20200101;;;;;5",
    "00000009;3;DEA;***4;49;20200101;;;;;5",
]
EXPECTED = [
    ("00000001", "AÇÃO; LTDA", 2062, 1000.5, "03", 2, True, True),
    ("00000002", 'B "X" ME', 2135, 0.0, "03", 1, False, False),
    ("00000003", "C", None, None, "05", 0, False, False),
]


def put_archive(path, name, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, ("\n".join(lines) + "\n").encode("iso-8859-1"))


@pytest.fixture
def root(tmp_path):
    raw = tmp_path / "raw" / "r-1"
    put_archive(raw / "Empresas0.zip", "d/K.CSV", COMPANY_LINES[:2])
    put_archive(raw / "Empresas1.zip", "d/K.CSV", COMPANY_LINES[2:])
    put_archive(raw / "Socios0.zip", "S.csv", PARTNER_LINES)
    return str(tmp_path)


def test_archives_to_published_table(spark, root, rows):
    assert registry.run(spark, root, "r-1") == ["ingest", "bronze", "silver", "gold", "load"]
    assert spark.read.parquet(run_path(root, "gold", "r-1", "resultado_final")).schema == ENRICHED
    published = read_buckets(spark, f"{root}/published")
    assert rows(published.drop("updated_at")) == EXPECTED
    assert published.filter("updated_at is null").isEmpty()
    counts = {r["stage"]: r["rows"] for r in ledger.read_ledger(spark, f"{root}/ledger").collect()}
    assert counts == {"ingest": 3, "bronze": 7, "silver": 7, "gold": 3, "load": 3}
    assert registry.run(spark, root, "r-1") == []


def test_stages_as_jobs(spark, root, rows):
    def job(*words):
        return execute(spark, arguments([*words, "--root", root, "--run-id", "r-1"]))

    assert job("bronze") == ["bronze"]
    assert job("run") == ["ingest", "silver", "gold", "load"]
    assert job("run") == [] and job("gold") == ["gold"] and job("load") == ["load"]
    assert rows(read_buckets(spark, f"{root}/published").drop("updated_at")) == EXPECTED


def test_explicit_archives_and_manifest_as_job(spark, tmp_path, root):
    (tmp_path / "urls.txt").write_text("https://h/Empresas0.zip\nhttps://h/Absent.zip\n")
    where = ["--root", root, "--run-id", "r-1"]
    with pytest.raises(FileNotFoundError, match="Absent.zip"):
        execute(spark, arguments(["run", *where, "--manifest", str(tmp_path / "urls.txt")]))
    raw = f"{root}/raw/r-1"
    chosen = ["--companies", f"{raw}/Empresas1.zip", "--partners", f"{raw}/Socios0.zip"]
    assert execute(spark, arguments(["bronze", *where, *chosen])) == ["bronze"]
    assert registry.raw_table(spark, root, "r-1", "empresas").count() == 1


def test_silver_reads_the_landing_where_parquet_is_missing(spark, root, rows):
    registry.bronze(spark, root, "r-1")
    stored = rows(registry.typed_companies(registry.raw_table(spark, root, "r-1", "empresas")))
    archives = list_files(spark, run_path(root, "raw", "r-1"), ".zip").filter("name like 'Empresas%'")
    archives = archives.withColumn("entity", F.lit("empresas"))
    land_archives(archives, run_path(root, "bronze", "r-2"))
    landed = registry.raw_table(spark, root, "r-2", "empresas")
    assert landed.columns[:7] == [f"_c{i}" for i in range(7)]
    assert rows(registry.typed_companies(landed)) == stored and len(stored) == 3


def test_names_with_line_breaks_stay_whole(spark, tmp_path):
    lines = ['"00000001";"ONE\nTWO";"2062";"49";"1,5";"03";""', '"00000002";"B";"2062";"49";"2";"03";""']
    put_archive(tmp_path / "raw" / "r" / "Empresas.zip", "K.CSV", lines)
    put_archive(tmp_path / "raw" / "r" / "Socios.zip", "S.CSV", PARTNER_LINES)
    root = str(tmp_path)
    registry.run(spark, root, "r", multi_line=True)
    names = {r["razao_social"] for r in read_buckets(spark, f"{root}/published").collect()}
    assert names == {"ONE\nTWO", "B"}


def test_a_failed_stage_is_resumed(spark, root):
    def broken(df):
        raise OSError("database is away")

    with pytest.raises(OSError):
        registry.run(spark, root, "r-1", publish=broken)
    assert ledger.pending_stages(spark, f"{root}/ledger", "r-1") == ["load"]
    newest = ledger.latest_status(ledger.read_ledger(spark, f"{root}/ledger"))
    assert [r["stage"] for r in newest.filter("status = 'FAILED'").collect()] == ["load"]
    seen = []
    assert registry.run(spark, root, "r-1", publish=lambda df: seen.append(df.count())) == ["load"]
    assert seen == [3]


def test_a_second_run_updates_the_published_table(spark, root, tmp_path, rows):
    registry.run(spark, root, "r-1")
    raw = tmp_path / "raw" / "r-2"
    put_archive(raw / "Empresas.zip", "K.CSV", ['"00000003";"C2";"1";"1";"7,5";"03";""', '"00000004";"D";"1";"1";"1";"01";""'])
    put_archive(raw / "Socios.zip", "S.CSV", ["00000003;3;X;y;1;;;;;;", "00000003;2;X;y;1;;;;;;"])
    registry.run(spark, root, "r-2")
    got = rows(read_buckets(spark, f"{root}/published").drop("updated_at"))
    assert got == EXPECTED[:2] + [
        ("00000003", "C2", 1, 7.5, "03", 2, True, True),
        ("00000004", "D", 1, 1.0, "01", 0, False, False),
    ]
    assert spark.read.parquet(run_path(root, "gold", "r-1", "resultado_final")).count() == 3


def test_nothing_arrived(spark, tmp_path):
    with pytest.raises(ExpectationError, match="nothing has arrived"):
        registry.run(spark, str(tmp_path), "r-9")


def test_manifest_gate(spark, root):
    manifest = spark.createDataFrame([("https://h/Empresas0.zip?x",), ("https://h/Socios9.zip",)], "url string")
    with pytest.raises(FileNotFoundError, match="Socios9.zip"):
        registry.ingest(spark, root, "r-1", manifest)
    assert registry.ingest(spark, root, "r-1", manifest.limit(1)) == 3


def test_an_entity_without_entries_stops_the_run(spark, tmp_path):
    put_archive(tmp_path / "raw" / "r" / "Empresas.zip", "K.CSV", COMPANY_LINES)
    with pytest.raises(ExpectationError, match="socios"):
        registry.bronze(spark, str(tmp_path), "r")


def executed_gold(monkeypatch):
    """The plans of the gold tables that are written from now on, as they were executed."""
    plans = []

    def written(df, path, **options):
        if "/gold/" in path:
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write_run(df, path, **options)

    monkeypatch.setattr(registry, "write_run", written)
    return plans


@pytest.mark.parametrize("most, broadcast", [("1m", False), ("100m", True)])
def test_gold_is_joined_by_measured_sizes(spark, tmp_path, settings, monkeypatch, most, broadcast):
    """50,000 partners, whose file is smaller than 1 MB and whose rows are larger, are not gathered in the driver."""
    settings(spark__sql__autoBroadcastJoinThreshold=most)
    plans, root = executed_gold(monkeypatch), str(tmp_path)
    keys = spark.range(50_000).select(F.format_string("%08d", "id").alias("cnpj"))
    companies = keys.selectExpr("cnpj", "'N' AS razao_social", "1 AS natureza_juridica", "1D AS capital_social", "'03' AS cod_porte")
    companies.write.parquet(run_path(root, "silver", "r", "empresas"))
    keys.union(keys).selectExpr("cnpj", "2 AS tipo_socio").coalesce(1).write.parquet(run_path(root, "silver", "r", "socios"))
    assert registry.gold(spark, root, "r") == 50_000
    assert registry.result(spark, root, "r").filter("qtde_socios = 2 AND doc_alvo").count() == 50_000
    assert [("BroadcastHashJoin" in p, "SortMergeJoin" in p.split("Initial Plan")[0]) for p in plans] == [(broadcast, not broadcast)]
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == most
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None


def test_wrong_lines_are_joined_before_they_are_returned(spark, tmp_path, rows):
    """So that the join is planned by the settings of the query, not by those of whoever writes its rows."""
    orders = spark.createDataFrame([(k, "FOP"[k % 3]) for k in range(30)], "o_orderkey long, o_orderstatus string")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    marked = table_queries.medallion_ragged(spark, str(tmp_path))
    assert "Join" not in marked._jdf.queryExecution().executedPlan().toString()
    expected = [(str(k), None if k % 3 == 0 else "05", k % 3 != 1) for k in range(30)]
    assert rows(marked, "cnpj", "cod_porte", "wrong_width") == sorted(expected, key=repr)


def test_duplicate_companies_survive_gold_and_stop_the_load(spark, tmp_path):
    put_archive(tmp_path / "raw" / "r" / "Empresas.zip", "K.CSV", COMPANY_LINES + COMPANY_LINES[:1])
    put_archive(tmp_path / "raw" / "r" / "Socios.zip", "S.CSV", PARTNER_LINES)
    root = str(tmp_path)
    with pytest.raises(ExpectationError, match="occurs 2 times"):
        registry.run(spark, root, "r")
    assert ledger.pending_stages(spark, f"{root}/ledger", "r") == ["load"]
    assert read_buckets(spark, f"{root}/published") is None
    registry.load(spark, root, "r", f"{root}/published", order_by="razao_social")
    assert read_buckets(spark, f"{root}/published").count() == 3


def test_rows_can_be_stamped_with_a_given_time(spark, root):
    for stage in (registry.bronze, registry.silver, registry.gold):
        stage(spark, root, "r-1")
    registry.load(spark, root, "r-1", f"{root}/t", as_of=datetime(2024, 1, 2, 3, 4, 5))
    stamps = read_buckets(spark, f"{root}/t").select("updated_at").distinct().collect()
    assert [r[0] for r in stamps] == [datetime(2024, 1, 2, 3, 4, 5)]


def test_run_paths_cannot_leave_the_root():
    assert run_path("/x/", "gold", "2024-01", "t") == "/x/gold/2024-01/t"
    for bad in ("..", "a/b", ""):
        with pytest.raises(ValueError):
            run_path("/x", "gold", bad)


def test_rewriting_a_run_leaves_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for run in ("a", "b", "b"):
        assert overwrite_partitions(spark.createDataFrame([(1, run)], "v int, run_id string"), path) == 1
    assert rows(spark.read.parquet(path)) == [(1, "a"), (1, "b")]


def test_count_comes_with_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_run(spark.range(1000).filter("id % 4 = 0"), path) == 250
    assert write_run(spark.range(10).filter("id < 0"), path) == 0
    assert spark.read.parquet(path).count() == 0


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.pending_stages(spark, path, "r") == ["ingest", "bronze", "silver", "gold", "load"]
    for stage in ("ingest", "bronze", "silver"):
        ledger.record_stage(spark, path, "r", stage, 5)
    ledger.record_stage(spark, path, "other", "gold", 5)
    assert ledger.pending_stages(spark, path, "r") == ["gold", "load"]
    ledger.record_stage(spark, path, "r", "silver", status="FAILED")
    assert ledger.pending_stages(spark, path, "r") == ["silver", "gold", "load"]
    assert ledger.read_ledger(spark, path).count() == 5
    assert ledger.pending_stages(spark, path, "r") == ["silver", "gold", "load"]


def test_scratch_scope(spark):
    import os

    outside = scratch_dir(spark, "outside")
    spark.range(3).write.parquet(outside)
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        first = scratch_dir(spark, "inside")
        spark.range(3).write.parquet(first)
        with scratch_scope(spark):
            second = scratch_dir(spark, "inside")
            spark.range(3).write.parquet(second)
        assert not os.path.exists(second.removeprefix("file://"))
        assert spark.read.parquet(first).count() == 3
        1 / 0
    assert not os.path.exists(first.removeprefix("file://"))
    assert spark.read.parquet(outside).count() == 3


def test_bucketed_upserts(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    second = spark.createDataFrame([(30, "3"), (20, "2")], "v int, k string")
    assert read_buckets(spark, root) is None
    assert upsert_buckets(spark, root, first.limit(0), "k") == 0 and read_buckets(spark, root) is None
    assert upsert_buckets(spark, root, first, "k") == 2
    for _ in range(2):
        assert upsert_buckets(spark, root, second, "k") == 2
        assert rows(read_buckets(spark, root)) == [(1, 1), (2, 20), (3, 30)]
    assert upsert_buckets(spark, root, second.limit(0), "k") == 0
    for bad in ([(1, 1), (1, 2)], [(None, 1)]):
        with pytest.raises(ExpectationError):
            upsert_buckets(spark, root, spark.createDataFrame(bad, "k int, v int"), "k")
    with pytest.raises(ExpectationError):
        upsert_buckets(spark, root, first.select("k"), "k")
    assert upsert_buckets(spark, root, spark.createDataFrame([(1, 0), (1, 5), (2, 7)], "k int, v int"), "k", order_by="v") == 2
    assert rows(read_buckets(spark, root)) == [(1, 5), (2, 20), (3, 30)]
    assert read_buckets(spark, root).schema == first.schema


def test_an_upsert_leaves_other_buckets_alone(spark, tmp_path):
    """Neither read, by the files of the plan, nor written, by the files on disk."""
    root = tmp_path / "t"
    table = spark.range(2000).selectExpr("id AS k", "CAST(0 AS INT) AS v")
    upsert_buckets(spark, str(root), table, "k", buckets=50)
    before = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in root.rglob("*.parquet")}
    assert len(before) == 50
    change = spark.createDataFrame([(3, 1), (700, 1), (5000, 1)], "k long, v int")
    staged = change.withColumns({"_buckets": F.lit(50), "_bucket": F.pmod(F.xxhash64("k"), F.lit(50)).cast("int")})
    touched = {f"_bucket={r['_bucket']}" for r in staged.collect()}
    stored = spark.read.parquet(str(root))
    merged = merged_buckets(stored, staged, "k")
    pruned = re.findall(r"PartitionFilters: \[_bucket#\d+ IN \(([0-9,]+)\)\]", merged._jdf.queryExecution().executedPlan().toString())
    assert [{f"_bucket={b}" for b in found.split(",")} for found in pruned] == [touched] and merged.filter("v = 1").count() == 3
    assert upsert_buckets(spark, str(root), change, "k") == 3
    after = {p: (p.stat().st_mtime_ns, p.stat().st_ino) for p in root.rglob("*.parquet")}
    kept = {p for p in before if after.get(p) == before[p]}
    assert {p.parent.name for p in before if p not in kept} == touched and len(after) == 50
    table = read_buckets(spark, str(root))
    assert table.count() == 2001 and table.agg(F.sum("v")).first()[0] == 3


def test_large_upserts_are_joined_by_measured_sizes(spark, tmp_path, settings, monkeypatch):
    """150,000 keys, whose files are smaller than 2 MB and whose rows are larger, are not gathered in the driver; a few are."""
    settings(spark__sql__autoBroadcastJoinThreshold="2m")
    plans, root = [], str(tmp_path / "t")

    def overwritten(df, *args):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return overwrite_partitions(df, *args)

    table = spark.range(150_000).select(F.format_string("%08d", "id").alias("k"), F.lit(1).alias("v")).coalesce(1)
    upsert_buckets(spark, root, table, "k")
    monkeypatch.setattr("lamina.sinks.buckets.overwrite_partitions", overwritten)
    for source, value in ((table.withColumn("v", F.lit(2)), 2), (table.limit(10).withColumn("v", F.lit(3)), 3)):
        upsert_buckets(spark, root, source, "k")
        assert read_buckets(spark, root).filter(F.col("v") == value).count() == source.count()
    assert read_buckets(spark, root).count() == 150_000
    assert ["BroadcastHashJoin" in p for p in plans] == [False, True]


def test_a_failed_upsert_is_done_again(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path / "t")
    upsert_buckets(spark, root, spark.createDataFrame([(1, 1), (2, 1)], "k int, v int"), "k")
    source = spark.createDataFrame([(2, 2), (3, 2)], "k int, v int")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr("lamina.sinks.buckets.overwrite_partitions", broken)
        upsert_buckets(spark, root, source, "k")
    assert rows(read_buckets(spark, root)) == [(1, 1), (2, 1)]
    upsert_buckets(spark, root, source, "k")
    assert rows(read_buckets(spark, root)) == [(1, 1), (2, 2), (3, 2)]


def test_what_follows_a_stage_run_again_is_redone(spark, root, tmp_path, rows):
    registry.run(spark, root, "r-1")
    assert registry.run(spark, root, "r-1") == []
    put_archive(tmp_path / "raw" / "r-1" / "Empresas1.zip", "d/K.CSV", [COMPANY_LINES[2].replace('"C"', '"D"')])
    assert registry.run(spark, root, "r-1", stages=["bronze"], again=True) == ["bronze"]
    assert registry.run(spark, root, "r-1") == ["silver", "gold", "load"]
    names = {r["razao_social"] for r in read_buckets(spark, f"{root}/published").collect()}
    assert "D" in names and "C" not in names


def test_an_unchanged_run_is_joined_by_measured_sizes(spark, tmp_path, settings, monkeypatch):
    """30,000 partners of as many companies, whose summary's files are below the threshold: whole, not gathered, and not redone."""
    settings(spark__sql__autoBroadcastJoinThreshold="500k")
    plans, root = executed_gold(monkeypatch), str(tmp_path)
    for again in (False, True):
        put_archive(tmp_path / "raw/r/Empresas.zip", "K.CSV", [f"{k:08d};N;1;49;1,00;03;x" for k in range(30_000)])
        put_archive(tmp_path / "raw/r/Socios.zip", "S.CSV", [f"{k:08d};3;A;;;;;;;;" for k in range(30_000)])
        if again:
            assert registry.run(spark, root, "r", stages=["bronze"], again=True) == ["bronze"]
        assert registry.run(spark, root, "r") == ([] if again else ["ingest", "bronze", "silver", "gold", "load"])
    published = read_buckets(spark, f"{root}/published")
    assert published.filter("qtde_socios = 1 AND flag_socio_estrangeiro").count() == published.count() == 30_000
    assert ["BroadcastHashJoin" in p for p in plans] == [False]


def test_a_short_first_line_costs_nothing(spark, tmp_path):
    raw = tmp_path / "raw" / "r"
    lines = ["00000001;SHORT", *[f"0000000{i};NAME;2062;49;1,00;03;X" for i in range(2, 6)], "00000006;LONG;1;2;3,00;03;X;more;fields"]
    put_archive(raw / "Empresas.zip", "1e3.csv", lines)
    put_archive(raw / "Socios.zip", "S.csv", PARTNER_LINES)
    registry.run(spark, str(tmp_path), "r")
    table = {r["cnpj"]: r["cod_porte"] for r in read_buckets(spark, f"{tmp_path}/published").collect()}
    assert table == {"00000001": None, **{f"0000000{i}": "03" for i in range(2, 7)}}
    wrong = registry.rejected(spark, str(tmp_path), "r", "empresas").collect()
    assert sorted(r["text"] for r in wrong) == [lines[0], lines[-1]]
    assert {r["_entry"] for r in wrong} == {"1e3.csv"}
    counts = {r["stage"]: r["rows"] for r in ledger.read_ledger(spark, f"{tmp_path}/ledger").collect()}
    assert counts["bronze"] == 10


# --- relational publishing: statements and their order; no database is started ---------------------


def test_staging_name():
    assert staging_name("cnpj_resultado", "2024-01-a") == "cnpj_resultado_stg_2024_01_a"
    assert staging_name("app.t", "1") == "app.t_stg_1"


@pytest.mark.parametrize("bad", ["t; drop table x", "1t", "t-x", "a.b.c", 't"', ""])
def test_only_plain_identifiers_are_accepted(bad):
    for build in (
        lambda: staging_name(bad, "r"),
        lambda: create_table_sql(bad, ENRICHED, "cnpj"),
        lambda: upsert_sql("t", bad, ["k"], "k"),
        lambda: upsert_sql("t", "s", ["k", bad], "k"),
    ):
        with pytest.raises(ValueError):
            build()


def test_create_table_text():
    assert create_table_sql("cnpj_resultado", ENRICHED, "cnpj") == (
        "CREATE TABLE IF NOT EXISTS cnpj_resultado (cnpj TEXT PRIMARY KEY, razao_social TEXT, "
        "natureza_juridica INTEGER, capital_social DOUBLE PRECISION, cod_porte TEXT, qtde_socios BIGINT, "
        "flag_socio_estrangeiro BOOLEAN, doc_alvo BOOLEAN, updated_at TIMESTAMPTZ DEFAULT now())"
    )
    with pytest.raises(ValueError):
        create_table_sql("t", ENRICHED, "absent")


def test_upsert_text():
    assert upsert_sql("t", "t_stg_1", ["k", "a", "b"], "k") == (
        "INSERT INTO t (k, a, b, updated_at) "
        "SELECT k, a, b, now() FROM (SELECT DISTINCT k, a, b FROM t_stg_1) staged "
        "ON CONFLICT (k) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b, updated_at = EXCLUDED.updated_at"
    )


class Recorded:
    """Stands in for a connection and keeps what it was asked to do."""

    def __init__(self, log, fail_on=None):
        self.log, self.fail_on = log, fail_on

    def execute(self, sql):
        if self.fail_on and self.fail_on in sql:
            raise RuntimeError("refused")
        self.log.append(sql.split(" (")[0])

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def publish(spark, values, log, fail_on=None, **options):
    publish_jdbc(
        spark.createDataFrame(values, ENRICHED), "unused", "t", ENRICHED, "cnpj", "r-1", {},
        connect=lambda: Recorded(log, fail_on),
        write=lambda df, name: log.append((name, df.count())),
        **options,
    )


def test_publishing_stages_upserts_and_drops(spark):
    log = []
    publish(spark, EXPECTED, log)
    assert log == [
        ("t_stg_r_1", 3), "CREATE TABLE IF NOT EXISTS t", "INSERT INTO t", "commit", "close",
        "DROP TABLE IF EXISTS t_stg_r_1", "commit", "close",
    ]


def test_a_refused_upsert_is_rolled_back_and_its_staging_table_dropped(spark):
    log = []
    with pytest.raises(RuntimeError, match="refused"):
        publish(spark, EXPECTED, log, fail_on="ON CONFLICT")
    assert log[2:4] == ["rollback", "close"] and log[-3] == "DROP TABLE IF EXISTS t_stg_r_1"


def test_publishing_checks_keys_before_staging(spark):
    log = []
    with pytest.raises(ExpectationError):
        publish(spark, EXPECTED + EXPECTED[:1], log)
    assert log == []
    publish(spark, EXPECTED + EXPECTED[:1], log, order_by="razao_social")
    assert log[0] == ("t_stg_r_1", 3)


def test_keys_are_checked_as_they_are_stored(spark):
    rows = spark.createDataFrame([("1", "a"), ("01", "b")], "k string, v string")
    schema = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
    with pytest.raises(ExpectationError):
        publish_jdbc(rows, "url", "t", schema, "k", "r", {}, connect=lambda: None, write=lambda df, name: None)
    with pytest.raises(ExpectationError):
        publish_jdbc(rows.withColumn("k", F.lit("x")).limit(1), "url", "t", schema, "k", "r", {}, connect=lambda: None, write=lambda df, name: None)


def test_the_first_error_is_kept_when_the_drop_fails(spark):
    def refuse():
        raise OSError("no connection")

    def fail(df, name):
        raise RuntimeError("staging failed")

    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(RuntimeError, match="staging failed") as caught:
        publish_jdbc(rows, "url", "t", rows.schema, "k", "r", {}, connect=refuse, write=fail)
    assert "could not be dropped" in caught.value.__notes__[0]


def test_jdbc_connection_is_one_transaction():
    calls = []

    class Java:
        def __getattr__(self, name):
            def call(*args):
                calls.append((name, *args))
                return self

            return call

    run_in_transaction(lambda: _JdbcConnection(Java()), ["A", "B"])
    names = [c[0] for c in calls]
    assert calls[0] == ("setAutoCommit", False)
    assert names.count("execute") == 2 and names.count("commit") == 1 and names[-1] == "close"


def test_connecting_asks_the_driver_manager(spark):
    with pytest.raises(Exception, match="No suitable driver found for jdbc:none:x"):
        jdbc_connection(spark, "jdbc:none:x", {"user": "u", "password": "p"})


# --- streams --------------------------------------------------------------------------------------


def test_stream_lands_each_archive_once(spark, tmp_path, rows):
    raw, out, check = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")
    put_archive(raw / "Empresas0.zip", "d/K.CSV", COMPANY_LINES[:2])
    put_archive(raw / "Socios0.zip", "S.csv", PARTNER_LINES)
    put_archive(raw / "other.zip", "S.csv", PARTNER_LINES)

    def landed(entity):
        return read_landing(spark, f"{out}/csv", entity).count()

    land_archives_stream(spark, str(raw), out, check, ENTITY_WORDS)
    assert (landed("empresas"), landed("socios")) == (2, 4)
    land_archives_stream(spark, str(raw), out, check, ENTITY_WORDS)
    assert (landed("empresas"), landed("socios")) == (2, 4)
    put_archive(raw / "Empresas1.zip", "d/K.CSV", COMPANY_LINES[2:])
    land_archives_stream(spark, str(raw), out, check, ENTITY_WORDS)
    assert (landed("empresas"), landed("socios")) == (3, 4)
    put_archive(raw / "unknown.zip", "S.csv", PARTNER_LINES)
    land_archives_stream(spark, str(raw), out, check, ENTITY_WORDS)
    land_archives_stream(spark, str(raw), out, f"{check}-2", ENTITY_WORDS)
    assert (landed("empresas"), landed("socios")) == (3, 4)


def test_stream_equals_batch(spark, tmp_path, rows):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.range(100).repartition(4).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    for _ in range(2):
        stream_to_table(stream, out, check)
    assert rows(spark.read.parquet(out)) == rows(spark.read.parquet(source))
    spark.range(100, 110).write.mode("append").parquet(source)
    stream_to_table(stream, out, check)
    assert spark.read.parquet(out).count() == 110


def test_stream_upsert(spark, tmp_path, rows):
    source, root, check = (str(tmp_path / n) for n in ("in", "t", "check"))
    schema = "k int, t int, v string"

    def arrive(*values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert_stream(stream, root, "k", "t", check)
        return rows(read_buckets(spark, root))

    assert arrive((1, 1, "a"), (1, 2, "b"), (2, 1, "c")) == [(1, 2, "b"), (2, 1, "c")]
    assert arrive((2, 2, "d"), (3, 1, "e")) == [(1, 2, "b"), (2, 2, "d"), (3, 1, "e")]
    assert arrive((1, 1, "late"), (4, 0, "f")) == [(1, 2, "b"), (2, 2, "d"), (3, 1, "e"), (4, 0, "f")]


def test_shuffles_grow_with_their_input(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    for size, partitions in ((0, before), (1 << 20, before), (100 << 30, "800"), (100 << 40, "20000")):
        with wide_shuffle(spark, size):
            assert spark.conf.get(name) == partitions
        assert spark.conf.get(name) == before


def test_scratch_folders():
    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = conf

    shared = {"spark.checkpoint.dir": "hdfs://nn/tmp/"}
    first, second = (scratch_dir(Session("yarn", **shared), "x") for _ in range(2))
    assert first != second and first.startswith("hdfs://nn/tmp/x-")
    assert scratch_dir(Session("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")
