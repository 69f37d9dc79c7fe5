"""The company registry: archives to raw, typed and enriched tables, and the published result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lamina.functions.names import url_basename
from lamina.functions.values import any_match, code_int, decimal_comma, row_count, target_rule
from lamina.operators.enrich import enrich
from lamina.operators.guards import ExpectationError
from lamina.operators.joins import missing_from
from lamina.operators.losses import WatchedCasts
from lamina.operators.normalize import coerce_schema, positional_rename
from lamina.plans.layout import run_path
from lamina.plans.ledger import DONE, FAILED, is_stale, newest_rows, record_stage
from lamina.schemas import (
    CAST_LOSSES,
    COMPANY_COLUMNS,
    ENRICHED,
    ENTITY_WORDS,
    FOREIGN_PARTNER,
    GATE,
    KEY,
    PARTNER_COLUMNS,
    STAGES,
    TARGET_SIZE,
    raw_schema,
)
from lamina.session import measured_broadcasts, wide_shuffle
from lamina.sinks.buckets import upsert_buckets
from lamina.sinks.landing import land_archives
from lamina.sinks.runs import RowCount, write_run
from lamina.sources.archives import SAMPLE_BYTES
from lamina.sources.delimited import read_landing
from lamina.sources.files import bytes_of, list_files, resolve_archives
from lamina.sources.tables import load_if_present, rows_of

# Column of the text of rows of the wrong width, and where such a row came from.
_TEXT = "_rejected"
LINEAGE_KEPT = ("_file", "_archive", "_entry")

COLUMNS = {"empresas": COMPANY_COLUMNS, "socios": PARTNER_COLUMNS}


def casts_of(entity: str) -> dict[str, Column]:
    """The casts of an entity's columns, by name."""
    if entity == "socios":
        return {c: code_int(c) for c in ("tipo_socio", "codigo_qualificacao_socio")}
    codes = {c: code_int(c) for c in ("natureza_juridica", "qualificacao_responsavel")}
    return {"capital_social": decimal_comma("capital_social"), **codes}


def typed_companies(raw: DataFrame) -> DataFrame:
    return positional_rename(raw, COMPANY_COLUMNS).withColumns(casts_of("empresas"))


def typed_partners(raw: DataFrame) -> DataFrame:
    return positional_rename(raw, PARTNER_COLUMNS).withColumns(casts_of("socios"))


def enriched_companies(companies: DataFrame, partners: DataFrame) -> DataFrame:
    """One row per company row: partner count, foreign-partner flag and target flag."""
    joined = enrich(
        companies,
        partners,
        KEY,
        aggregates={
            "qtde_socios": row_count(),
            "flag_socio_estrangeiro": any_match(F.col("tipo_socio") == FOREIGN_PARTNER),
        },
        defaults={"qtde_socios": 0, "flag_socio_estrangeiro": False},
    )
    flagged = joined.withColumn("doc_alvo", target_rule("cod_porte", TARGET_SIZE, "qtde_socios"))
    return flagged.select(*ENRICHED.fieldNames())


def ingest(spark: SparkSession, root: str, run_id: str, manifest: DataFrame | None = None) -> int:
    """Arrival gate: something has landed, and everything a manifest of ``url`` rows names."""
    landed = list_files(spark, run_path(root, "raw", run_id))
    arrived = landed.count()
    if not arrived:
        raise ExpectationError(f"nothing has arrived for run {run_id}")
    if manifest is not None:
        expected = manifest.select(url_basename("url").alias("name"))
        absent = missing_from(expected, landed, "name").take(1)
        if absent:
            raise FileNotFoundError(f"run {run_id} still waits for {absent[0]['name']}")
    return arrived


def bronze(
    spark: SparkSession,
    root: str,
    run_id: str,
    explicit: Mapping[str, Sequence[str]] | None = None,
    entry_suffix: str = ".csv",
    multi_line: bool = False,
    sample_bytes: int = SAMPLE_BYTES,
) -> int:
    """Raw copy of the archives' entries, and the same rows as all-string Parquet.

    The width of a table is that of its schema, whatever a file's first line is like. Rows of another width
    are filled with NULL or cut, as the scan does, and also stand whole in ``<entity>_rejected``, with the file,
    archive and entry they came from.
    """
    roots = [run_path(root, "raw", run_id), run_path(root, "bronze", run_id, "raw_zips")]
    archives, _ = resolve_archives(spark, roots, ENTITY_WORDS, explicit)
    landing = run_path(root, "bronze", run_id)
    land_archives(archives, landing, entry_suffix, ordered=multi_line, expect=tuple(ENTITY_WORDS), sample_bytes=sample_bytes)
    written = []
    for entity in ENTITY_WORDS:
        schema = raw_schema(len(COLUMNS[entity]))
        table = run_path(root, "bronze", run_id, entity)
        rows = read_landing(spark, f"{landing}/csv", entity, schema, multi_line=multi_line, corrupt=_TEXT)
        # Landed files have other names each time.
        written.append(write_run(rows, table, fingerprint=True, but=("_file",)))
        # The text is parsed once; the few rows of another width are found by its statistics in the stored table.
        stored = spark.read.parquet(table)
        wrong = stored.filter(F.col(_TEXT).isNotNull()).select("_c0", F.col(_TEXT).alias("text"), *LINEAGE_KEPT)
        write_run(wrong, run_path(root, "bronze", run_id, f"{entity}_rejected"))
    return RowCount.total(*written)


def rejected(spark: SparkSession, root: str, run_id: str, entity: str) -> DataFrame:
    """Rows of another width than the entity's schema: first field, whole text, file, archive and entry."""
    return spark.read.parquet(run_path(root, "bronze", run_id, f"{entity}_rejected"))


def raw_table(spark: SparkSession, root: str, run_id: str, entity: str, multi_line: bool = False) -> DataFrame:
    """The raw Parquet table of an entity, or its landed text where there is none."""
    stored = load_if_present(spark, run_path(root, "bronze", run_id, entity), "parquet")
    if stored is not None:
        return stored.drop(_TEXT)
    schema = raw_schema(len(COLUMNS[entity]))
    return read_landing(spark, run_path(root, "bronze", run_id, "csv"), entity, schema, multi_line=multi_line)


def silver(
    spark: SparkSession,
    root: str,
    run_id: str,
    multi_line: bool = False,
    most_lost: float | Mapping[str, float] | None = None,
) -> int:
    """Typed tables of both entities; ``multi_line`` matters only where the landed text is read.

    What casts have turned into NULL is counted by the same writes and stands in ``silver/<run>/cast_losses``. A column that loses
    a larger share than ``most_lost`` (of all columns, or by name) stops the run once that is written.
    """
    written, losses = [], {}
    for entity in COLUMNS:
        named = positional_rename(raw_table(spark, root, run_id, entity, multi_line), COLUMNS[entity])
        watched = WatchedCasts(named, casts_of(entity))
        written.append(write_run(watched.rows, run_path(root, "silver", run_id, entity), fingerprint=True))
        losses[entity] = watched.losses()
    counts = [(e, c, found.set[c], found.lost[c]) for e, found in losses.items() for c in found.set]
    write_run(rows_of(spark, CAST_LOSSES, *counts).coalesce(1), run_path(root, "silver", run_id, "cast_losses"))
    for found in losses.values():
        if most_lost is not None:
            named = most_lost if not isinstance(most_lost, Mapping) else {c: m for c, m in most_lost.items() if c in found.set}
            found.require(named)
    return RowCount.total(*written)


def cast_losses(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """(entity, column, n_set, n_lost) of a run's casts."""
    return spark.read.parquet(run_path(root, "silver", run_id, "cast_losses"))


def gold(spark: SparkSession, root: str, run_id: str) -> int:
    inputs = [run_path(root, "silver", run_id, entity) for entity in ("empresas", "socios")]
    companies, partners = (spark.read.parquet(path) for path in inputs)
    with wide_shuffle(spark, bytes_of(spark, *inputs)), measured_broadcasts(spark):
        return write_run(enriched_companies(companies, partners), run_path(root, "gold", run_id, "resultado_final"), fingerprint=True)


def result(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The enriched table of a run in the types of the published one."""
    return coerce_schema(spark.read.parquet(run_path(root, "gold", run_id, "resultado_final")), ENRICHED)


def result_bytes(spark: SparkSession, root: str, run_id: str) -> int:
    return bytes_of(spark, run_path(root, "gold", run_id, "resultado_final"))


def load(
    spark: SparkSession,
    root: str,
    run_id: str,
    target: str,
    order_by: str | Sequence[str] | None = None,
    as_of: datetime | None = None,
) -> int:
    """Upsert the run's result into the bucketed table at ``target``; returns how many rows it brings.

    Rows are stamped with ``as_of``, or the current time. Loading a run again is harmless.
    """
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    rows = result(spark, root, run_id).withColumn("updated_at", stamp)
    return upsert_buckets(spark, target, rows, KEY, order_by)


def run(
    spark: SparkSession,
    root: str,
    run_id: str,
    publish: Callable[[DataFrame], int | None] | None = None,
    target: str | None = None,
    manifest: DataFrame | None = None,
    order_by: str | Sequence[str] | None = None,
    as_of: datetime | None = None,
    stages: Sequence[str] = STAGES,
    again: bool = False,
    most_lost: float | Mapping[str, float] | None = None,
    **bronze_options,
) -> list[str]:
    """Run the stages the ledger does not show as done, in order; returns their names.

    Each stage is looked at when its turn comes: if the stage before it has written what it had written before, by the fingerprint in the
    ledger, there is nothing to do. A stage that fails is recorded as such, and stays pending. ``again`` runs the given stages
    whether or not they are done; the next run then redoes the stages after them. ``publish`` replaces the bucketed upsert, for example by
    ``publish_jdbc``. ``manifest`` holds a ``url`` column of everything that must have arrived.
    """
    ledger = f"{root.rstrip('/')}/ledger"

    def load_or_publish() -> int | None:
        if publish is None:
            return load(spark, root, run_id, target or f"{root.rstrip('/')}/published", order_by, as_of)
        with wide_shuffle(spark, result_bytes(spark, root, run_id)):
            return publish(result(spark, root, run_id))

    steps: dict[str, Callable[[], int | None]] = {
        "ingest": lambda: ingest(spark, root, run_id, manifest),
        "bronze": lambda: bronze(spark, root, run_id, **bronze_options),
        "silver": lambda: silver(spark, root, run_id, bronze_options.get("multi_line", False), most_lost),
        "gold": lambda: gold(spark, root, run_id),
        "load": load_or_publish,
    }
    latest = newest_rows(spark, ledger, run_id)
    done = []
    for stage in stages:
        place = STAGES.index(stage)
        before = latest.get(STAGES[place - 1]) if place and STAGES[place - 1] != GATE else None
        # A stage whose predecessor is to do cannot know its input yet.
        if not again and not is_stale(latest.get(stage), before) and not (before and before["status"] != DONE):
            continue
        read = before["output"] if before else None
        try:
            rows = steps[stage]()
        except Exception:
            record_stage(spark, ledger, run_id, stage, status=FAILED)
            raise
        now, written = datetime.now(timezone.utc), getattr(rows, "fingerprint", None)
        record_stage(spark, ledger, run_id, stage, rows, at=now, read=read, written=written)
        # As a row of the ledger comes back: in the driver's own time zone, without naming it.
        latest[stage] = {"status": DONE, "at": now.astimezone().replace(tzinfo=None), "input": read, "output": written}
        done.append(stage)
    return done
