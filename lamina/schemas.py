"""Column names and types of the registry tables, layer by layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

KEY = "cnpj"

# Columns of the two delimited inputs, by position.
COMPANY_COLUMNS = (
    "cnpj",
    "razao_social",
    "natureza_juridica",
    "qualificacao_responsavel",
    "capital_social",
    "cod_porte",
    "ente_federativo_responsavel",
)
PARTNER_COLUMNS = (
    "cnpj",
    "tipo_socio",
    "nome_socio",
    "documento_socio",
    "codigo_qualificacao_socio",
    "data_entrada_sociedade",
    "pais",
    "representante_legal",
    "nome_representante",
    "qualificacao_representante_legal",
    "faixa_etaria",
)

# Words that mark an archive as holding an entity.
ENTITY_WORDS = {"empresas": ("empresa",), "socios": ("socio", "sócio")}

# Partner kind counted as foreign, size class of the target rule.
FOREIGN_PARTNER = 3
TARGET_SIZE = "03"

# Fixed value: stages of a run, in order.
STAGES = ("ingest", "bronze", "silver", "gold", "load")

# The stage that only checks what has arrived.
GATE = "ingest"


def raw_schema(width: int) -> StructType:
    """``width`` string columns named as a header-less scan names them."""
    return StructType([StructField(f"_c{i}", StringType()) for i in range(width)])


# Columns of the published table, in order, and their types.
ENRICHED = StructType(
    [
        StructField("cnpj", StringType()),
        StructField("razao_social", StringType()),
        StructField("natureza_juridica", IntegerType()),
        StructField("capital_social", DoubleType()),
        StructField("cod_porte", StringType()),
        StructField("qtde_socios", LongType()),
        StructField("flag_socio_estrangeiro", BooleanType()),
        StructField("doc_alvo", BooleanType()),
    ]
)

CAST_LOSSES = StructType(
    [
        StructField("entity", StringType()),
        StructField("column", StringType()),
        StructField("n_set", LongType()),
        StructField("n_lost", LongType()),
    ]
)

LEDGER = StructType(
    [
        StructField("run_id", StringType()),
        StructField("stage", StringType()),
        StructField("status", StringType()),
        StructField("rows", LongType()),
        StructField("at", TimestampType()),
        StructField("input", StringType()),
        StructField("output", StringType()),
    ]
)
