"""Table scans (S8) and the column contracts of the layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: column names of the published bronze layout the silver reads --
BRONZE_COLUMNS = [
    "co_documento",
    "dt_vacina",
    "dt_entrada_rnds",
    "dt_deletado_rnds",
    "co_municipio_estabelecimento",
    "co_municipio_paciente",
    "co_pais_paciente",
    "co_vacina",
    "ds_nome",
    "co_dose_vacina",
    "ds_tipo_dose",
    "co_estrategia_vacinacao",
    "no_estrategia",
    "sg_uf_paciente",
    "sg_uf_estabelecimento",
    "nu_idade_paciente",
    "co_raca_cor_paciente",
    "no_raca_cor_paciente",
    "tp_sexo_paciente",
]
# ----------------------------------------------------------------------------------

MONTH_COLUMN = "mes_referencia"


@dataclass(frozen=True)
class Inputs:
    """The three external tables a build starts from."""

    bronze: DataFrame
    diretorio: DataFrame
    populacao: DataFrame


def scan(spark: SparkSession, location: str) -> DataFrame:
    """Read a path as Parquet, or a catalog name as a table."""
    if "/" in location or ":" in location:
        return spark.read.parquet(location)
    return spark.table(location)


def inputs(spark: SparkSession, bronze: str, diretorio: str, populacao: str) -> Inputs:
    return Inputs(scan(spark, bronze), scan(spark, diretorio), scan(spark, populacao))
