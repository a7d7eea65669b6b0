"""Dimensions of the monthly star (M3, M4, M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import clean, place
from ..sources import calendar

# --- fixed values: labels and codes of the municipality dimension -----------------
VALID = "Município válido"
NO_INFORMATION = "Sem informação"
FOREIGN = "Estrangeiro"
CAPITAL_REGION = "Região administrativa do DF (aprox. Brasília)"
STATE_ONLY = "UF sem município específico"
CAPITAL_CODE = "530010"
CAPITAL_PREFIX = "53"
STATE_ONLY_SUFFIX = "0000"
SEX_LABELS = {"F": "Feminino", "M": "Masculino"}
# ------------------------------------------------------------------------------------


def dim_tempo(
    spark: SparkSession,
    start: str = calendar.DEFAULT_START,
    end: str = calendar.DEFAULT_END,
) -> DataFrame:
    number = F.month("mes")
    return calendar.months(spark, start, end).select(
        "mes",
        F.year("mes").cast("bigint").alias("ano"),
        number.cast("bigint").alias("mes_numero"),
        cal.month_name(number).alias("nome_mes"),
        F.quarter("mes").cast("bigint").alias("trimestre"),
    )


def municipality_members(silver: DataFrame) -> DataFrame:
    return silver.select("municipio_cobertura", "uf_cobertura").distinct()


def _stand_ins(directory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What fills in for a code the directory lacks: the capital's row, and the
    region of each state."""
    capital = directory.filter(F.col("id_municipio_6d") == CAPITAL_CODE).select(
        # Every code with the capital's prefix meets this row: an equi-key.
        place.uf_prefix(F.col("id_municipio_6d")).alias("_prefix"),
        F.col("nome_municipio").alias("_b_nome"),
        F.col("nome_regiao").alias("_b_regiao"),
        F.col("populacao").alias("_b_populacao"),
        F.col("ano_populacao").alias("_b_ano"),
    )
    regions = directory.select(
        F.col("sigla_uf").alias("_uf"), F.col("nome_regiao").alias("_uf_regiao")
    ).distinct()
    return capital, regions


def _record_type(code, uf, listed_name, capital_name, uf_region):
    unlisted = listed_name.isNull()
    return (
        F.when(uf == clean.NO_INFORMATION, NO_INFORMATION)
        .when(uf == clean.FOREIGN, FOREIGN)
        .when(unlisted & code.startswith(CAPITAL_PREFIX) & capital_name.isNotNull(), CAPITAL_REGION)
        .when(unlisted & code.endswith(STATE_ONLY_SUFFIX) & uf_region.isNotNull(), STATE_ONLY)
        .otherwise(VALID)
    )


def dim_municipio(silver: DataFrame, directory: DataFrame) -> DataFrame:
    """Every (municipality, state) seen, named and sized from the directory.

    The stand-ins are equi-joins, so no side has to be broadcast: Catalyst and
    AQE broadcast by measured size and fall back to a shuffled join.
    """
    listed = directory.select(
        F.col("id_municipio_6d").alias("_id6"),
        F.col("nome_municipio").alias("_i_nome"),
        F.col("nome_regiao").alias("_i_regiao"),
        F.col("populacao").alias("_i_populacao"),
        F.col("ano_populacao").alias("_i_ano"),
    )
    capital, regions = _stand_ins(directory)
    code, uf = F.col("municipio_cobertura"), F.col("uf_cobertura")
    unlisted = F.col("_i_nome").isNull()

    joined = (
        municipality_members(silver)
        .join(listed, code == F.col("_id6"), "left")
        .join(capital, (place.uf_prefix(code) == F.col("_prefix")) & unlisted, "left")
        .join(regions, (uf == F.col("_uf")) & unlisted, "left")
    )
    special_region = F.when(uf.isin(clean.NO_INFORMATION, clean.FOREIGN), uf)
    return joined.select(
        place.natural_key(code, uf).alias("chave_municipio"),
        code.alias("codigo_ibge"),
        uf.alias("uf"),
        F.coalesce("_i_nome", "_b_nome").alias("nome_municipio"),
        F.coalesce(F.col("_i_regiao"), F.col("_b_regiao"), F.col("_uf_regiao"), special_region).alias(
            "nome_regiao"
        ),
        F.coalesce("_i_populacao", "_b_populacao").alias("populacao"),
        F.coalesce("_i_ano", "_b_ano").alias("ano_populacao"),
        _record_type(code, uf, F.col("_i_nome"), F.col("_b_nome"), F.col("_uf_regiao")).alias(
            "tipo_registro"
        ),
    )


def dim_vacina(silver: DataFrame) -> DataFrame:
    members = silver.select(
        "co_vacina",
        "co_dose_vacina",
        F.col("nome_vacina_cobertura").alias("nome_vacina"),
        F.col("nome_dose_cobertura").alias("nome_dose"),
    ).distinct()
    key = clean.composite_key(F.col("co_vacina"), F.col("co_dose_vacina"))
    return members.select(key.alias("chave_vacina"), "*")


def dim_perfil_paciente(silver: DataFrame) -> DataFrame:
    members = silver.select(
        F.col("raca_cor_cobertura").alias("codigo_raca_cor"),
        F.col("nome_raca_cor_cobertura").alias("nome_raca_cor"),
        F.col("sexo_cobertura").alias("sexo"),
    ).distinct()
    label = F.lit(NO_INFORMATION)
    for code, name in SEX_LABELS.items():
        label = F.when(F.col("sexo") == code, name).otherwise(label)
    key = clean.composite_key(F.col("codigo_raca_cor"), F.col("sexo"))
    return members.select(key.alias("chave_perfil"), "*", label.alias("nome_sexo"))


def dim_estrategia_vacinacao(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("estrategia_cobertura").alias("chave_estrategia"),
        F.col("nome_estrategia_cobertura").alias("nome_estrategia"),
    ).distinct()
