"""Monthly fact and the denormalised marts (M6, M7, M8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import clean, place
from ..operators.bands import with_band

FACT_KEYS = [
    "mes_vacina",
    "chave_municipio",
    "chave_vacina",
    "chave_faixa_etaria",
    "chave_perfil",
    "chave_estrategia",
]
SUMMARY_KEYS = FACT_KEYS[:4]
UNKNOWN_BAND = 0


@dataclass(frozen=True)
class Star:
    """The gold tables. ``meta`` has no relation to the fact, on purpose."""

    fato: DataFrame
    tempo: DataFrame
    municipio: DataFrame
    vacina: DataFrame
    faixa: DataFrame
    perfil: DataFrame
    estrategia: DataFrame
    meta: DataFrame


@dataclass(frozen=True)
class Relation:
    """How a dimension of the star hangs on the fact, and what it contributes."""

    table: str
    fact_key: str
    key: str
    attributes: tuple[str, ...]


RELATIONS = (
    Relation("tempo", "mes_vacina", "mes", ("ano", "mes_numero", "nome_mes", "trimestre")),
    Relation(
        "municipio",
        "chave_municipio",
        "chave_municipio",
        (
            "codigo_ibge",
            "uf",
            "nome_municipio",
            "nome_regiao",
            "populacao",
            "ano_populacao",
            "tipo_registro",
        ),
    ),
    Relation("vacina", "chave_vacina", "chave_vacina", ("nome_vacina", "nome_dose")),
    Relation(
        "faixa",
        "chave_faixa_etaria",
        "ordem",
        ("nome_faixa_etaria", "idade_min", "idade_max"),
    ),
    Relation(
        "perfil",
        "chave_perfil",
        "chave_perfil",
        ("codigo_raca_cor", "nome_raca_cor", "sexo", "nome_sexo"),
    ),
    Relation("estrategia", "chave_estrategia", "chave_estrategia", ("nome_estrategia",)),
)


def keyed_doses(silver: DataFrame, bands: DataFrame) -> DataFrame:
    """One row per dose with the six keys of the star."""
    banded = with_band(silver, F.col("idade_paciente"), bands, name="_faixa")
    return banded.select(
        cal.month_start(F.col("data_vacina")).alias("mes_vacina"),
        place.natural_key(F.col("municipio_cobertura"), F.col("uf_cobertura")).alias(
            "chave_municipio"
        ),
        clean.composite_key(F.col("co_vacina"), F.col("co_dose_vacina")).alias("chave_vacina"),
        F.coalesce("_faixa", F.lit(UNKNOWN_BAND)).alias("chave_faixa_etaria"),
        clean.composite_key(F.col("raca_cor_cobertura"), F.col("sexo_cobertura")).alias(
            "chave_perfil"
        ),
        F.col("estrategia_cobertura").alias("chave_estrategia"),
    )


def fct_cobertura_vacinal(silver: DataFrame, bands: DataFrame) -> DataFrame:
    """Doses per month and key combination; counted map-side before the shuffle."""
    return keyed_doses(silver, bands).groupBy(*FACT_KEYS).agg(F.count("*").alias("qtd_doses"))


def denormalise(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], keys: Sequence[str] = FACT_KEYS
) -> DataFrame:
    """Left-join every dimension of ``keys``; each key is followed by its attributes.

    A dimension below the broadcast threshold is broadcast by its size; a larger
    one is joined by a shuffle, where AQE splits hot keys.
    """
    wide, columns = fact, []
    for relation in RELATIONS:
        if relation.fact_key not in keys:
            continue
        key = f"_{relation.table}_key"
        side = dimensions[relation.table].select(
            F.col(relation.key).alias(key), *relation.attributes
        )
        wide = wide.join(side, F.col(relation.fact_key) == F.col(key), "left").drop(key)
        columns += [relation.fact_key, *relation.attributes]
    return wide.select(*columns, "qtd_doses")


def _dimensions(star: Star) -> dict[str, DataFrame]:
    return {relation.table: getattr(star, relation.table) for relation in RELATIONS}


def mart_cobertura_vacinal(star: Star) -> DataFrame:
    """M7: the fact with all six dimensions, at the fact's grain."""
    return denormalise(star.fato, _dimensions(star))


def summary_fact(fact: DataFrame) -> DataFrame:
    """A2: the fact summed over profile and strategy."""
    return fact.groupBy(*SUMMARY_KEYS).agg(F.sum("qtd_doses").alias("qtd_doses"))


def mart_cobertura_vacinal_resumo(star: Star) -> DataFrame:
    """M8: the four-key summary with its four dimensions."""
    return denormalise(summary_fact(star.fato), _dimensions(star), SUMMARY_KEYS)
