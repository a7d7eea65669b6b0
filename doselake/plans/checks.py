"""The declared checks of silver, gold and seeds (58), and layer reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import ACCEPTED, NOT_NULL, RELATED, UNIQUE, WARN, Check

DOSES = "stg_pni__doses_aplicadas"
MUNICIPALITIES = "stg_ibge__municipios"
FACT = "fct_cobertura_vacinal"
MART = "mart_cobertura_vacinal"
SUMMARY = "mart_cobertura_vacinal_resumo"

# --- fixed values: which columns carry which check ---------------------------------
_UNIQUE = {
    DOSES: ["codigo_documento"],
    MUNICIPALITIES: ["id_municipio", "id_municipio_6d"],
    "dim_tempo": ["mes"],
    "dim_municipio": ["chave_municipio"],
    "dim_vacina": ["chave_vacina"],
    "dim_perfil_paciente": ["chave_perfil"],
    "dim_estrategia_vacinacao": ["chave_estrategia"],
    "faixa_etaria": ["ordem", "nome_faixa_etaria"],
    "meta_vacinal": ["ordem"],
}
_NOT_NULL = {
    DOSES: [
        "codigo_documento",
        "data_vacina",
        "uf_cobertura",
        "raca_cor_cobertura",
        "nome_raca_cor_cobertura",
        "sexo_cobertura",
        "estrategia_cobertura",
        "nome_vacina_cobertura",
        "nome_dose_cobertura",
        "nome_estrategia_cobertura",
    ],
    MUNICIPALITIES: ["id_municipio", "id_municipio_6d", "nome_municipio", "nome_regiao"],
    "dim_tempo": ["mes"],
    "dim_municipio": ["chave_municipio"],
    "dim_vacina": ["chave_vacina", "nome_vacina", "nome_dose"],
    "dim_perfil_paciente": ["chave_perfil"],
    "dim_estrategia_vacinacao": ["chave_estrategia", "nome_estrategia"],
    FACT: [
        "mes_vacina",
        "chave_municipio",
        "chave_vacina",
        "chave_faixa_etaria",
        "chave_perfil",
        "chave_estrategia",
        "qtd_doses",
    ],
    "faixa_etaria": ["ordem", "nome_faixa_etaria"],
    "meta_vacinal": ["ordem", "vacina", "meta_cobertura"],
}
_VALID_ONLY = "tipo_registro = 'Município válido'"
_NOT_NULL_WARN = [
    Check(MUNICIPALITIES, "populacao", NOT_NULL, WARN),
    Check("dim_municipio", "nome_municipio", NOT_NULL, WARN, _VALID_ONLY),
    Check("dim_municipio", "nome_regiao", NOT_NULL, WARN, _VALID_ONLY),
    Check("dim_municipio", "populacao", NOT_NULL, WARN, _VALID_ONLY),
]
_ACCEPTED = [
    Check(DOSES, "raca_cor_cobertura", ACCEPTED, values=("01", "02", "03", "04", "05", "99")),
    Check(DOSES, "sexo_cobertura", ACCEPTED, values=("F", "M", "SEM INFORMACAO")),
    Check(
        MUNICIPALITIES,
        "nome_regiao",
        ACCEPTED,
        WARN,
        values=("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul"),
    ),
]
_PARENTS = {
    "mes_vacina": ("dim_tempo", "mes"),
    "chave_municipio": ("dim_municipio", "chave_municipio"),
    "chave_vacina": ("dim_vacina", "chave_vacina"),
    "chave_faixa_etaria": ("faixa_etaria", "ordem"),
    "chave_perfil": ("dim_perfil_paciente", "chave_perfil"),
    "chave_estrategia": ("dim_estrategia_vacinacao", "chave_estrategia"),
}
# --------------------------------------------------------------------------------------

CHECKS: list[Check] = [
    *[Check(t, c, UNIQUE) for t, columns in _UNIQUE.items() for c in columns],
    *[Check(t, c, NOT_NULL) for t, columns in _NOT_NULL.items() for c in columns],
    *_NOT_NULL_WARN,
    *_ACCEPTED,
    *[
        Check(FACT, c, RELATED, parent=parent, parent_key=key)
        for c, (parent, key) in _PARENTS.items()
    ],
]


def checks_of(table: str) -> list[Check]:
    return [c for c in CHECKS if c.table == table]


def checks_by_kind(kind: str) -> list[Check]:
    return [c for c in CHECKS if c.kind == kind]


def _total(layer: str, totals: DataFrame) -> DataFrame:
    return totals.select(F.lit(layer).alias("camada"), F.col("doses").cast("bigint").alias("doses"))


def layer_totals(
    bronze: DataFrame, silver: DataFrame, fact: DataFrame, summary: DataFrame
) -> DataFrame:
    """Q9: doses per layer; equal in every layer when nothing was lost or fanned out.

    Bronze counts live documents, a missing document code being one document.
    """
    live = bronze.filter(F.col("dt_deletado_rnds").isNull())
    documents = live.agg(
        (
            F.count_distinct("co_documento")
            + F.coalesce(F.max(F.col("co_documento").isNull().cast("int")), F.lit(0))
        ).alias("doses")
    )
    layers = [
        _total("bronze", documents),
        _total("silver", silver.agg(F.count("*").alias("doses"))),
        _total("fato", fact.agg(F.sum("qtd_doses").alias("doses"))),
        _total("resumo", summary.agg(F.sum("qtd_doses").alias("doses"))),
    ]
    return reduce(DataFrame.unionByName, layers)


def unreconciled_keys(recomputed: DataFrame, stored: DataFrame) -> DataFrame:
    """Key combinations whose doses differ between the two facts, with both numbers.

    Both sides go through one aggregate, so no join meets a hot or null key.
    """
    keys = [c for c in recomputed.columns if c != "qtd_doses"]
    none = F.lit(0).cast("bigint")
    left = recomputed.select(*keys, F.col("qtd_doses").alias("recalculado"), none.alias("gravado"))
    right = stored.select(*keys, none.alias("recalculado"), F.col("qtd_doses").alias("gravado"))
    return (
        left.unionByName(right)
        .groupBy(*keys)
        .agg(F.sum("recalculado").alias("recalculado"), F.sum("gravado").alias("gravado"))
        .filter("recalculado <> gravado")
    )
