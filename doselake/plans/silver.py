"""Silver: typed, deduplicated, geography-resolved doses (M1) and the
municipality directory with its latest population (M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, place
from ..operators.latest import keep_latest
from ..sources.tables import BRONZE_COLUMNS

# Output names of the raw columns that change name on the way to silver.
_RENAMED = {
    "codigo_documento": "co_documento",
    "data_deletado_rnds": "dt_deletado_rnds",
    "nome_vacina_bruto": "ds_nome",
    "nome_dose_bruto": "ds_tipo_dose",
    "nome_estrategia_bruto": "no_estrategia",
}
_KEPT = [
    "co_municipio_estabelecimento",
    "co_municipio_paciente",
    "co_pais_paciente",
    "co_vacina",
    "co_dose_vacina",
    "co_estrategia_vacinacao",
    "sg_uf_paciente",
    "sg_uf_estabelecimento",
    "co_raca_cor_paciente",
    "no_raca_cor_paciente",
    "tp_sexo_paciente",
]
# Also the tie-break among equal entries, in this order.
_VERSION_COLUMNS = [c for c in BRONZE_COLUMNS if c not in ("co_documento", "dt_deletado_rnds")]

LAST_POPULATION_YEAR = 2025
SIX_DIGITS = 6


def live_documents(bronze: DataFrame) -> DataFrame:
    """Raw columns of the newest live version of every document.

    Deleted versions leave before the choice, so an older live version can
    surface. Only the raw columns cross the shuffle; every derived column is
    computed after it.
    """
    live = bronze.filter(F.col("dt_deletado_rnds").isNull())
    entered = clean.to_timestamp(F.col("dt_entrada_rnds"))
    newest = keep_latest(live, "co_documento", entered, _VERSION_COLUMNS)
    return newest.withColumn("dt_deletado_rnds", F.lit(None).cast("string"))


def resolve_place(doses: DataFrame, uf_ibge: DataFrame) -> DataFrame:
    """Add ``origem_local``, ``municipio_cobertura``, ``uf_cobertura``
    and the two candidates ``uf_direta`` / ``uf_derivada`` the state came from."""
    path = F.col("origem_local")
    located = (
        doses.withColumn(
            "origem_local",
            place.origin(F.col("co_pais_paciente"), F.col("co_municipio_paciente")),
        )
        .withColumn(
            "municipio_cobertura",
            place.municipality(
                path, F.col("co_municipio_paciente"), F.col("co_municipio_estabelecimento")
            ),
        )
        .withColumn(
            "uf_direta",
            place.direct_uf(path, F.col("sg_uf_paciente"), F.col("sg_uf_estabelecimento")),
        )
    )
    by_prefix = uf_ibge.select(
        F.col("co_uf").cast("string").alias("_prefix"), F.col("sg_uf").alias("uf_derivada")
    )
    return (
        located.join(
            F.broadcast(by_prefix),
            place.uf_prefix(F.col("municipio_cobertura")) == F.col("_prefix"),
            "left",
        )
        .drop("_prefix")
        .withColumn(
            "uf_cobertura", place.coverage_uf(path, F.col("uf_direta"), F.col("uf_derivada"))
        )
    )


def doses_aplicadas(bronze: DataFrame, uf_ibge: DataFrame) -> DataFrame:
    """M1: one row per live document."""
    located = resolve_place(live_documents(bronze), uf_ibge)
    return located.select(
        *[F.col(raw).alias(name) for name, raw in _RENAMED.items()],
        *_KEPT,
        clean.to_date(F.col("dt_vacina")).alias("data_vacina"),
        clean.to_timestamp(F.col("dt_entrada_rnds")).alias("data_entrada_rnds"),
        clean.to_long(F.col("nu_idade_paciente")).alias("idade_paciente"),
        "municipio_cobertura",
        "uf_cobertura",
        clean.default(F.col("co_raca_cor_paciente"), clean.UNKNOWN_RACE).alias(
            "raca_cor_cobertura"
        ),
        clean.default(F.col("no_raca_cor_paciente")).alias("nome_raca_cor_cobertura"),
        clean.sex(F.col("tp_sexo_paciente")).alias("sexo_cobertura"),
        clean.default(F.col("co_estrategia_vacinacao")).alias("estrategia_cobertura"),
        clean.default(F.col("ds_nome")).alias("nome_vacina_cobertura"),
        clean.default(F.col("ds_tipo_dose")).alias("nome_dose_cobertura"),
        clean.default(F.col("no_estrategia")).alias("nome_estrategia_cobertura"),
    )


def latest_population(populacao: DataFrame, last_year: int = LAST_POPULATION_YEAR) -> DataFrame:
    """Newest filled estimate per municipality, up to ``last_year``."""
    filled = populacao.filter((F.col("ano") <= last_year) & F.col("populacao").isNotNull())
    return keep_latest(filled, "id_municipio", F.col("ano"), ["ano", "populacao"])


def municipios(
    diretorio: DataFrame, populacao: DataFrame, last_year: int = LAST_POPULATION_YEAR
) -> DataFrame:
    """M2: directory with the six-digit key and the latest population."""
    newest = latest_population(populacao, last_year)
    return diretorio.join(newest, "id_municipio", "left").select(
        "id_municipio",
        F.substring("id_municipio", 1, SIX_DIGITS).alias("id_municipio_6d"),
        F.col("nome").alias("nome_municipio"),
        "sigla_uf",
        "nome_regiao",
        "populacao",
        F.col("ano").alias("ano_populacao"),
    )
