"""Bronze to gold: build, store and gate every layer (K6, K7, Q7)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality, staging
from ..operators.quality import QualityError
from ..sources import calendar, seeds
from ..sources.tables import Inputs
from . import checks, dimensions, facts, lineage, silver

SILVER = "silver"
GOLD = "gold"
SEEDS = ("uf_ibge", "faixa_etaria", "meta_vacinal")


@dataclass
class Build:
    """Outcome of a run: stored tables, warnings, and what was not built and why."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    failures: dict[str, str] = field(default_factory=dict)

    def report(self, spark: SparkSession) -> DataFrame:
        """(modelo, situacao, motivo): what was built, failed its checks, or was skipped and why."""
        failed = [(name,) for name in self.failures if name in self.tables]
        return lineage.outcomes(
            lineage.edges(spark, dependencies(spark)), spark.createDataFrame(failed, "tabela string")
        )

    def star(self) -> facts.Star:
        t = self.tables
        return facts.Star(
            fato=t[checks.FACT],
            tempo=t["dim_tempo"],
            municipio=t["dim_municipio"],
            vacina=t["dim_vacina"],
            faixa=t["faixa_etaria"],
            perfil=t["dim_perfil_paciente"],
            estrategia=t["dim_estrategia_vacinacao"],
            meta=t["meta_vacinal"],
        )


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    needs: tuple[str, ...]
    make: Callable[[Build], DataFrame]


def _models(spark: SparkSession, source: Inputs, start: str, end: str) -> list[Model]:
    doses = checks.DOSES
    towns = checks.MUNICIPALITIES
    dims = (
        "dim_tempo",
        "dim_municipio",
        "dim_vacina",
        "dim_perfil_paciente",
        "dim_estrategia_vacinacao",
        "faixa_etaria",
    )

    def from_silver(build: Callable[[DataFrame], DataFrame]) -> Callable[[Build], DataFrame]:
        return lambda b: build(b.tables[doses])

    return [
        Model(doses, SILVER, ("uf_ibge",), lambda b: silver.doses_aplicadas(source.bronze, b.tables["uf_ibge"])),
        Model(towns, SILVER, (), lambda b: silver.municipios(source.diretorio, source.populacao)),
        Model("dim_tempo", GOLD, (), lambda b: dimensions.dim_tempo(spark, start, end)),
        Model(
            "dim_municipio",
            GOLD,
            (doses, towns),
            lambda b: dimensions.dim_municipio(b.tables[doses], b.tables[towns]),
        ),
        Model("dim_vacina", GOLD, (doses,), from_silver(dimensions.dim_vacina)),
        Model("dim_perfil_paciente", GOLD, (doses,), from_silver(dimensions.dim_perfil_paciente)),
        Model(
            "dim_estrategia_vacinacao",
            GOLD,
            (doses,),
            from_silver(dimensions.dim_estrategia_vacinacao),
        ),
        Model(
            checks.FACT,
            GOLD,
            (doses, "faixa_etaria"),
            lambda b: facts.fct_cobertura_vacinal(b.tables[doses], b.tables["faixa_etaria"]),
        ),
        Model(
            checks.MART,
            GOLD,
            (checks.FACT, *dims),
            lambda b: facts.mart_cobertura_vacinal(b.star()),
        ),
        Model(
            checks.SUMMARY,
            GOLD,
            (checks.FACT, *dims),
            lambda b: facts.mart_cobertura_vacinal_resumo(b.star()),
        ),
    ]


def dependencies(spark: SparkSession) -> dict[str, tuple[str, ...]]:
    """What each model and seed is built from."""
    models = _models(spark, None, calendar.DEFAULT_START, calendar.DEFAULT_END)
    return {**dict.fromkeys(SEEDS, ()), **{m.name: m.needs for m in models}}


def _check(build: Build, name: str) -> None:
    """Run the checks of one stored table whose parents exist; record the outcome."""
    due = [c for c in checks.checks_of(name) if c.parent is None or c.parent in build.tables]
    if not due:
        return
    try:
        build.warnings += quality.gate(quality.run_checks(build.tables, due))
    except QualityError as problem:
        build.failures[name] = str(problem)


def build(
    spark: SparkSession,
    source: Inputs,
    base: str,
    namespace: str = "",
    start: str = calendar.DEFAULT_START,
    end: str = calendar.DEFAULT_END,
) -> Build:
    """Build every model below ``base``; a failed error check skips its dependents.

    Silver is stored once and read by every gold model, so typing and
    deduplication run once per build and each reader scans only its columns.
    ``namespace`` prefixes the layer folders, for builds kept apart.
    """
    result = Build()
    for name in SEEDS:
        result.tables[name] = getattr(seeds, name)(spark)
        _check(result, name)
    for model in _models(spark, source, start, end):
        broken = [n for n in model.needs if n in result.failures or n not in result.tables]
        if broken:
            result.failures[model.name] = f"skipped: {', '.join(broken)} failed"
            continue
        stored = staging.as_table(model.make(result), base, namespace + model.layer, model.name)
        result.tables[model.name] = stored
        _check(result, model.name)
    return result
