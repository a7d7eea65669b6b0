"""Every operator as a named query over the derived dose tables.

The tables of a build (bronze, silver, gold) are written once per session and
test folder below the shared folder, as a build would store them, and read back
by the queries of the layers above. A query of a layer computes that layer.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import clean, names, place
from .operators import digests, incremental, load, profiling, quality, sketches, snapshots, staging
from .operators.bands import with_band
from .plans import checks, dimensions, facts, lineage, measures, pipeline, silver
from .session import prepare, shared_folder
from .sources import derived, drops, seeds
from .sources.tables import BRONZE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]


# The year that is loaded again, and its months that fail at first: one has line breaks
# inside quotes, one has rows of the wrong width.
RELOADED_YEAR = "1998"
BROKEN_MONTH = "1998-06"
UNEVEN_MONTH = "1998-03"


@dataclass(frozen=True)
class Reloads:
    """A bronze table of several loads; ``then`` is what it held after the one with failures."""

    table: str
    log: str
    second: str
    failed: load.LoadReport
    then: DataFrame


class Lake:
    """The stored tables of one test folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.base = shared_folder(spark)
        self.sorted_drops = False
        self._contenders: incremental.Contenders | None = None

    def _store(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        return staging.as_table(df, self.base, layer, name)

    @cached_property
    def uf_ibge(self) -> DataFrame:
        return seeds.uf_ibge(self.spark)

    @cached_property
    def bands(self) -> DataFrame:
        return seeds.faixa_etaria(self.spark)

    @cached_property
    def bronze(self) -> DataFrame:
        rows = derived.bronze(self.spark, self.sf_dir)
        return staging.as_table(rows, self.base, "bronze", "doses_aplicadas_pni", "mes_referencia", dealt=True)

    @cached_property
    def directory(self) -> DataFrame:
        return self._store(derived.directory(self.spark, self.sf_dir), "bronze", "diretorio")

    @cached_property
    def population(self) -> DataFrame:
        rows = derived.population(self.spark, self.directory)
        return self._store(rows, "bronze", "populacao")

    @cached_property
    def silver(self) -> DataFrame:
        rows = silver.doses_aplicadas(self.bronze, self.uf_ibge)
        return self._store(rows, "silver", checks.DOSES)

    @cached_property
    def towns(self) -> DataFrame:
        rows = silver.municipios(self.directory, self.population)
        return self._store(rows, "silver", checks.MUNICIPALITIES)

    @cached_property
    def star(self) -> facts.Star:
        doses = self.silver
        gold = {
            "tempo": dimensions.dim_tempo(
                self.spark, derived.CALENDAR_START, derived.CALENDAR_END
            ),
            "municipio": dimensions.dim_municipio(doses, self.towns),
            "vacina": dimensions.dim_vacina(doses),
            "perfil": dimensions.dim_perfil_paciente(doses),
            "estrategia": dimensions.dim_estrategia_vacinacao(doses),
            "fato": facts.fct_cobertura_vacinal(doses, self.bands),
        }
        stored = {name: self._store(df, "gold", name) for name, df in gold.items()}
        return facts.Star(
            **stored, faixa=self.bands, meta=seeds.meta_vacinal(self.spark)
        )

    @cached_property
    def mart(self) -> DataFrame:
        return self._store(facts.mart_cobertura_vacinal(self.star), "gold", checks.MART)

    @cached_property
    def summary(self) -> DataFrame:
        rows = facts.mart_cobertura_vacinal_resumo(self.star)
        return self._store(rows, "gold", checks.SUMMARY)

    @cached_property
    def csv_folder(self) -> str:
        """The bronze rows as monthly CSV drops."""
        folder = f"{self.base}/remessas"
        derived.write_drops(self.bronze, folder)
        return folder

    @cached_property
    def loaded(self) -> tuple[str, load.LoadReport]:
        """Bronze loaded from the CSV drops: table folder and report."""
        table = f"{self.base}/csv/doses_aplicadas_pni"
        report = load.load(self.spark, self.csv_folder, table, f"{self.base}/csv/_carga_log")
        return table, report

    def contenders(self, first: DataFrame, again: DataFrame) -> incremental.Contenders:
        """The contenders of ``first``, of which ``again`` replaced some months; stored once."""
        if self._contenders is None:
            name = f"disputa_{self.base.rpartition('-')[2]}"
            rest = [c for c in BRONZE_COLUMNS if c not in ("co_documento", "dt_deletado_rnds")]
            made = incremental.Contenders(
                self.spark, name, f"{self.base}/disputa", "co_documento", "mes_referencia", rest, buckets=8
            )
            entered = clean.to_timestamp(F.col("dt_entrada_rnds"))
            made.create(first, entered)
            made.replace(again, entered)
            self._contenders = made
        return self._contenders

    @cached_property
    def quoted(self) -> DataFrame:
        """Bronze loaded from drops with a line break and a quote inside every vaccine name."""
        base = f"{self.base}/aspas"
        name = F.replace(F.col("ds_nome"), F.lit(" "), F.lit('\n"'))
        derived.write_drops(self.bronze.withColumn("ds_nome", name), f"{base}/remessas")
        table = f"{base}/doses_aplicadas_pni"
        report = load.load(self.spark, f"{base}/remessas", table, f"{base}/_carga_log", gate=load.RECORDS)
        report.raise_for_problems()
        return load.bronze_table(self.spark, table)

    @cached_property
    def reloads(self) -> Reloads:
        """Every month loaded; then one year again without its deleted rows, of which two months
        fail; then those two."""
        base = f"{self.base}/recarga"
        table, log = f"{base}/doses_aplicadas_pni", f"{base}/_carga_log"
        live = F.col("mes_referencia").startswith(RELOADED_YEAR) & F.col("dt_deletado_rnds").isNull()
        corrected = self.bronze.filter(live)
        month = F.col("mes_referencia")
        broken = corrected.filter(month == BROKEN_MONTH)
        derived.write_drops(
            corrected.filter(~month.isin(BROKEN_MONTH, UNEVEN_MONTH)).unionByName(
                broken.withColumn("ds_nome", F.replace(F.col("ds_nome"), F.lit(" "), F.lit("\n")))
            ),
            f"{base}/segunda",
        )
        derived.write_uneven_drops(corrected.filter(month == UNEVEN_MONTH), f"{base}/segunda")
        derived.write_drops(corrected.filter(month.isin(BROKEN_MONTH, UNEVEN_MONTH)), f"{base}/terceira")

        load.load(self.spark, self.csv_folder, table, log).raise_for_problems()
        failed = load.load(self.spark, f"{base}/segunda", table, log, only_new=True)
        then = load.bronze_table(self.spark, table, ["dt_deletado_rnds"])
        load.load(self.spark, f"{base}/terceira", table, log, only_new=True).raise_for_problems()
        load.load(self.spark, self.csv_folder, table, log, only_new=True).raise_for_problems()
        return Reloads(table, log, f"{base}/segunda", failed, then)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        star = self.star
        return {
            checks.DOSES: self.silver,
            checks.MUNICIPALITIES: self.towns,
            "dim_tempo": star.tempo,
            "dim_municipio": star.municipio,
            "dim_vacina": star.vacina,
            "dim_perfil_paciente": star.perfil,
            "dim_estrategia_vacinacao": star.estrategia,
            checks.FACT: star.fato,
            "faixa_etaria": star.faixa,
            "meta_vacinal": star.meta,
        }


_lakes: dict[tuple[str, str], Lake] = {}
# Queries asked for by several threads store each table once.
_building = threading.RLock()


# The columns of a dose hold few values: stored they take a thirtieth of the memory of their
# rows, and a task that combines rows before an exchange sorts all it reads.
SPLIT = "16m"


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lakes:
        _lakes[key] = Lake(prepare(spark), sf_dir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT)
    return _lakes[key]


# --- sources -----------------------------------------------------------------------------


def s1_csv_load(lake: Lake) -> DataFrame:
    table, _ = lake.loaded
    return load.bronze_table(lake.spark, table).drop(load.FILE_COLUMN)


def s1_quoted_newlines(lake: Lake) -> DataFrame:
    """The drops with a line break and a quote inside every vaccine name."""
    return lake.quoted.drop(load.FILE_COLUMN)


def s1_quarantine(lake: Lake) -> DataFrame:
    """Rows of the wrong width by month and reason; the other months of their load are in the table."""
    rejected = load.quarantine(lake.spark, lake.reloads.table)
    return rejected.groupBy("mes_referencia", "motivo", "campos", "colunas").agg(F.count("*").alias("linhas"))


def s2_manifest(lake: Lake) -> DataFrame:
    """What each load found out anew: a drop that was known is not there again."""
    seen = load.manifest_table(lake.spark, lake.reloads.table)
    loads = snapshots.versions(lake.spark, lake.reloads.table).select("carga", "versao")
    return seen.join(loads, "carga").groupBy(
        "versao", "remessa", "mes_referencia", "encoding", "delimitador", F.size("colunas").alias("colunas")
    ).agg(
        F.sum("linhas_no_csv").alias("linhas_no_csv"),
        F.max(F.col("quebra_em_aspas").cast("int")).alias("quebra_em_aspas"),
    )


def s3_sniff(lake: Lake) -> DataFrame:
    """Dry run: format and counts per drop, nothing written."""
    return load.inspect(lake.spark, lake.csv_folder).groupBy(
        "remessa", "mes_referencia", "encoding", "delimitador", F.size("colunas").alias("colunas")
    ).agg(
        F.sum("linhas_no_csv").alias("linhas_no_csv"),
        F.max("quebra_em_aspas").cast("int").alias("quebra_em_aspas"),
    )


def s5_month_from_name(lake: Lake) -> DataFrame:
    """File names in every accepted spelling, derived from the dose months."""
    year = (F.substring("mes_referencia", 1, 4).cast("int") + derived.YEAR_SHIFT).cast("string")
    month = F.substring("mes_referencia", 6, 2)
    short = F.element_at(
        F.array(*[F.lit(a) for a in derived.MONTH_ABBREVIATIONS]), month.cast("int")
    )
    spellings = F.array(
        F.concat(F.lit("pni_"), year, F.lit("_"), month, F.lit(".csv")),
        F.concat(F.lit("PNI"), year, month, F.lit(".CSV")),
        F.concat(F.lit("doses."), month, F.lit("-"), year, F.lit(".csv")),
        F.concat(F.lit("Vacinacao_"), short, F.lit("_"), year, F.lit(".csv")),
        F.concat(year, short, F.lit(".csv")),
        F.concat(F.lit("vacinacao_"), F.substring(year, 3, 2), F.lit(".csv")),
    )
    counted = lake.bronze.groupBy("mes_referencia").agg(F.count("*").alias("linhas"))
    named = counted.select(F.explode(spellings).alias("arquivo"), "linhas")
    return (
        named.withColumn("mes", names.month_of(F.col("arquivo")))
        .groupBy("arquivo", "mes")
        .agg(F.sum("linhas").alias("linhas"))
    )


def s7_hash(lake: Lake) -> DataFrame:
    """Bytes and streamed digest of drops whose contents are known: documents and days in order."""
    folder = f"{lake.base}/ordenadas"
    if not lake.sorted_drops:
        derived.write_sorted_drops(lake.bronze, folder)
        lake.sorted_drops = True
    listed, _ = drops.listing(lake.spark, folder)
    return listed.join(drops.hashes(listed), "uri").select("remessa", "bytes", "arquivo_sha256")


def s9_seed_bands(lake: Lake) -> DataFrame:
    """The band seed in display order, with the doses that fall in each band."""
    keyed = facts.keyed_doses(lake.silver, lake.bands)
    doses = keyed.groupBy("chave_faixa_etaria").agg(F.count("*").alias("doses"))
    bands = lake.bands.join(doses, F.col("ordem") == F.col("chave_faixa_etaria"), "left")
    return seeds.display_order(bands.drop("chave_faixa_etaria"))


def s9_seed_uf(lake: Lake) -> DataFrame:
    doses = lake.silver.groupBy("uf_cobertura").agg(F.count("*").alias("doses"))
    return lake.uf_ibge.join(doses, F.col("sg_uf") == F.col("uf_cobertura"), "left").drop(
        "uf_cobertura"
    )


# --- sinks and load control -----------------------------------------------------------------

def k1_partition_replace(lake: Lake) -> DataFrame:
    """Every month loaded, then one year again without its deleted rows: those months are
    replaced, the others stay."""
    stored = load.bronze_table(lake.spark, lake.reloads.table, ["dt_deletado_rnds"])
    return stored.groupBy("mes_referencia").agg(
        F.count("*").alias("linhas"), F.count("dt_deletado_rnds").alias("excluidas")
    )


def k1_commit(lake: Lake) -> DataFrame:
    """The table after a load of which two months failed, beside what its log says: those
    months are the old ones."""
    held = lake.reloads.then.groupBy("mes_referencia").agg(
        F.count("*").alias("linhas"), F.count("dt_deletado_rnds").alias("excluidas")
    )
    month = F.date_format("mes_referencia", "yyyy-MM")
    told = lake.reloads.failed.log.groupBy(month.alias("mes_referencia")).agg(
        F.sum("linhas_carregadas").alias("linhas_recebidas"),
        F.min(F.col("reconciliado").cast("int")).alias("reconciliado"),
    )
    return held.join(told, "mes_referencia", "left")


def k2_load_log(lake: Lake) -> DataFrame:
    """The log of all loads, failed files included, summed over the part files of a month.

    Bytes are those of the rows: a drop may have several files, each with its header.
    """
    log = load.load_log(lake.spark, lake.reloads.table, lake.reloads.log)
    loads = snapshots.versions(lake.spark, lake.reloads.table).select("carga", "versao")
    header = len(";".join(derived.display_header(c) for c in BRONZE_COLUMNS))
    accents = sum(not c.isascii() for c in "".join(map(derived.display_header, BRONZE_COLUMNS)))
    of_header = F.lit(header + 1) + F.when(F.col("encoding") == "ISO-8859-1", 0).otherwise(accents)
    drop = F.regexp_extract("arquivo", r"^(.*\.csv)/", 1)
    return log.join(loads, "carga").groupBy(
        "versao", "mes_referencia", drop.alias("remessa"), "encoding", "delimitador", "colunas"
    ).agg(
        F.sum("linhas_no_csv").alias("linhas_no_csv"),
        F.sum("linhas_carregadas").alias("linhas_carregadas"),
        F.min(F.col("reconciliado").cast("int")).alias("reconciliado"),
        F.sum(F.col("arquivo_bytes") - of_header).alias("bytes_das_linhas"),
        (F.count("*") - F.count_distinct("arquivo_sha256")).alias("resumos_repetidos"),
    )


def k3_reconcile(lake: Lake) -> DataFrame:
    """The lines of the second delivery against the rows the table held after it."""
    lines = drops.line_counts(lake.spark, [lake.reloads.second])
    year = str(int(RELOADED_YEAR) + derived.YEAR_SHIFT)
    held = lake.reloads.then.filter(F.col("mes_referencia").startswith(year))
    result = load.reconcile(lines, load.rows_per_file(held, load.FILE_COLUMN))
    return result.groupBy(drops.drop_name(F.col("uri")).alias("remessa")).agg(
        F.sum("linhas_no_csv").alias("linhas_no_csv"),
        F.sum("linhas_carregadas").alias("linhas_carregadas"),
        F.min(F.col("reconciliado").cast("int")).alias("reconciliado"),
    )


def k5_schema_drift(lake: Lake) -> DataFrame:
    """Headers of the CSV drops against the columns silver reads, less one they have
    and plus one they lack."""
    listed, _ = drops.listing(lake.spark, lake.csv_folder)
    headers = listed.join(drops.formats(listed), "uri").select("remessa", "colunas")
    target = [c for c in BRONZE_COLUMNS if c != "no_estrategia"] + ["st_documento"]
    return load.schema_drift(headers, target)


def k6_view(lake: Lake) -> DataFrame:
    """Silver read through a view over bronze, nothing stored in between."""
    view = staging.as_view(silver.doses_aplicadas(lake.bronze, lake.uf_ibge), f"vw_{checks.DOSES}")
    return view.groupBy("uf_cobertura", "sexo_cobertura").agg(F.count("*").alias("doses"))


def k8_publication(lake: Lake) -> DataFrame:
    """Rows and columns of the published mart; its bytes depend on the writer."""
    columns = len(lake.mart.columns)  # stored on first use
    size = staging.publication_size(lake.spark, f"{lake.base}/gold/{checks.MART}")
    return size.select(
        "linhas",
        F.lit(columns).cast("long").alias("colunas"),
        F.expr("arquivos > 0 and bytes > 0").cast("int").alias("publicado"),
    )


# --- silver --------------------------------------------------------------------------------------


def p2_safe_cast_profile(lake: Lake) -> DataFrame:
    return profiling.safe_cast_profile(lake.bronze)


def _placed(lake: Lake) -> DataFrame:
    return silver.resolve_place(lake.bronze, lake.uf_ibge)


def p4_geography_resolution(lake: Lake) -> DataFrame:
    """Rows per path and resulting place (also Q10: how many lack a residence)."""
    return (
        _placed(lake)
        .groupBy("origem_local", "municipio_cobertura", "uf_direta")
        .agg(F.count("*").alias("linhas"))
    )


def p6_uf_fallback(lake: Lake) -> DataFrame:
    return (
        _placed(lake)
        .groupBy("origem_local", "uf_direta", "uf_derivada", "uf_cobertura")
        .agg(F.count("*").alias("linhas"))
    )


def p8_sex_clamp(lake: Lake) -> DataFrame:
    sex = F.col("tp_sexo_paciente")
    return lake.bronze.groupBy(sex, clean.sex(sex).alias("sexo_cobertura")).agg(
        F.count("*").alias("linhas")
    )


def w1_latest_document(lake: Lake) -> DataFrame:
    return silver.live_documents(lake.bronze).select(*BRONZE_COLUMNS)


def w1_incremental(lake: Lake) -> DataFrame:
    """The newest line of every order, after one year was delivered again without first lines.

    An order's lines fall into several months, so months compete, and a version that a
    reload took away lets an older one surface.
    """
    order = lake.bronze.withColumn("co_documento", F.substring_index("co_documento", "-", 1))
    live = order.filter(F.col("dt_deletado_rnds").isNull())
    again = live.filter(F.col("mes_referencia").startswith(RELOADED_YEAR) & (F.col("co_dose_vacina") != "1"))
    return lake.contenders(live, again).winners()


def w2_latest_population(lake: Lake) -> DataFrame:
    return silver.latest_population(lake.population)


def m1_silver(lake: Lake) -> DataFrame:
    return silver.doses_aplicadas(lake.bronze, lake.uf_ibge)


def m2_municipalities(lake: Lake) -> DataFrame:
    return silver.municipios(lake.directory, lake.population)


# --- gold ------------------------------------------------------------------------------------------


def m3_dim_municipality(lake: Lake) -> DataFrame:
    return dimensions.dim_municipio(lake.silver, lake.towns)


def m4_dim_vaccine(lake: Lake) -> DataFrame:
    return dimensions.dim_vacina(lake.silver)


def m4_dim_profile(lake: Lake) -> DataFrame:
    return dimensions.dim_perfil_paciente(lake.silver)


def m4_dim_strategy(lake: Lake) -> DataFrame:
    return dimensions.dim_estrategia_vacinacao(lake.silver)


def m5_calendar(lake: Lake) -> DataFrame:
    """The month dimension over the fixture's years, with the doses of each month."""
    months = dimensions.dim_tempo(lake.spark, derived.CALENDAR_START, derived.CALENDAR_END)
    doses = lake.star.fato.groupBy("mes_vacina").agg(F.sum("qtd_doses").alias("doses"))
    return months.join(doses, F.col("mes") == F.col("mes_vacina"), "left").drop("mes_vacina")


def j6_age_band_counts(lake: Lake) -> DataFrame:
    banded = with_band(lake.silver, F.col("idade_paciente"), lake.bands, name="faixa")
    return banded.groupBy("idade_paciente", "faixa").agg(F.count("*").alias("linhas"))


def m6_fact(lake: Lake) -> DataFrame:
    return facts.fct_cobertura_vacinal(lake.silver, lake.bands)


def m7_mart(lake: Lake) -> DataFrame:
    return facts.mart_cobertura_vacinal(lake.star)


def m8_mart_summary(lake: Lake) -> DataFrame:
    return facts.mart_cobertura_vacinal_resumo(lake.star)


# --- measures ----------------------------------------------------------------------------------------

MEASURE_SLICERS: dict[str, tuple[str, ...]] = {
    "d01": ("uf",),
    "d02": ("uf",),
    "d03": (),
    "d04": (),
    "d05": ("uf",),
    "d06": ("uf",),
    "d07": ("nome_regiao",),
    "d08": ("uf",),
    "d09": ("mes",),
    "d10": ("mes",),
    "d11": ("mes",),
    "d12": ("nome_regiao",),
    "d13": ("nome_regiao",),
    "d14": ("nome_regiao",),
    "d15": (),
    "d16": ("nome_regiao",),
    "d17": (),
    "d18": ("uf",),
    "d19": ("uf",),
    "d20": ("uf",),
}


D08_MONTH = "1998-06-01"


def _measure(name: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: measures.measure(lake.star, name, MEASURE_SLICERS[name])


_SLICED: dict[str, tuple[str, tuple[str, ...]]] = {
    "d02_mes": ("d02", ("mes",)),
    "d03_faixa": ("d03", ("chave_faixa_etaria",)),
    "d04_dose": ("d04", ("nome_dose",)),
    "d09_trimestre": ("d09", ("trimestre",)),
    "d10_ano": ("d10", ("ano",)),
    "d11_ano": ("d11", ("ano",)),
    "d11_total": ("d11", ()),
    "d15_uf_ano": ("d15", ("uf", "ano")),
    "d16_region_mes": ("d16", ("nome_regiao", "mes")),
    "d17_uf": ("d17", ("uf",)),
}


def _sliced(measure: str, by: tuple[str, ...]) -> Callable[[Lake], DataFrame]:
    return lambda lake: measures.measure(lake.star, measure, by)


def d08_uf_vacina(lake: Lake) -> DataFrame:
    """The gap of one month and age band to one vaccine's target: states without such doses
    are as far below it as can be."""
    where = {"mes": lambda c: c == F.lit(D08_MONTH).cast("date"), "chave_faixa_etaria": [1]}
    return measures.measure(lake.star, "d08", ("uf",), where, where_meta={"vacina": ["BCG"]})


def d02_dedup(lake: Lake) -> DataFrame:
    return measures.measure(lake.star, "d02", ("uf",), dedup=True)


def d05_uf_month(lake: Lake) -> DataFrame:
    """The rate by state and month for three bands: population ignores both."""
    return measures.measure(
        lake.star, "d05", ("uf", "mes"), {"chave_faixa_etaria": [1, 2, 3]}
    )


def d10_region_2000(lake: Lake) -> DataFrame:
    """Month over month by region in one year; January looks back to December."""
    return measures.measure(lake.star, "d10", ("nome_regiao", "mes"), {"ano": [2000]})


def d15_worst(lake: Lake) -> DataFrame:
    return measures.piores_municipios(measures.context(lake.star), 20)


# --- quality and profiles --------------------------------------------------------------------------------


def _checks(kind: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: quality.run_checks(lake.tables, checks.checks_by_kind(kind))


def q9_layer_reconciliation(lake: Lake) -> DataFrame:
    return checks.layer_totals(lake.bronze, lake.silver, lake.star.fato, lake.summary)


def q9_unreconciled_keys(lake: Lake) -> DataFrame:
    """Differences between the stored fact and one recomputed from silver: none."""
    found = checks.unreconciled_keys(
        facts.fct_cobertura_vacinal(lake.silver, lake.bands), lake.star.fato
    )
    return found.agg(F.count("*").alias("diferencas"))


def _altered(fact: DataFrame) -> DataFrame:
    """Without one age band, and with a dose too many in every row from one month on."""
    late = F.col("mes_vacina") >= F.lit(D08_MONTH).cast("date")
    return fact.filter("chave_faixa_etaria <> 1").withColumn(
        "qtd_doses", F.col("qtd_doses") + F.coalesce(late, F.lit(False)).cast("int")
    )


def q9_digest(lake: Lake) -> DataFrame:
    """The differences that `q9_altered_fact` finds, by comparing digests and opening what differs."""
    fact = lake.star.fato
    keys = [c for c in fact.columns if c != "qtd_doses"]
    found = digests.differences(fact, _altered(fact), keys, ["qtd_doses"])
    return found.select(*keys).distinct().agg(F.count("*").alias("diferencas"))


def q7_skipped(lake: Lake) -> DataFrame:
    """What is built if the municipalities of one state are there twice, and why the rest is not."""
    towns = lake.towns.unionByName(lake.towns.filter("sigla_uf = 'SP'"))
    tables = {**lake.tables, checks.MUNICIPALITIES: towns}
    failed = quality.run_checks(tables, checks.checks_by_kind(quality.UNIQUE))
    failed = failed.filter(~F.col("passed") & (F.col("severity") == quality.ERROR)).select(F.col("table").alias("tabela"))
    return lineage.outcomes(lineage.edges(lake.spark, pipeline.dependencies(lake.spark)), failed)


def q10_missing_information(lake: Lake) -> DataFrame:
    """Records per path of the place rule, and those whose state is an empty text."""
    path = place.origin(F.col("co_pais_paciente"), F.col("co_municipio_paciente"))
    return lake.silver.groupBy(path.alias("origem_local")).agg(
        F.count("*").alias("doses"),
        F.count(F.when(F.col("uf_cobertura") == "", 1)).alias("uf_vazia"),
        F.count(F.when(F.col("municipio_cobertura").isNull(), 1)).alias("sem_municipio"),
    )


def a16_functional_dependency(lake: Lake) -> DataFrame:
    return profiling.functional_dependency(
        lake.bronze,
        {
            "co_vacina": "ds_nome",
            "co_dose_vacina": "ds_tipo_dose",
            "co_estrategia_vacinacao": "no_estrategia",
            "co_raca_cor_paciente": "no_raca_cor_paciente",
            "co_documento": "dt_vacina",
        },
    )


def a17_profile(lake: Lake) -> DataFrame:
    return profiling.null_profile(lake.bronze, BRONZE_COLUMNS)


def a17_value_frequency(lake: Lake) -> DataFrame:
    return profiling.value_frequency(
        lake.bronze, ["tp_sexo_paciente", "co_raca_cor_paciente", "co_pais_paciente"]
    )


def a18_unmatched_keys(lake: Lake) -> DataFrame:
    return profiling.unmatched_keys(lake.star.municipio, lake.towns)


def a19_source_lag(lake: Lake) -> DataFrame:
    return profiling.source_lag(lake.silver)


def q9_altered_fact(lake: Lake) -> DataFrame:
    """What the comparison finds in an altered fact."""
    fact = lake.star.fato
    return checks.unreconciled_keys(fact, _altered(fact)).agg(F.count("*").alias("diferencas"))


def a8_sketch(lake: Lake) -> DataFrame:
    """Distinct documents and places by state, from monthly sketches merged over the months,
    beside the exact count."""
    doses = lake.silver.withColumn("mes", F.trunc("data_vacina", "MM"))
    parts = []
    for value in ("codigo_documento", "municipio_cobertura"):
        monthly = sketches.sketches(doses, value, ["uf_cobertura", "mes"])
        estimate = sketches.estimates(sketches.merged(monthly, ["uf_cobertura"]), "estimativa")
        exact = doses.groupBy("uf_cobertura").agg(F.count_distinct(value).alias("distintos")).where("distintos > 0")
        close = F.abs(F.col("estimativa") - F.col("distintos")) <= 0.02 * F.col("distintos") + 0.5
        both = exact.withColumnRenamed("uf_cobertura", "uf").join(estimate, F.col("uf").eqNullSafe(F.col("uf_cobertura")))
        parts.append(both.select(F.lit(value).alias("coluna"), "uf", "distintos", close.cast("int").alias("proximo")))
    return parts[0].unionByName(parts[1])


def a17_top_values(lake: Lake) -> DataFrame:
    """Values that a hundredth of all rows hold, in any of the 19 columns."""
    return profiling.heavy_values(lake.bronze, BRONZE_COLUMNS)


# Bands of seconds since 1970: quarters from 1993 on, with a gap of a day before each, and
# the whole of each second year across them.
SECONDS_BANDS_SQL = """
SELECT 100 + n AS ordem, CAST(start AS BIGINT) AS inicio, CAST(start + 91 * 86400 - 86401 AS BIGINT) AS fim
FROM (SELECT n, 725846400 + n * 91 * 86400 AS start FROM (SELECT DISTINCT {numbers} AS n FROM {source}) q) s
UNION ALL
SELECT 200 + n, CAST(start AS BIGINT), CAST(start + 365 * 86400 - 1 AS BIGINT)
FROM (SELECT n, 725846400 + n * 730 * 86400 AS start FROM (SELECT DISTINCT {numbers} % 5 AS n FROM {source}) q) s
"""


def j6_seconds_bands(lake: Lake) -> DataFrame:
    """Registry entries by bands of seconds since 1970, with overlaps and gaps; looked up by
    the sweep, as bands too many for an array are."""
    seconds = F.unix_timestamp("data_entrada_rnds")
    bands = lake.spark.sql(
        SECONDS_BANDS_SQL.format(numbers="CAST(co_vacina AS INT) % 40", source="{doses}"), doses=lake.silver
    )
    banded = with_band(
        lake.silver.select(seconds.alias("entrada")), F.col("entrada"), bands, low="inicio", high="fim", small=0, per_block=16
    )
    return banded.groupBy("faixa").agg(F.count("*").alias("linhas"), F.count("entrada").alias("com_entrada"))


_LAKE_QUERIES: dict[str, Callable[[Lake], DataFrame]] = {
    **{
        f.__name__: f
        for f in (
            s1_csv_load,
            s1_quoted_newlines,
            s1_quarantine,
            s2_manifest,
            s3_sniff,
            s5_month_from_name,
            s7_hash,
            s9_seed_bands,
            s9_seed_uf,
            k1_partition_replace,
            k1_commit,
            k2_load_log,
            k3_reconcile,
            k5_schema_drift,
            k6_view,
            k8_publication,
            p2_safe_cast_profile,
            p4_geography_resolution,
            p6_uf_fallback,
            p8_sex_clamp,
            w1_latest_document,
            w1_incremental,
            w2_latest_population,
            m1_silver,
            m2_municipalities,
            m3_dim_municipality,
            m4_dim_vaccine,
            m4_dim_profile,
            m4_dim_strategy,
            m5_calendar,
            j6_age_band_counts,
            j6_seconds_bands,
            m6_fact,
            m7_mart,
            m8_mart_summary,
        )
    },
    **{name: _measure(name) for name in MEASURE_SLICERS},
    **{name: _sliced(*of) for name, of in _SLICED.items()},
    "d02_dedup": d02_dedup,
    "d08_uf_vacina": d08_uf_vacina,
    "d05_uf_month": d05_uf_month,
    "d10_region_2000": d10_region_2000,
    "d15_worst": d15_worst,
    "q1_unique": _checks(quality.UNIQUE),
    "q2_not_null": _checks(quality.NOT_NULL),
    "q3_accepted_values": _checks(quality.ACCEPTED),
    "q4_relationships": _checks(quality.RELATED),
    "q9_layer_reconciliation": q9_layer_reconciliation,
    "q9_unreconciled_keys": q9_unreconciled_keys,
    "q9_altered_fact": q9_altered_fact,
    "q9_digest": q9_digest,
    "q7_skipped": q7_skipped,
    "q10_missing_information": q10_missing_information,
    "a16_functional_dependency": a16_functional_dependency,
    "a17_profile": a17_profile,
    "a17_value_frequency": a17_value_frequency,
    "a17_top_values": a17_top_values,
    "a8_sketch": a8_sketch,
    "a18_unmatched_keys": a18_unmatched_keys,
    "a19_source_lag": a19_source_lag,
}

RATE_DIGITS = 9

# Whole numbers that may be null. For the comparison they are doubles on both sides:
# data frames of the two engines disagree on how to hold a missing integer.
_PLACE = ("populacao", "ano_populacao")
_BANDS = ("idade_min", "idade_max")
WHOLE_OR_NULL: dict[str, tuple[str, ...]] = {
    "s9_seed_bands": (*_BANDS, "doses"),
    "s9_seed_uf": ("doses",),
    "m1_silver": ("idade_paciente",),
    "m2_municipalities": _PLACE,
    "m3_dim_municipality": _PLACE,
    "m5_calendar": ("doses",),
    "j6_age_band_counts": ("idade_paciente", "faixa"),
    "j6_seconds_bands": ("faixa",),
    "k1_commit": ("linhas_recebidas", "reconciliado"),
    "m7_mart": (*_PLACE, *_BANDS),
    "m8_mart_summary": (*_PLACE, *_BANDS),
    "d02": ("populacao_coberta",),
    "d02_dedup": ("populacao_coberta",),
    "d09": ("doses_mes_anterior",),
    "d11": ("doses_ytd",),
    "d11_ano": ("doses_ytd",),
    "d11_total": ("doses_ytd",),
}


def comparable(df: DataFrame, doubles: tuple[str, ...] = ()) -> DataFrame:
    """Dates and instants as ISO text and ratios rounded, for value comparison."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, RATE_DIGITS)
        elif f.name in doubles:
            c = c.cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _registered(name: str, run: Callable[[Lake], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _building:
            return comparable(run(lake_of(spark, sf_dir)), WHOLE_OR_NULL.get(name, ()))

    return query


def queries() -> dict[str, Query]:
    return {name: _registered(name, run) for name, run in _LAKE_QUERIES.items()}
