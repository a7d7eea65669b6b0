"""Dose tables derived from the TPC-H-like test tables.

The SQL is plain enough to run unchanged on Spark and on the engine the results
are checked against. See FIXTURES.md, part B.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import MONTH_ABBREVIATIONS
from . import tables
from .seeds import UF_ROWS

CALENDAR_START = "1995-01-01"
CALENDAR_END = "2001-12-01"

# The states in the order of their codes, two characters each.
_UF_CODES = "".join(str(code) for code, _, _ in sorted(UF_ROWS))
_UF_NAMES = "".join(name for _, name, _ in sorted(UF_ROWS))

_BASE_SQL = """
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS dia,
         o.o_custkey, o.o_custkey % 27 AS pk, l.l_suppkey % 27 AS ek
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
_DOSES_SQL = f"""geo AS (
  SELECT b.*,
    substr('{_UF_CODES}', CAST(pk*2+1 AS INT), 2) AS p_uf_cod,
    substr('{_UF_NAMES}', CAST(pk*2+1 AS INT), 2) AS p_uf,
    substr('{_UF_CODES}', CAST(ek*2+1 AS INT), 2) AS e_uf_cod,
    substr('{_UF_NAMES}', CAST(ek*2+1 AS INT), 2) AS e_uf
  FROM base b
)
SELECT
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS co_documento,
  dia || ' 00:00:00-03' AS dt_vacina,
  CASE WHEN l_partkey % 83 = 0 THEN NULL
       ELSE dia || ' ' || lpad(CAST(l_partkey % 24 AS STRING), 2, '0') || ':'
            || lpad(CAST(l_suppkey % 60 AS STRING), 2, '0') || ':00' END AS dt_entrada_rnds,
  CASE WHEN (l_partkey + l_linenumber) % 97 = 0 THEN dia END AS dt_deletado_rnds,
  CASE WHEN l_suppkey % 7 = 0 THEN '999999'
       ELSE e_uf_cod || lpad(CAST(l_suppkey % 40 AS STRING), 4, '0') END AS co_municipio_estabelecimento,
  CASE WHEN o_custkey % 41 = 0 THEN NULL WHEN o_custkey % 43 = 0 THEN ''
       WHEN o_custkey % 47 = 0 THEN '999999'
       ELSE p_uf_cod || lpad(CAST(o_custkey % 40 AS STRING), 4, '0') END AS co_municipio_paciente,
  CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN ''
       WHEN l_partkey % 61 = 0 THEN '24' ELSE '10' END AS co_pais_paciente,
  CAST(l_partkey % 90 AS STRING) AS co_vacina,
  CASE WHEN l_partkey % 90 = 89 THEN NULL
       ELSE 'vacina ' || CAST(l_partkey % 90 AS STRING) END AS ds_nome,
  CAST(l_linenumber AS STRING) AS co_dose_vacina,
  'dose ' || CAST(l_linenumber AS STRING) AS ds_tipo_dose,
  CASE WHEN l_orderkey % 17 = 16 THEN NULL
       ELSE CAST(l_orderkey % 17 AS STRING) END AS co_estrategia_vacinacao,
  CASE WHEN l_orderkey % 17 IN (0, 16) THEN NULL
       ELSE 'estrategia ' || CAST(l_orderkey % 17 AS STRING) END AS no_estrategia,
  CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN 'XX' ELSE p_uf END AS sg_uf_paciente,
  CASE WHEN l_partkey % 29 = 0 THEN 'XX' ELSE e_uf END AS sg_uf_estabelecimento,
  CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 73 = 0 THEN 'abc'
       ELSE CAST(CAST(l_quantity AS INT) * (l_linenumber % 4) AS STRING) END AS nu_idade_paciente,
  CASE l_orderkey % 7 WHEN 0 THEN '01' WHEN 1 THEN '02' WHEN 2 THEN '03' WHEN 3 THEN '04'
       WHEN 4 THEN '05' WHEN 5 THEN '99' END AS co_raca_cor_paciente,
  CASE l_orderkey % 7 WHEN 0 THEN 'BRANCA' WHEN 1 THEN 'PRETA' WHEN 2 THEN 'PARDA' WHEN 3 THEN 'AMARELA'
       WHEN 4 THEN 'INDIGENA' WHEN 5 THEN 'SEM INFORMACAO' END AS no_raca_cor_paciente,
  CASE WHEN l_partkey % 101 = 0 THEN 'I' WHEN l_partkey % 103 = 0 THEN 'N'
       WHEN l_partkey % 2 = 0 THEN 'F' ELSE 'M' END AS tp_sexo_paciente,
  substr(dia, 1, 7) AS mes_referencia
FROM geo
"""
BRONZE_SQL = f"""
WITH base AS ({_BASE_SQL}), {_DOSES_SQL}"""

DIRECTORY_SQL = f"""
WITH k AS (
  SELECT c_custkey % 27 AS u, c_custkey % 40 AS s, min(c_custkey) AS m
  FROM customer GROUP BY c_custkey % 27, c_custkey % 40
), c AS (
  SELECT substr('{_UF_CODES}', CAST(u*2+1 AS INT), 2) || lpad(CAST(s AS STRING), 4, '0') AS id6,
         substr('{_UF_NAMES}', CAST(u*2+1 AS INT), 2) AS sigla_uf, s
  FROM k WHERE s <> 0 AND u <> 26 AND m % 89 <> 0
  UNION ALL SELECT '530010', 'DF', 10
)
SELECT id6 || CAST(s % 10 AS STRING) AS id_municipio, 'Municipio ' || id6 AS nome, sigla_uf,
  CASE substr(id6,1,1) WHEN '1' THEN 'Norte' WHEN '2' THEN 'Nordeste' WHEN '3' THEN 'Sudeste'
       WHEN '4' THEN 'Sul' ELSE 'Centro-Oeste' END AS nome_regiao
FROM c
"""

# Four yearly rows per municipality; 2026 is there to exercise the year cap.
_POPULATION_SELECT = """
SELECT id_municipio, ano,
  CASE WHEN CAST(substr(id_municipio,3,4) AS INT) % 13 = 0 AND ano = 2025 THEN NULL
       WHEN CAST(substr(id_municipio,3,4) AS INT) % 37 = 0 THEN NULL
       ELSE 1000 + (CAST(substr(id_municipio,1,6) AS INT) * 37) % 50000 + ano % 100 END AS populacao
FROM ({years}) AS d
"""
_YEARS_SPARK = "SELECT id_municipio, explode(array(2023, 2024, 2025, 2026)) AS ano FROM diretorio"
_YEARS_ANSI = "SELECT id_municipio, unnest([2023, 2024, 2025, 2026]) AS ano FROM diretorio"
POPULATION_SQL_SPARK = _POPULATION_SELECT.format(years=_YEARS_SPARK)
POPULATION_SQL_ANSI = _POPULATION_SELECT.format(years=_YEARS_ANSI)


def _run(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    # Table names of the SQL become the given DataFrames.
    for name in frames:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    return spark.sql(sql, **frames)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doses, those of a month together, as a table by month is written.

    They are dealt by month as the few numbers they derive from: the texts, several times
    as wide, are made behind the exchange.
    """
    lineitem = tables.scan(spark, f"{sf_dir}/lineitem.parquet")
    orders = tables.scan(spark, f"{sf_dir}/orders.parquet")
    base = _run(spark, _BASE_SQL, lineitem=lineitem, orders=orders)
    dealt = base.withColumn("_month", F.substring("dia", 1, 7)).hint("rebalance", "_month")
    return _run(spark, f"WITH {_DOSES_SQL}", base=dealt)


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, DIRECTORY_SQL, customer=tables.scan(spark, f"{sf_dir}/customer.parquet"))


def population(spark: SparkSession, directory_table: DataFrame) -> DataFrame:
    frame = _run(spark, POPULATION_SQL_SPARK, diretorio=directory_table)
    return frame.selectExpr(
        "id_municipio", "CAST(ano AS BIGINT) AS ano", "CAST(populacao AS BIGINT) AS populacao"
    )


# --- the same doses as monthly CSV drops -----------------------------------------------

YEAR_SHIFT = 25  # file names only know years 20xx


def shifted_month_sql(month: str = "mes_referencia") -> str:
    return f"CAST(CAST(substr({month}, 1, 4) AS INT) + {YEAR_SHIFT} AS STRING) || substr({month}, 5, 3)"


def display_header(column: str) -> str:
    """A header as people write it: spaces, capitals and accents."""
    return column.replace("co_", "Có_", 1).replace("vacina", "Vacína").replace("_", " ")


def _drop_of(month_text: Column) -> Column:
    month = F.substring(month_text, 6, 2).cast("int")
    year = F.substring(month_text, 1, 4).cast("int") + YEAR_SHIFT
    abbreviation = F.element_at(F.array(*[F.lit(a) for a in MONTH_ABBREVIATIONS]), month)
    return F.concat(F.lit("vacinacao_"), abbreviation, F.lit("_"), year.cast("string"), F.lit(".csv"))


def write_drops(bronze_rows: DataFrame, folder: str) -> None:
    """One drop per month below ``folder``: odd months ``;`` in ISO-8859-1, even
    months ``,`` in UTF-8. A large month becomes several part files.

    Rows read from a table by month lie by month already, so no exchange comes first.
    """
    month = F.substring("mes_referencia", 6, 2).cast("int")
    headed = bronze_rows.select(
        *[F.col(c).alias(display_header(c)) for c in tables.BRONZE_COLUMNS],
        _drop_of(F.col("mes_referencia")).alias("remessa"),
        (month % 2).alias("_odd"),
    )
    for odd, sep, encoding in ((1, ";", "ISO-8859-1"), (0, ",", "UTF-8")):
        (
            headed.filter(F.col("_odd") == odd)
            .drop("_odd")
            .write.mode("append")
            .partitionBy("remessa")
            .option("header", "true")
            .option("sep", sep)
            .option("encoding", encoding)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(folder)
        )


# Which documents of a delivery lose their last column, and which get one too many.
SHORT_SQL = "co_documento LIKE '%-1'"
LONG_SQL = "co_documento LIKE '%-2'"


def write_uneven_drops(bronze_rows: DataFrame, folder: str) -> None:
    """Drops (``;``, ISO-8859-1) in which some rows have a column too few or too many."""
    columns = tables.BRONZE_COLUMNS
    options = {"sep": ";", "escape": '"', "emptyValue": '""', "nullValue": ""}
    line = F.to_csv(F.struct(*columns), options)
    uneven = (
        F.when(F.expr(SHORT_SQL), F.regexp_replace(line, ";[^;]*$", ""))
        .when(F.expr(LONG_SQL), F.concat(line, F.lit(";x")))
        .otherwise(line)
    )
    lines = bronze_rows.select(
        uneven.alias(";".join(display_header(c) for c in columns)), _drop_of(F.col("mes_referencia")).alias("remessa")
    )
    (
        lines.write.mode("append")
        .partitionBy("remessa")
        .option("header", "true")
        .option("sep", "\x01")  # and no quotes: the lines as they are
        .option("quote", "\x00")
        .option("encoding", "ISO-8859-1")
        .csv(folder)
    )


def write_sorted_drops(bronze_rows: DataFrame, folder: str) -> None:
    """One file a month with the documents and days of its doses in order, so that its bytes are known."""
    rows = bronze_rows.select("co_documento", "dt_vacina", _drop_of(F.col("mes_referencia")).alias("remessa"))
    (
        rows.repartition("remessa")
        .sortWithinPartitions("remessa", "co_documento", "dt_vacina")
        .write.partitionBy("remessa")
        .option("header", "true")
        .option("sep", ";")
        .csv(folder)
    )
