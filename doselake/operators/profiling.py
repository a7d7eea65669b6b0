"""Profiles and diagnoses of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean

_COUNTERS = 1 << 16


def _long(df: DataFrame, entries: list[Column]) -> DataFrame:
    """One aggregate row turned into one row per entry."""
    return df.agg(F.array(*entries).alias("_r")).select(F.inline("_r"))


def safe_cast_profile(bronze: DataFrame) -> DataFrame:
    """Per typed column: filled raw values and those the cast turns into null."""
    casts = {
        "dt_vacina": clean.to_date,
        "dt_entrada_rnds": clean.to_timestamp,
        "nu_idade_paciente": clean.to_long,
    }
    entries = [
        F.struct(
            F.lit(name).alias("coluna"),
            F.count(name).alias("preenchidos"),
            F.count(F.when(F.col(name).isNotNull() & cast(F.col(name)).isNull(), 1)).alias(
                "invalidos"
            ),
        )
        for name, cast in casts.items()
    ]
    return _long(bronze, entries)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls and blanks of every column, in one pass."""
    entries = [
        F.struct(
            F.lit(c).alias("coluna"),
            F.count("*").alias("linhas"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("nulos"),
            F.count(F.when(F.col(c) == "", 1)).alias("vazios"),
        )
        for c in columns
    ]
    return _long(df, entries)


def value_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column; one scan, combined map-side."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("valor")) for c in columns]
    )
    return (
        df.select(F.inline(pairs)).groupBy("coluna", "valor").agg(F.count("*").alias("linhas"))
    )


def heavy_values(df: DataFrame, columns: Sequence[str], percent: int = 1) -> DataFrame:
    """Values that at least ``percent`` of the rows hold, per column, with their exact counts.

    Each task counts with a bounded number of counters a column, and these merge; a value
    above the share is sure to be among those named, since `_COUNTERS` counters err by
    less than a hundredth of a percent of the rows. The few named values are then counted
    exactly in a second pass. No value of a column with many is shuffled.
    """
    most = 100 // percent
    named = [
        F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {most}, {_COUNTERS})").alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    entries = [
        F.expr(f"transform(_{i}, x -> struct({i} AS _column, x.item AS valor))") for i in range(len(columns))
    ]
    candidates = df.agg(*named).select(F.inline(F.flatten(F.array(*entries)))).where("valor IS NOT NULL")
    # At most 100 / percent values a column.
    held = [F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("valor")) for i, c in enumerate(columns)]
    counts = (
        df.select(F.inline(F.array(*held)))
        .join(F.broadcast(candidates), ["_column", "valor"])
        .groupBy("_column", "valor")
        .agg(F.count("*").alias("linhas"))
    )
    total = df.agg(F.count("*").alias("n")).scalar()
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_column") + 1)
    return counts.where(F.col("linhas") * 100 >= total * percent).select(name.alias("coluna"), "valor", "linhas")


def functional_dependency(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Codes, and codes carrying more than one name, per (code, name) pair.

    One scan: every row is unrolled to its pairs, and a code keeps the least and the
    greatest of its names, which differ if there are several. Both are combined
    map-side, so a code sends one row a task however many rows hold it.
    """
    held = F.array(
        *[F.struct(F.lit(c).alias("codigo"), F.col(c).alias("_code"), F.col(n).alias("_name")) for c, n in pairs.items()]
    )
    names = (
        df.select(F.inline(held))
        .filter("_code IS NOT NULL")
        .groupBy("codigo", "_code")
        .agg(F.min("_name").alias("_least"), F.max("_name").alias("_most"))
    )
    return names.groupBy("codigo").agg(
        F.count("*").alias("valores"),
        F.count_if(F.col("_least") != F.col("_most")).alias("com_varios_nomes"),
    )


def unmatched_keys(members: DataFrame, directory: DataFrame) -> DataFrame:
    """Members without a directory entry, counted by the pattern of their code."""
    listed = directory.filter(F.col("nome_municipio").isNotNull()).select("id_municipio_6d")
    code = F.col("codigo_ibge")
    pattern = (
        F.when(code.isNull() & F.col("uf").isin(clean.NO_INFORMATION, clean.FOREIGN), "membro especial")
        .when(code.isNull(), "UF sem codigo")
        .when(code.startswith("53"), "regiao do DF")
        .when(code.endswith("0000"), "UF + 0000")
        .otherwise("residual")
    )
    return (
        members.join(listed, code == F.col("id_municipio_6d"), "left_anti")
        .groupBy(pattern.alias("padrao"))
        .agg(F.count("*").alias("membros"), F.count_distinct("uf").alias("ufs"))
    )


def source_lag(silver: DataFrame) -> DataFrame:
    """Days from the event to the registry entry, per month of the event."""
    seconds = F.unix_timestamp("data_entrada_rnds") - F.unix_timestamp(
        F.col("data_vacina").cast("timestamp")
    )
    days = F.datediff("data_entrada_rnds", "data_vacina")
    return (
        silver.filter("data_entrada_rnds IS NOT NULL AND data_vacina IS NOT NULL")
        .groupBy(F.trunc("data_vacina", "MM").alias("mes"))
        .agg(
            F.count("*").alias("doses"),
            (F.sum(seconds) / F.count("*") / 86_400).alias("dias_medio"),
            F.percentile_approx(days, 0.5).cast("bigint").alias("dias_mediana"),
            F.max(days).cast("bigint").alias("dias_maximo"),
        )
    )
