"""What depends on what, and what a broken check keeps from being built (Q7).

Dependencies are a table of edges. All models below a failed one are found by a recursive
query, so the answer does not depend on the order in which models are listed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

BUILT = "construido"
FAILED = "falhou"
SKIPPED = "pulado"


def edges(spark: SparkSession, needs: Mapping[str, Iterable[str]]) -> DataFrame:
    """(modelo, depende_de) of every model; a model without needs has one row with a null."""
    rows = [(model, parent) for model, parents in needs.items() for parent in (tuple(parents) or (None,))]
    return spark.createDataFrame(rows, "modelo string, depende_de string")


def outcomes(depends: DataFrame, failed: DataFrame) -> DataFrame:
    """(modelo, situacao, motivo) for every model, given the names (``tabela``) of failed ones.

    A model below failed ones is skipped, with all failed models above it as the reason,
    nearest or not; one that failed itself is built, and its checks are the reason.
    """
    spark = depends.sparkSession
    return spark.sql(
        f"""
        WITH RECURSIVE below(origem, modelo) AS (
          SELECT DISTINCT tabela, tabela FROM {{failed}}
          UNION ALL
          SELECT b.origem, d.modelo FROM below b JOIN {{depends}} d ON d.depende_de = b.modelo
        ),
        reasons AS (
          SELECT modelo, array_join(array_sort(collect_set(origem)), ', ') AS motivo
          FROM below WHERE origem <> modelo GROUP BY modelo
        ),
        models AS (SELECT DISTINCT modelo FROM {{depends}})
        SELECT m.modelo,
          CASE WHEN r.modelo IS NOT NULL THEN '{SKIPPED}' WHEN f.tabela IS NOT NULL THEN '{FAILED}'
               ELSE '{BUILT}' END AS situacao,
          r.motivo
        FROM models m
        LEFT JOIN reasons r ON r.modelo = m.modelo
        LEFT JOIN (SELECT DISTINCT tabela FROM {{failed}}) f ON f.tabela = m.modelo""",
        depends=depends,
        failed=failed,
    )
