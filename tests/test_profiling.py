"""Profiles on hand-written rows."""

import datetime as dt

import pytest

from doselake.operators import profiling


def table(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_source_lag(spark):
    rows = [("2026-01-01", "2026-01-13 12:00:00"), ("2026-01-31", "2026-01-31 00:00:00"),
            ("2026-01-02", "2026-01-05 06:00:00"), ("2026-02-01", "2026-02-03 00:00:00"),
            ("2026-02-01", None), (None, "2026-02-03 00:00:00")]
    silver = spark.createDataFrame(rows, "d string, e string").selectExpr(
        "CAST(d AS date) AS data_vacina", "CAST(e AS timestamp) AS data_entrada_rnds"
    )
    found = table(profiling.source_lag(silver), "mes")
    january = found[dt.date(2026, 1, 1)]
    assert january["doses"] == 3 and january["dias_maximo"] == 12 and january["dias_mediana"] == 3
    assert january["dias_medio"] == pytest.approx((12.5 + 0 + 3.25) / 3)
    assert found[dt.date(2026, 2, 1)]["doses"] == 1


def test_functional_dependency(spark):
    rows = [("1", "a", "x"), ("1", "a", "y"), ("2", "b", "x"), ("2", None, "x"), (None, "c", "z"), ("3", "d", None)]
    df = spark.createDataFrame(rows, "c string, n string, m string")
    found = table(profiling.functional_dependency(df, {"c": "n", "n": "m"}), "codigo")
    assert (found["c"]["valores"], found["c"]["com_varios_nomes"]) == (3, 0)
    assert (found["n"]["valores"], found["n"]["com_varios_nomes"]) == (4, 1)


def test_null_profile_and_frequency(spark):
    df = spark.createDataFrame([("a", None), ("", "x"), (None, "x")], "p string, q string")
    found = table(profiling.null_profile(df, ["p", "q"]), "coluna")
    assert tuple(found["p"])[1:] == (3, 1, 1) and tuple(found["q"])[1:] == (3, 1, 0)
    counts = table(profiling.value_frequency(df, ["p", "q"]), "coluna", "valor")
    assert counts["q", "x"]["linhas"] == 2 and counts["p", None]["linhas"] == 1


def test_safe_cast_profile(spark):
    rows = [("2026-01-01", "2026-01-01 10:00:00", "5"), ("2026", "ontem", "x"), (None, None, None), ("", "", "")]
    df = spark.createDataFrame(rows, "dt_vacina string, dt_entrada_rnds string, nu_idade_paciente string")
    found = table(profiling.safe_cast_profile(df), "coluna")
    assert {k: tuple(r)[1:] for k, r in found.items()} == {
        "dt_vacina": (3, 2), "dt_entrada_rnds": (3, 2), "nu_idade_paciente": (3, 2),
    }


def test_unmatched_keys(spark):
    members = spark.createDataFrame(
        [("530020", "DF"), ("210000", "MA"), ("430145", "RS"), ("520100", "GO"), (None, "SP"),
         (None, "ESTRANGEIRO"), ("355030", "SP"), ("350001", "SP")],
        "codigo_ibge string, uf string",
    )
    directory = spark.createDataFrame(
        [("355030", "São Paulo"), ("350001", None)], "id_municipio_6d string, nome_municipio string"
    )
    found = table(profiling.unmatched_keys(members, directory), "padrao")
    assert {k: (r["membros"], r["ufs"]) for k, r in found.items()} == {
        "regiao do DF": (1, 1), "UF + 0000": (1, 1), "residual": (3, 3),
        "UF sem codigo": (1, 1), "membro especial": (1, 1),
    }
