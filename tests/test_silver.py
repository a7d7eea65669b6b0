"""Hand-written rows for every sentinel and branch of the silver rules."""

import datetime as dt

import pytest

from doselake.plans import dimensions, facts, silver
from doselake.sources import seeds
from doselake.sources.tables import BRONZE_COLUMNS

SCHEMA = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)
BASE = {
    "co_documento": "d",
    "dt_vacina": "2026-02-03 00:00:00-03",
    "dt_entrada_rnds": "2026-02-10 10:00:00",
    "dt_deletado_rnds": None,
    "co_municipio_estabelecimento": "355030",
    "co_municipio_paciente": "330455",
    "co_pais_paciente": "10",
    "co_vacina": "14",
    "ds_nome": "febre amarela",
    "co_dose_vacina": "9",
    "ds_tipo_dose": "Única",
    "co_estrategia_vacinacao": "1",
    "no_estrategia": "Rotina",
    "sg_uf_paciente": "RJ",
    "sg_uf_estabelecimento": "SP",
    "nu_idade_paciente": "30",
    "co_raca_cor_paciente": "01",
    "no_raca_cor_paciente": "BRANCA",
    "tp_sexo_paciente": "F",
}


def bronze(spark, *changes):
    rows = [tuple({**BASE, **change}[c] for c in BRONZE_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, SCHEMA)


def build(spark, *changes):
    return silver.doses_aplicadas(bronze(spark, *changes), seeds.uf_ibge(spark))


def one(spark, **change):
    (row,) = build(spark, change).collect()
    return row


UNKNOWN_HOME = [None, "", "999999"]


@pytest.mark.parametrize(
    "change, municipality, uf",
    [
        ({}, "330455", "RJ"),
        ({"co_pais_paciente": None}, None, "SEM INFORMACAO"),
        ({"co_pais_paciente": ""}, None, "SEM INFORMACAO"),
        ({"co_pais_paciente": "24"}, None, "ESTRANGEIRO"),
        ({"co_pais_paciente": None, "co_municipio_paciente": None}, None, "SEM INFORMACAO"),
        *[({"co_municipio_paciente": v}, "355030", "SP") for v in UNKNOWN_HOME],
        # Both places unknown: the state of the establishment is all that is left.
        *[
            ({"co_municipio_paciente": v, "co_municipio_estabelecimento": "999999"}, None, "SP")
            for v in UNKNOWN_HOME
        ],
        (
            {
                "co_municipio_paciente": None,
                "co_municipio_estabelecimento": "999999",
                "sg_uf_estabelecimento": "XX",
            },
            None,
            "SEM INFORMACAO",
        ),
        # State missing: derived from the code's prefix.
        ({"sg_uf_paciente": None}, "330455", "RJ"),
        ({"sg_uf_paciente": "XX"}, "330455", "RJ"),
        ({"sg_uf_paciente": None, "co_municipio_paciente": "990001"}, "990001", "SEM INFORMACAO"),
        # An empty state is not treated as missing, and neither is an empty
        # establishment municipality.
        ({"sg_uf_paciente": ""}, "330455", ""),
        ({"co_municipio_paciente": None, "co_municipio_estabelecimento": ""}, "", "SP"),
        # The state follows the chosen place, not the filled one.
        ({"co_municipio_paciente": "999999", "sg_uf_paciente": "RJ"}, "355030", "SP"),
        ({"co_municipio_paciente": "350000", "sg_uf_paciente": "SP"}, "350000", "SP"),
    ],
)
def test_place(spark, change, municipality, uf):
    row = one(spark, **change)
    assert (row["municipio_cobertura"], row["uf_cobertura"]) == (municipality, uf)


@pytest.mark.parametrize(
    "raw, age",
    [("0", 0), ("150", 150), ("-1", -1), ("abc", None), (None, None), ("3.5", None), ("", None)],
)
def test_age_cast(spark, raw, age):
    assert one(spark, nu_idade_paciente=raw)["idade_paciente"] == age


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2026-02-03 00:00:00-03", dt.date(2026, 2, 3)),
        ("2026-02-03 23:59:59-03", dt.date(2026, 2, 3)),
        ("2026-02-30", None),
        ("2026-02", None),
        ("2026", None),
        ("ontem", None),
        (None, None),
    ],
)
def test_date_cast(spark, raw, day):
    assert one(spark, dt_vacina=raw)["data_vacina"] == day


def test_entry_instant_honours_offset(spark):
    rows = build(spark, {"dt_entrada_rnds": "2026-02-03 01:02:03-03"})
    assert rows.selectExpr("CAST(data_entrada_rnds AS string)").first()[0] == "2026-02-03 04:02:03"


def test_default_members(spark):
    row = one(
        spark,
        co_raca_cor_paciente=None,
        no_raca_cor_paciente=None,
        co_estrategia_vacinacao=None,
        no_estrategia=None,
        ds_nome=None,
        ds_tipo_dose=None,
        tp_sexo_paciente=None,
    )
    assert row["raca_cor_cobertura"] == "99"
    for c in (
        "nome_raca_cor_cobertura",
        "sexo_cobertura",
        "estrategia_cobertura",
        "nome_vacina_cobertura",
        "nome_dose_cobertura",
        "nome_estrategia_cobertura",
    ):
        assert row[c] == "SEM INFORMACAO"


@pytest.mark.parametrize("raw, sex", [("F", "F"), ("M", "M"), ("I", "SEM INFORMACAO"), ("f", "SEM INFORMACAO")])
def test_sex(spark, raw, sex):
    assert one(spark, tp_sexo_paciente=raw)["sexo_cobertura"] == sex


def test_older_live_version_surfaces(spark):
    row = one_of(
        spark,
        {"dt_entrada_rnds": "2026-03-02 00:00:00", "dt_deletado_rnds": "2026-03-03"},
        {"dt_entrada_rnds": "2026-03-01 00:00:00", "nu_idade_paciente": "7"},
        {"dt_entrada_rnds": "2026-02-01 00:00:00", "nu_idade_paciente": "8"},
    )
    assert row["idade_paciente"] == 7


def one_of(spark, *changes):
    (row,) = build(spark, *changes).collect()
    return row


def test_all_versions_deleted(spark):
    assert build(spark, {"dt_deletado_rnds": "x"}, {"dt_deletado_rnds": ""}).count() == 0


def test_missing_entry_sorts_last(spark):
    row = one_of(
        spark,
        {"dt_entrada_rnds": None, "nu_idade_paciente": "1"},
        {"dt_entrada_rnds": "1990-01-01 00:00:00", "nu_idade_paciente": "2"},
        {"dt_entrada_rnds": "nunca", "nu_idade_paciente": "3"},
    )
    assert row["idade_paciente"] == 2


def test_equal_entries_resolve_the_same_way_in_any_order(spark):
    rows = [{"nu_idade_paciente": str(a), "ds_nome": n} for a in (5, 6, 7) for n in ("b", "a", None)]
    forward = one_of(spark, *rows)
    backward = one_of(spark, *reversed(rows))
    assert forward == backward


def test_missing_documents_are_one_document(spark):
    rows = build(
        spark,
        {"co_documento": None, "dt_entrada_rnds": "2026-01-01 00:00:00"},
        {"co_documento": None, "dt_entrada_rnds": "2026-01-02 00:00:00", "nu_idade_paciente": "9"},
        {"co_documento": "x"},
    ).collect()
    assert sorted((r["codigo_documento"] or "", r["idade_paciente"]) for r in rows) == [("", 9), ("x", 30)]


# --- directory and population ---------------------------------------------------------------


def test_latest_population(spark):
    populacao = spark.createDataFrame(
        [
            ("1", 2024, 10),
            ("1", 2025, None),
            ("2", 2023, None),
            ("2", 2024, None),
            ("3", 2026, 99),
            ("4", 2025, 5),
            ("4", 2026, 6),
        ],
        "id_municipio string, ano bigint, populacao bigint",
    )
    diretorio = spark.createDataFrame(
        [(i, i, "SP", "Sudeste") for i in "1234"],
        "id_municipio string, nome string, sigla_uf string, nome_regiao string",
    )
    found = {
        r["id_municipio"]: (r["populacao"], r["ano_populacao"])
        for r in silver.municipios(diretorio, populacao).collect()
    }
    assert found == {"1": (10, 2024), "2": (None, None), "3": (None, None), "4": (5, 2025)}


DIRECTORY = [
    ("3304557", "330455", "Rio de Janeiro", "RJ", "Sudeste", 6_000_000, 2025),
    ("3550308", "355030", "São Paulo", "SP", "Sudeste", 11_000_000, 2025),
    ("5300108", "530010", "Brasília", "DF", "Centro-Oeste", 3_000_000, 2025),
]


def directory(spark, rows=DIRECTORY):
    return spark.createDataFrame(
        rows,
        "id_municipio string, id_municipio_6d string, nome_municipio string, sigla_uf string,"
        " nome_regiao string, populacao bigint, ano_populacao bigint",
    )


def members(spark, pairs, rows=DIRECTORY):
    doses = spark.createDataFrame(pairs, "municipio_cobertura string, uf_cobertura string")
    found = dimensions.dim_municipio(doses, directory(spark, rows)).collect()
    return {r["chave_municipio"]: r for r in found}


def test_record_types(spark):
    found = members(
        spark,
        [
            ("330455", "RJ"),
            ("530010", "DF"),
            ("530180", "DF"),
            ("350000", "SP"),
            ("520100", "GO"),
            ("520000", "GO"),
            (None, "SP"),
            (None, "ESTRANGEIRO"),
            (None, "SEM INFORMACAO"),
        ],
    )
    shape = {k: (r["tipo_registro"], r["nome_municipio"], r["nome_regiao"]) for k, r in found.items()}
    valid, capital = dimensions.VALID, dimensions.CAPITAL_REGION
    assert shape == {
        "330455": (valid, "Rio de Janeiro", "Sudeste"),
        "530010": (valid, "Brasília", "Centro-Oeste"),
        "530180": (capital, "Brasília", "Centro-Oeste"),
        "350000": (dimensions.STATE_ONLY, None, "Sudeste"),
        # No directory entry for Goiás here: neither a region nor a special type.
        "520100": (valid, None, None),
        "520000": (valid, None, None),
        "SP": (valid, None, "Sudeste"),
        "ESTRANGEIRO": (dimensions.FOREIGN, None, "ESTRANGEIRO"),
        "SEM INFORMACAO": (dimensions.NO_INFORMATION, None, "SEM INFORMACAO"),
    }
    assert found["530180"]["populacao"] == 3_000_000


def test_capital_missing_from_directory(spark):
    found = members(spark, [("530180", "DF")], DIRECTORY[:2])
    assert found["530180"]["tipo_registro"] == dimensions.VALID
    assert found["530180"]["nome_municipio"] is None


def test_two_region_spellings_fan_out(spark):
    rows = [*DIRECTORY, ("3509502", "350950", "Campinas", "SP", "SUDESTE", 1, 2025)]
    doses = spark.createDataFrame([("350000", "SP")], "municipio_cobertura string, uf_cobertura string")
    assert dimensions.dim_municipio(doses, directory(spark, rows)).count() == 2


# --- fact --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "age, band",
    [(None, 0), ("abc", 0), ("-1", 0), ("151", 0), ("0", 1), ("1", 2), ("4", 3), ("5", 4),
     ("10", 5), ("19", 5), ("20", 6), ("60", 7), ("150", 7)],
)
def test_bands(spark, age, band):
    doses = build(spark, {"nu_idade_paciente": age})
    (row,) = facts.fct_cobertura_vacinal(doses, seeds.faixa_etaria(spark)).collect()
    assert (row["chave_faixa_etaria"], row["qtd_doses"]) == (band, 1)


def test_fact_keys(spark):
    doses = build(spark, {}, {"co_documento": "e"}, {"co_documento": "f", "co_dose_vacina": None})
    found = facts.fct_cobertura_vacinal(doses, seeds.faixa_etaria(spark)).collect()
    assert sorted((str(r["chave_vacina"]), r["qtd_doses"]) for r in found) == [("14-9", 2), ("None", 1)]
    assert {r["mes_vacina"] for r in found} == {dt.date(2026, 2, 1)}
    assert {r["chave_perfil"] for r in found} == {"01-F"}


def test_overlapping_bands_fan_out(spark):
    from pyspark.sql import functions as F

    from doselake.operators.bands import with_band

    bands = spark.createDataFrame(
        [(1, 0, 10), (2, 5, 15), (3, 9, 4), (4, None, 3)], "ordem int, idade_min int, idade_max int"
    )
    ages = spark.createDataFrame([(a,) for a in (0, 7, 15, 16, None)], "idade bigint")
    found = with_band(ages, F.col("idade"), bands).collect()
    assert sorted((str(r["idade"]), str(r["faixa"])) for r in found) == [
        ("0", "1"), ("15", "2"), ("16", "None"), ("7", "1"), ("7", "2"), ("None", "None"),
    ]
