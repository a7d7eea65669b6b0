"""Silver and fact on skewed random rows against plain Python, hot keys included."""

import datetime as dt
import random
from collections import Counter

import pytest

from doselake.plans import facts, silver
from doselake.sources import seeds
from doselake.sources.tables import BRONZE_COLUMNS

PREFIXES = {str(code): uf for code, uf, _ in seeds.UF_ROWS}


def make_rows(seed, n=1500):
    """A third of the rows share one document, another third one municipality; a
    tenth has no document at all."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = dict.fromkeys(BRONZE_COLUMNS)
        row["co_documento"] = "hot" if i % 3 == 0 else rng.choice([None, *map(str, range(400))])
        row["dt_vacina"] = rng.choice(["2026-01-15 00:00:00-03", "2026-02-03 00:00:00-03", "x", None])
        row["dt_entrada_rnds"] = rng.choice([None, "ruim"] + [f"2026-03-{d:02d} 10:00:00" for d in range(1, 8)])
        row["dt_deletado_rnds"] = rng.choice([None, None, None, "", "2026-04-01"])
        row["co_pais_paciente"] = rng.choice(["10"] * 8 + [None, "", "24"])
        home = "355030" if i % 3 == 1 else rng.choice([None, "", "999999", "330455", "530180", "310000", "990001"])
        row["co_municipio_paciente"] = home
        row["co_municipio_estabelecimento"] = rng.choice([None, "", "999999", "410690"])
        row["sg_uf_paciente"] = rng.choice([None, "XX", "RJ", "SP", ""])
        row["sg_uf_estabelecimento"] = rng.choice([None, "XX", "PR"])
        row["co_vacina"] = rng.choice([None, "1", "2"])
        row["co_dose_vacina"] = rng.choice(["1", "9"])
        row["nu_idade_paciente"] = rng.choice([None, "abc", "-1", "0", "1", "4", "19", "60", "150", "151"])
        row["co_raca_cor_paciente"] = rng.choice([None, "01", "99"])
        row["tp_sexo_paciente"] = rng.choice([None, "F", "M", "I"])
        row["co_estrategia_vacinacao"] = rng.choice([None, "1"])
        rows.append(row)
    return rows


def day_of(text):
    try:
        return dt.date.fromisoformat((text or "")[:10])
    except ValueError:
        return None


def entered(text):
    try:
        return dt.datetime.fromisoformat(text or "")
    except ValueError:
        return None


def place_of(row):
    """(municipality, state) by the published order of cases."""
    if row["co_pais_paciente"] in (None, ""):
        return None, "SEM INFORMACAO"
    if row["co_pais_paciente"] != "10":
        return None, "ESTRANGEIRO"
    side = "estabelecimento" if row["co_municipio_paciente"] in (None, "", "999999") else "paciente"
    town, uf = row[f"co_municipio_{side}"], row[f"sg_uf_{side}"]
    town = None if town == "999999" else town
    uf = None if uf == "XX" else uf
    if uf is None:
        uf = PREFIXES.get((town or "")[:2], "SEM INFORMACAO")
    return town, uf


def newest(rows):
    def rank(row):
        # Present values beat missing ones, column by column.
        when = entered(row["dt_entrada_rnds"])
        rest = [row[c] for c in silver._VERSION_COLUMNS]
        return [(when is not None, when or 0)] + [(v is not None, v or "") for v in rest]

    best = {}
    for row in rows:
        if row["dt_deletado_rnds"] is None:
            key = row["co_documento"]
            if key not in best or rank(row) > rank(best[key]):
                best[key] = row
    return list(best.values())


def fact_key(row):
    town, uf = place_of(row)
    day = day_of(row["dt_vacina"])
    try:
        age = int(row["nu_idade_paciente"])
    except (TypeError, ValueError):
        age = None
    band = 0
    if age is not None:
        band = next((o for o, lo, hi, _ in seeds.AGE_BAND_ROWS if lo is not None and lo <= age <= hi), 0)
    vaccine = None if row["co_vacina"] is None else f"{row['co_vacina']}-{row['co_dose_vacina']}"
    sex = row["tp_sexo_paciente"] if row["tp_sexo_paciente"] in ("F", "M") else "SEM INFORMACAO"
    return (
        day and day.replace(day=1),
        uf if town is None else town,
        vaccine,
        band,
        f"{row['co_raca_cor_paciente'] or '99'}-{sex}",
        row["co_estrategia_vacinacao"] or "SEM INFORMACAO",
    )


@pytest.mark.parametrize("seed", range(3))
def test_fact_of_skewed_rows(spark, seed):
    rows = make_rows(seed)
    bronze = spark.createDataFrame(
        [tuple(r[c] for c in BRONZE_COLUMNS) for r in rows],
        ", ".join(f"{c} string" for c in BRONZE_COLUMNS),
    ).repartition(7)
    doses = silver.doses_aplicadas(bronze, seeds.uf_ibge(spark))
    found = facts.fct_cobertura_vacinal(doses, seeds.faixa_etaria(spark)).collect()
    expected = Counter(fact_key(r) for r in newest(rows))
    assert {tuple(r)[:6]: r["qtd_doses"] for r in found} == dict(expected)
