"""Measures on a hand-written star: blanks, filters, gaps, ranks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from doselake.operators import ranking
from doselake.plans import dimensions, measures
from doselake.plans.facts import Star
from doselake.sources import seeds

V, C, E = dimensions.VALID, dimensions.CAPITAL_REGION, dimensions.FOREIGN


@pytest.fixture(scope="module")
def star(spark):
    def day(text):
        return dt.date.fromisoformat(text)

    fato = spark.createDataFrame(
        [
            (day("2026-01-01"), "A", "1-1", 1, "01-F", "1", 50),
            (day("2026-01-01"), "B", "1-1", 2, "01-M", "2", 30),
            (day("2026-03-01"), "A", "2-1", 1, "01-F", "1", 20),
            (day("2026-03-01"), "X", "2-1", 0, "01-F", "1", 10),
            (day("2025-12-01"), "A", "1-1", 1, "01-F", "1", 7),
            (None, "A", "1-1", 1, "01-F", "1", 3),
        ],
        "mes_vacina date, chave_municipio string, chave_vacina string, chave_faixa_etaria int,"
        " chave_perfil string, chave_estrategia string, qtd_doses bigint",
    )
    municipio = spark.createDataFrame(
        [
            ("A", "A", "SP", "Alfa", "Sudeste", 100, 2025, V),
            ("B", "B", "SP", "Beta", "Sudeste", 30, 2025, V),
            ("N", "N", "SP", "Nula", "Sudeste", None, None, V),
            ("R1", "R1", "DF", "Brasília", "Centro-Oeste", 500, 2025, C),
            ("R2", "R2", "DF", "Brasília", "Centro-Oeste", 500, 2025, C),
            ("X", None, "ESTRANGEIRO", None, "ESTRANGEIRO", None, None, E),
        ],
        "chave_municipio string, codigo_ibge string, uf string, nome_municipio string,"
        " nome_regiao string, populacao bigint, ano_populacao bigint, tipo_registro string",
    )
    vacina = spark.createDataFrame(
        [("1-1", "1", "1", "um", "única"), ("2-1", "2", "1", "dois", "única")],
        "chave_vacina string, co_vacina string, co_dose_vacina string, nome_vacina string, nome_dose string",
    )
    perfil = spark.createDataFrame(
        [("01-F", "01", "BRANCA", "F", "Feminino"), ("01-M", "01", "BRANCA", "M", "Masculino")],
        "chave_perfil string, codigo_raca_cor string, nome_raca_cor string, sexo string, nome_sexo string",
    )
    estrategia = spark.createDataFrame(
        [("1", "Rotina"), ("2", "Campanha")], "chave_estrategia string, nome_estrategia string"
    )
    return Star(
        fato=fato,
        tempo=dimensions.dim_tempo(spark),
        municipio=municipio,
        vacina=vacina,
        faixa=seeds.faixa_etaria(spark),
        perfil=perfil,
        estrategia=estrategia,
        meta=seeds.meta_vacinal(spark),
    )


def evaluate(star, name, by=(), where=None, **options):
    df = measures.measure(star, name, by, where, **options)
    rows = df.collect()
    if not by:
        return rows[0][0] if len(df.columns) == 1 else {r[0]: r[1] for r in rows}
    return {tuple(r[c] for c in by) if len(by) > 1 else r[by[0]]: r[-1] for r in rows}


TARGET = sum(r[3] for r in seeds.TARGET_ROWS) / 19


def test_doses(star):
    assert evaluate(star, "d01") == 120
    assert evaluate(star, "d01", ["uf"]) == {"SP": 110, "ESTRANGEIRO": 10}
    assert evaluate(star, "d01", ["uf"], {"nome_vacina": ["dois"]}) == {"SP": 20, "ESTRANGEIRO": 10}
    assert evaluate(star, "d01", ["nome_faixa_etaria"])["1 ano"] == 30
    assert evaluate(star, "d01", ["ano"]) == {2026: 110, None: 10}
    assert evaluate(star, "d01", (), {"mes": lambda c: c >= "2026-02-01"}) == 30


def test_population_ignores_other_slicers(star):
    assert evaluate(star, "d02", ["uf"]) == {"SP": 130, "DF": 1000, "ESTRANGEIRO": None}
    assert evaluate(star, "d02", (), {"nome_vacina": ["dois"], "uf": ["SP"]}) == 130
    assert evaluate(star, "d02", ["chave_vacina"]) == {"1-1": 1130, "2-1": 1130}
    assert evaluate(star, "d02", ["uf"], dedup=True)["DF"] == 500
    assert evaluate(star, "d02", dedup=True) == 630


def test_counts(star):
    assert evaluate(star, "d03") == 5
    assert evaluate(star, "d03", (), {"tipo_registro": [E]}) == 5
    assert evaluate(star, "d03", ["nome_regiao"]) == {
        "Sudeste": 3, "Centro-Oeste": 2, "ESTRANGEIRO": None,
    }
    assert set(evaluate(star, "d03", ["tipo_registro"]).values()) == {5}
    assert evaluate(star, "d04") == 2
    assert evaluate(star, "d04", (), {"nome_vacina": ["um"]}) == 1


def test_rates(star):
    assert evaluate(star, "d05") == pytest.approx(120 / 1130)
    assert evaluate(star, "d05", ["uf"]) == {"SP": 110 / 130, "ESTRANGEIRO": None}
    by_month = evaluate(star, "d05", ["uf", "mes"], {"uf": ["SP"]})
    assert by_month["SP", dt.date(2026, 1, 1)] == 80 / 130
    assert evaluate(star, "d06", ["uf"])["SP"] == pytest.approx(110 / 130 * 100_000)


def test_target(star):
    assert evaluate(star, "d07") == pytest.approx(TARGET)
    assert evaluate(star, "d07", where_meta={"vacina": ["BCG"]}) == 0.90
    gap = evaluate(star, "d08", ["uf"])
    assert gap["SP"] == pytest.approx((110 / 130 - TARGET) * 100)
    # A blank rate subtracts as zero.
    assert gap["ESTRANGEIRO"] == pytest.approx(-TARGET * 100)


def test_months(star):
    month = lambda n: dt.date(2026, n, 1)
    before = evaluate(star, "d09", ["mes"])
    assert len(before) == 12
    # December 2025 is outside the calendar; February has no doses.
    assert before[month(1)] is None and before[month(2)] == 80 and before[month(3)] is None
    change = evaluate(star, "d10", ["mes"])
    assert change[month(2)] == -1.0 and change[month(3)] is None and change[month(4)] == -1.0
    running = evaluate(star, "d11", ["mes"])
    assert [running[month(n)] for n in (1, 2, 3, 12)] == [80, 80, 110, 110]


def test_month_filter_does_not_hide_the_month_before(star):
    found = evaluate(star, "d09", ["mes"], {"mes_numero": [2]})
    assert found == {dt.date(2026, 2, 1): 80}
    assert evaluate(star, "d11", ["mes"], {"trimestre": [2]})[dt.date(2026, 4, 1)] == 110


def test_months_per_slicer(star):
    found = evaluate(star, "d09", ["uf", "mes"])
    assert found["SP", dt.date(2026, 2, 1)] == 80
    assert found["ESTRANGEIRO", dt.date(2026, 2, 1)] is None
    assert found["ESTRANGEIRO", dt.date(2026, 4, 1)] == 10
    assert len(found) == 24


def test_running_sum_restarts(spark):
    from doselake.operators import periods

    rows = [(dt.date(y, m, 1), v) for y, m, v in ((2025, 11, 1), (2025, 12, 2), (2026, 1, 4))]
    series = spark.createDataFrame(rows, "mes date, v bigint")
    found = periods.year_to_date(series, "mes", [], "v", "t").orderBy("mes").collect()
    assert [r["t"] for r in found] == [1, 3, 4]


def test_spread(star):
    a, b = 80 / 100, 30 / 30
    mean = (a + b) / 2
    deviation = (((a - mean) ** 2 + (b - mean) ** 2) / 2) ** 0.5
    # N has no population and R1, R2 no doses: blank rates are skipped.
    assert evaluate(star, "d12") == pytest.approx(mean)
    assert evaluate(star, "d13") == pytest.approx(deviation)
    assert evaluate(star, "d14") == pytest.approx(deviation / mean)
    by_region = evaluate(star, "d12", ["nome_regiao"])
    assert by_region["Sudeste"] == pytest.approx(mean) and by_region["Centro-Oeste"] is None


def test_ranking(star):
    # Blank counts as zero: N, R1, R2 and X tie for the worst place.
    assert evaluate(star, "d15") == {"N": 1, "R1": 1, "R2": 1, "X": 1, "A": 5, "B": 6}
    assert evaluate(star, "d15", (), {"chave_municipio": ["A"]}) == {"A": 5}
    assert evaluate(star, "d15", (), {"uf": ["SP"]}) == {"N": 1, "A": 2, "B": 3}
    worst = measures.piores_municipios(measures.context(star), 3).collect()
    assert [r["chave_municipio"] for r in worst] == ["N", "R1", "R2"]


def test_below_target(star):
    # A, N, R1, R2 and X are below; real places are A, B, N, R1, R2.
    assert evaluate(star, "d16") == 5 / 5
    by_region = evaluate(star, "d16", ["nome_regiao"])
    assert by_region == {"Sudeste": 2 / 3, "Centro-Oeste": 1.0, "ESTRANGEIRO": None}


def test_municipality_measures_by_other_slicers(star):
    # Vaccine "um": A 60/100, B 30/30. Vaccine "dois": A 20/100; X has no population.
    a1, b1, a2 = 60 / 100, 30 / 30, 20 / 100
    assert evaluate(star, "d12", ["nome_vacina"]) == pytest.approx({"um": (a1 + b1) / 2, "dois": a2})
    assert evaluate(star, "d13", ["nome_vacina"]) == pytest.approx({"um": (b1 - a1) / 2, "dois": 0})
    # Of six members B alone reaches the target, with "um" only; five are real places.
    assert evaluate(star, "d16", ["nome_vacina"]) == {"um": 5 / 5, "dois": 6 / 5}
    by_both = evaluate(star, "d16", ["nome_regiao", "nome_vacina"])
    assert by_both["Sudeste", "um"] == 2 / 3 and by_both["Sudeste", "dois"] == 3 / 3


def test_share_below_an_unset_target(star):
    assert evaluate(star, "d16", where_meta={"vacina": ["nenhuma"]}) is None
    assert evaluate(star, "d16", where_meta={"vacina": ["BCG"]}) == 1.0


def test_doses_off_listed_places(star):
    assert evaluate(star, "d17") == pytest.approx(10 / 120)
    assert evaluate(star, "d17", ["uf"]) == {"SP": None, "ESTRANGEIRO": 1.0}
    # Choosing a record type moves the whole, not the part.
    assert evaluate(star, "d17", (), {"tipo_registro": [V]}) == 10 / 110
    assert evaluate(star, "d17", ["tipo_registro"]) == {V: 10 / 110, E: 10 / 10}


def test_shares(star):
    strategies = evaluate(star, "d19", ["uf", "chave_estrategia"])
    assert strategies["SP", "2"] == 30 / 110 and strategies["ESTRANGEIRO", "1"] == 1.0
    # A filter on the dimension itself does not shrink the whole.
    assert evaluate(star, "d20", ["nome_sexo"], {"sexo": ["M"]}) == {"Masculino": 30 / 120}
    bands = measures.measure(star, "d18").collect()
    assert sum(r["pct_faixa_etaria"] for r in bands) == pytest.approx(1)


def test_unknown_column(star):
    with pytest.raises(ValueError):
        measures.measure(star, "d01", ["cor"])


def test_time_measures_under_any_slicer(star):
    # January 80 and March 30 doses lie in the calendar, ten doses outside it.
    assert evaluate(star, "d09", ["trimestre"]) == {1: 80, 2: 30, 3: None, 4: None}
    assert evaluate(star, "d09", ["ano"]) == {2026: 110}
    assert evaluate(star, "d09") == 110
    assert evaluate(star, "d10") == pytest.approx((120 - 110) / 110)
    assert evaluate(star, "d10", ["trimestre"]) == {1: 30 / 80, 2: -1.0, 3: None, 4: None}
    assert evaluate(star, "d11", ["ano"]) == {2026: 110}
    assert evaluate(star, "d11") == 110
    assert evaluate(star, "d11", (), {"mes_numero": [1, 2]}) == 80
    assert evaluate(star, "d11", ["uf", "trimestre"])["ESTRANGEIRO", 1] == 10
    assert evaluate(star, "d09", ["mes_vacina"])[dt.date(2026, 2, 1)] == 80


def test_members_without_doses(star):
    by_month = evaluate(star, "d02", ["mes"])
    # Twelve months, one outside the calendar, and the doses without a month.
    assert len(by_month) == 14 and set(by_month.values()) == {1130}
    bands = [r[0] for r in seeds.faixa_etaria(star.fato.sparkSession).select("ordem").collect()]
    assert evaluate(star, "d03", ["chave_faixa_etaria"]) == dict.fromkeys({*bands, 0}, 5)
    assert evaluate(star, "d04", ["uf", "nome_estrategia"])["DF", "Rotina"] == 2
    assert evaluate(star, "d07", ["nome_sexo"]) == pytest.approx({"Feminino": TARGET, "Masculino": TARGET})
    gap = evaluate(star, "d08", ["uf"], {"nome_vacina": ["dois"]})
    assert set(gap) == {"SP", "DF", "ESTRANGEIRO"} and gap["DF"] == pytest.approx(-TARGET * 100)
    below = evaluate(star, "d16", ["nome_regiao", "mes"])
    assert below["Sudeste", dt.date(2026, 2, 1)] == 3 / 3
    assert below["Sudeste", dt.date(2026, 1, 1)] == 2 / 3


def test_ranking_under_other_slicers(star):
    rows = measures.measure(star, "d15", ["nome_vacina"]).collect()
    found = {(r["nome_vacina"], r["chave_municipio"]): r["ranking"] for r in rows}
    assert len(found) == 12
    assert found["um", "B"] == 6 and found["um", "A"] == 5
    assert found["dois", "A"] == 6 and found["dois", "B"] == 1
    rows = measures.measure(star, "d15", ["uf"]).collect()
    assert {r["chave_municipio"]: r["ranking"] for r in rows if r["uf"] == "SP"} == {"N": 1, "A": 2, "B": 3}


@pytest.mark.parametrize("seed", range(4))
def test_competition_rank_against_brute_force(spark, seed):
    rng = random.Random(seed)
    # A third of the rows shares one value; the rest spans many magnitudes and signs.
    values = [0.0] * 100 + [rng.choice([-1, 1]) * 10 ** rng.uniform(-9, 9) for _ in range(150)]
    values += [rng.choice([0.5, 0.75, -3.0, 1e300, -1e-300]) for _ in range(50)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = ranking.competition_rank(df, "v", "r").collect()
    assert len(found) == len(values)
    assert all(r["r"] == 1 + sum(w < r["v"] for w in values) for r in found)


def test_rank_ranges_never_decrease(spark):
    values = sorted({10 ** (k / 50) for k in range(-400, 400)} | {1.0, 2.0, 2.0 - 2**-52, 1.0 + 2**-52, -3.5})
    df = spark.createDataFrame([(v,) for v in [*values, None]], "_v double")
    rows = ranking.ranged(df, 16).orderBy(F.col("_v").asc_nulls_first()).collect()
    ranges = [r["_range"] for r in rows]
    assert ranges == sorted(ranges) and ranges[0] == -1 and len(set(ranges)) > 12


def test_close_rates_are_ranked_by_many_tasks(spark):
    """All rates within one percent: every range is about as large as the others."""
    df = spark.range(20_000).selectExpr("0.95 + 0.01 * (pmod(xxhash64(id), 1000000) / 1000000D) AS v", "id % 3 AS g")
    sizes = [r["count"] for r in ranking.ranged(df.selectExpr("v AS _v"), 64).groupBy("_range").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * 20_000 / 64
    rows = ranking.competition_rank(df, "v", "r", ["g"], ranges=64).collect()
    by_group = {}
    for r in rows:
        by_group.setdefault(r["g"], []).append((r["v"], r["r"]))
    for held in by_group.values():
        held.sort()
        assert all(rank == 1 + sum(w < v for w, _ in held[:i]) for i, (v, rank) in list(enumerate(held))[::97])
    assert len(rows) == 20_000
