"""Interval lookups, digests, sketches, heavy values and lineage on small tables."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from doselake.operators import digests, incremental, profiling, sketches
from doselake.operators.bands import with_band
from doselake.plans import lineage, pipeline

BIG = (1 << 63) - 1
BANDS = "ordem int, idade_min long, idade_max long"


def by_hand(values, bands):
    out = []
    for i, v in values:
        hits = [o for o, lo, hi in bands if None not in (v, lo, hi) and lo <= v <= hi]
        out += [(i, v, o) for o in hits] or [(i, v, None)]
    return sorted(out, key=str)


def looked_up(spark, values, bands, **options):
    df = spark.createDataFrame(values, "i int, v long")
    held = spark.createDataFrame(bands, BANDS)
    rows = with_band(df, F.col("v"), held, **options).select("i", "v", "faixa").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"small": 0, "per_block": 4}, {"small": 0}])
@pytest.mark.parametrize("seed", range(3))
def test_bands_with_overlaps_and_gaps(spark, seed, options):
    draw = random.Random(seed)
    # Seconds since 1970, a third of the values alike.
    lows = [draw.randrange(-(10**6), 2 * 10**9) for _ in range(40)]
    bands = [(i, lo, lo + draw.choice([0, 1, 86_400, 10**8])) for i, lo in enumerate(lows)]
    bands += [(90, 5, 4), (91, None, 7), (92, 7, None), (93, -BIG - 1, -BIG), (94, BIG - 3, BIG), (95, lows[0], lows[0])]
    values = [draw.choice(lows) + draw.choice([-1, 0, 1, 86_400, 86_401]) for _ in range(200)]
    values += [None, BIG, BIG - 4, -BIG - 1, 0] + [lows[0]] * 100
    values = list(enumerate(values))
    assert looked_up(spark, values, bands, **options) == by_hand(values, bands)


@pytest.mark.parametrize("small", [0, 10])
def test_no_bands(spark, small):
    values = [(1, 5), (2, None)]
    assert looked_up(spark, values, [(1, 5, 4)], small=small) == [(1, 5, None), (2, None, None)]


def test_many_overlaps_go_by_the_sweep(spark):
    bands = [(i, i, 1000 - i) for i in range(100)]
    values = list(enumerate(range(-5, 1010, 7)))
    assert looked_up(spark, values, bands, small=100, per_block=16) == by_hand(values, bands)


# --- digests --------------------------------------------------------------------------------


def test_digests_open_only_what_differs(spark):
    rows = [(i % 700, f"k{i % 13}" if i % 5 else None, i % 4) for i in range(3000)]
    left = spark.createDataFrame(rows, "a int, b string, n int")
    changed = [*rows[:100], (*rows[100][:2], 99), *rows[102:], rows[7], (None, None, None)]
    right = spark.createDataFrame(changed, "a int, b string, n int").repartition(5)
    found = {tuple(r) for r in digests.differences(left, right, ["a", "b"], ["n"], fanout=16).collect()}
    assert found == {
        (*rows[100], "esquerda", 1), (*rows[101], "esquerda", 1), (*rows[100][:2], 99, "direita", 1),
        (*rows[7], "direita", 1), (None, None, None, "direita", 1),
    }
    assert digests.differing_parts(left, right, ["a", "b"], ["n"], fanout=16).count() <= 5
    assert digests.differences(left, left.repartition(3), ["a", "b"], ["n"]).count() == 0
    assert digests.differences(left, left.limit(0), ["a", "b"], ["n"]).agg(F.sum("vezes")).first()[0] == 3000


# --- sketches ---------------------------------------------------------------------------------


def test_merged_sketches_are_near_the_count(spark):
    df = spark.range(60_000).selectExpr("id % 12 AS mes", "id % 3 AS uf", "id % 20000 AS doc", "CAST(NULL AS long) AS nada")
    stored = sketches.sketches(df, "doc", ["uf", "mes"])
    assert stored.count() == 12
    by_state = sketches.estimates(sketches.merged(stored, ["uf"]), "n").collect()
    exact = dict(df.groupBy("uf").agg(F.count_distinct("doc")).collect())
    assert all(abs(r["n"] - exact[r["uf"]]) <= 0.02 * exact[r["uf"]] for r in by_state)
    # Values of several months count once.
    (total,) = sketches.estimates(sketches.merged(stored, []), "n").collect()
    assert abs(total["n"] - 20_000) <= 400
    assert sketches.sketches(df, "nada", ["uf"]).count() == 0


# --- heavy values -----------------------------------------------------------------------------


def test_heavy_values_are_exact(spark):
    draw = random.Random(3)
    rows = [(f"d{i}", draw.choice(["x"] * 60 + [f"v{j}" for j in range(60)]), draw.choice([None, 1, 2])) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc string, v string, n int")
    found = {(r["coluna"], r["valor"]): r["linhas"] for r in profiling.heavy_values(df, ["doc", "v", "n"]).collect()}
    want = {}
    for name, at in (("doc", 0), ("v", 1), ("n", 2)):
        for value in {r[at] for r in rows if r[at] is not None}:
            count = sum(r[at] == value for r in rows)
            if count * 100 >= len(rows):
                want[(name, str(value))] = count
    assert found == want and ("v", "x") in want and len(want) < 61


# --- contenders ---------------------------------------------------------------------------------


def test_contenders_follow_reloaded_months(spark, tmp_path):
    schema = "k string, m string, t int, x string"
    rows = [("a", "1", 5, "p"), ("a", "2", 9, "q"), ("b", "1", 3, "r"), (None, "1", 1, "s"), (None, "2", 2, "t"), ("c", "2", None, "u")]
    table = incremental.Contenders(spark, "disputa_teste", f"file://{tmp_path}/c", "k", "m", ["x"], buckets=4)
    table.create(spark.createDataFrame(rows, schema), F.col("t"))

    def winners():
        return {r["k"]: r["x"] for r in table.winners().collect()}

    assert winners() == {"a": "q", "b": "r", None: "t", "c": "u"}
    # Month 2 again, without the newest version of a: the older one surfaces.
    table.replace(spark.createDataFrame([("b", "2", 8, "v"), ("b", "2", 7, "w")], schema), F.col("t"))
    assert winners() == {"a": "p", "b": "v", None: "s"}
    table.replace(spark.createDataFrame([], schema), F.col("t"), months=["2"])
    assert winners() == {"a": "p", "b": "r", None: "s"}
    plan = plan_of(table.winners())
    assert "Exchange" not in plan and "Bucketed: true" in plan
    spark.sql("DROP TABLE disputa_teste")


def test_contenders_get_more_buckets_for_more_rows(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id % 50 as string) AS k", "cast(id div 50 as string) AS m", "id AS t", "'x' AS x")
    folder = f"file://{tmp_path}/c"
    table = incremental.Contenders(spark, "disputa_maior", folder, "k", "m", ["x"], buckets=2, per_bucket=30)
    table.create(rows, F.col("t"))

    def buckets():
        about = spark.sql("DESCRIBE TABLE EXTENDED disputa_maior").where("col_name = 'Num Buckets'")
        return int(about.first()["data_type"])

    assert buckets() == 4
    table.replace(rows.where("m = '1' AND t < 60").withColumn("x", F.lit("y")), F.col("t"))
    assert buckets() == 4 and table.winners().groupBy("x").count().orderBy("x").collect() == [("x", 40), ("y", 10)]
    spark.sql("DROP TABLE disputa_maior")


# --- lineage ------------------------------------------------------------------------------------


def test_outcomes_do_not_depend_on_order(spark):
    needs = {"z": ("y", "b"), "y": ("a",), "a": (), "b": (), "c": ("b",)}
    failed = spark.createDataFrame([("a",), ("y",), ("a",)], "tabela string")
    rows = {r["modelo"]: (r["situacao"], r["motivo"]) for r in lineage.outcomes(lineage.edges(spark, needs), failed).collect()}
    assert rows == {
        "a": (lineage.FAILED, None), "b": (lineage.BUILT, None), "c": (lineage.BUILT, None),
        "y": (lineage.SKIPPED, "a"), "z": (lineage.SKIPPED, "a, y"),
    }


def test_build_reports_what_it_skipped(spark):
    done = pipeline.Build(tables={"stg_ibge__municipios": None}, failures={"stg_ibge__municipios": "x", "dim_municipio": "skipped"})
    rows = {r["modelo"]: r["situacao"] for r in done.report(spark).collect()}
    assert rows["stg_ibge__municipios"] == lineage.FAILED
    assert {m for m, s in rows.items() if s == lineage.SKIPPED} == {
        "dim_municipio", "mart_cobertura_vacinal", "mart_cobertura_vacinal_resumo",
    }
