"""Checks, gate, gated build, layer invariants, privacy of gold."""

import pytest

from doselake.operators import quality
from doselake.operators.quality import Check
from doselake.plans import checks, facts, pipeline
from doselake.sources import derived
from doselake.sources.tables import Inputs


def results(tables, *declared):
    return {
        (r["column"], r["check"]): (r["failures"], r["passed"], r["severity"])
        for r in quality.run_checks(tables, declared).collect()
    }


def test_counting_rules(spark):
    child = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", "y"), ("c", None), (None, "z"), (None, "z")], "k string, v string"
    )
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    found = results(
        {"child": child, "parent": parent},
        Check("child", "k", quality.UNIQUE),
        Check("child", "k", quality.NOT_NULL, where="v = 'z'"),
        Check("child", "v", quality.NOT_NULL, quality.WARN),
        Check("child", "v", quality.ACCEPTED, values=("x",)),
        Check("child", "k", quality.RELATED, parent="parent", parent_key="k"),
    )
    assert found == {
        ("k", quality.UNIQUE): (1, False, "error"),
        ("k", quality.NOT_NULL): (2, False, "error"),
        ("v", quality.NOT_NULL): (1, False, "warn"),
        ("v", quality.ACCEPTED): (2, False, "error"),
        ("k", quality.RELATED): (1, False, "error"),
    }


def test_scope_is_true_or_not_counted(spark):
    # A null condition keeps a row out of the check, as a filter would.
    df = spark.createDataFrame([(None, None), (None, "s"), (None, "t")], "a string, s string")
    found = results({"t": df}, Check("t", "a", quality.NOT_NULL, where="s = 's'"))
    assert found["a", quality.NOT_NULL][0] == 1


def test_gate(spark):
    df = spark.createDataFrame([(None,)], "a string")
    warned = quality.run_checks({"t": df}, [Check("t", "a", quality.NOT_NULL, quality.WARN)])
    assert quality.gate(warned) == ["t.a not_null: 1"]
    with pytest.raises(quality.QualityError):
        quality.gate(quality.run_checks({"t": df}, [Check("t", "a", quality.NOT_NULL)]))


def test_declared_checks():
    kinds = [c.kind for c in checks.CHECKS]
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {
        quality.UNIQUE: 11, quality.NOT_NULL: 38, quality.ACCEPTED: 3, quality.RELATED: 6,
    }
    assert sum(c.severity == quality.WARN for c in checks.CHECKS) == 5
    assert sum(c.where is not None for c in checks.CHECKS) == 3


def _source(lake):
    return Inputs(lake.bronze, lake.directory, lake.population)


SPAN = {"start": derived.CALENDAR_START, "end": derived.CALENDAR_END}


def test_build(spark, lake, tmp_path):
    done = pipeline.build(spark, _source(lake), f"file://{tmp_path}", "dev_", **SPAN)
    assert done.failures == {}
    assert any("populacao" in w for w in done.warnings)
    assert (tmp_path / "dev_gold" / checks.MART / "_SUCCESS").exists()
    tables = done.tables
    fact, mart = tables[checks.FACT], tables[checks.MART]
    doses = tables[checks.DOSES].count()
    assert mart.count() == fact.count()
    for table in (fact, mart, tables[checks.SUMMARY]):
        assert table.agg({"qtd_doses": "sum"}).first()[0] == doses
    assert len(mart.columns) == 28 and len(tables[checks.SUMMARY].columns) == 21
    rows = fact.count()
    again = pipeline.build(spark, _source(lake), f"file://{tmp_path}", "dev_", **SPAN)
    assert again.tables[checks.FACT].count() == rows


def test_failed_check_skips_dependents(spark, lake, tmp_path):
    twice = lake.directory.unionByName(lake.directory)
    source = Inputs(lake.bronze, twice, lake.population)
    done = pipeline.build(spark, source, f"file://{tmp_path}", **SPAN)
    assert "unique" in done.failures[checks.MUNICIPALITIES]
    assert done.failures["dim_municipio"].startswith("skipped")
    assert done.failures[checks.MART].startswith("skipped")
    # What does not depend on the directory is built.
    assert checks.FACT not in done.failures and "dim_vacina" not in done.failures


def test_calendar_too_short_fails_the_fact(spark, lake, tmp_path):
    done = pipeline.build(spark, _source(lake), f"file://{tmp_path}")
    assert "mes_vacina relationships" in done.failures[checks.FACT]
    assert done.failures[checks.SUMMARY].startswith("skipped")


def test_gold_holds_no_personal_column(lake):
    allowed = {"qtd_doses"}
    for r in facts.RELATIONS:
        allowed |= {r.fact_key, r.key, *r.attributes}
    allowed |= {"co_vacina", "co_dose_vacina"}
    star = lake.star
    for table in (star.fato, star.municipio, star.vacina, star.perfil, star.estrategia, lake.mart):
        assert set(table.columns) <= allowed


def test_every_join_matches(lake):
    """A join on the wrong key matches nothing and passes every other check."""
    row = lake.mart.selectExpr(
        "avg(int(nome_vacina IS NOT NULL)) AS vacina", "avg(int(nome_mes IS NOT NULL)) AS tempo",
        "avg(int(nome_faixa_etaria IS NOT NULL)) AS faixa", "avg(int(nome_sexo IS NOT NULL)) AS perfil",
        "avg(int(nome_estrategia IS NOT NULL)) AS estrategia", "avg(int(uf IS NOT NULL)) AS municipio",
        "avg(int(nome_municipio IS NOT NULL)) AS nome",
    ).first()
    assert all(row[c] == 1.0 for c in ("vacina", "tempo", "faixa", "perfil", "estrategia", "municipio"))
    assert row["nome"] > 0.5


def test_unreconciled_keys(spark):
    columns = "mes_vacina string, chave_municipio string, qtd_doses bigint"
    one = spark.createDataFrame([("m", "a", 1), ("m", None, 2)], columns)
    two = spark.createDataFrame([("m", "a", 1), ("m", None, 3), ("m", "b", 1)], columns)
    assert checks.unreconciled_keys(one, one).count() == 0
    found = {r["chave_municipio"]: (r["recalculado"], r["gravado"]) for r in checks.unreconciled_keys(one, two).collect()}
    assert found == {None: (2, 3), "b": (0, 1)}
