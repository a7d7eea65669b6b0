"""Drops loaded as they arrive."""

import pytest

from doselake.operators import load
from doselake.streaming.arrivals import follow, problems


@pytest.fixture
def run(spark, tmp_path):
    (tmp_path / "csv").mkdir()

    def once():
        follow(
            spark,
            f"file://{tmp_path}/csv",
            f"file://{tmp_path}/bronze",
            f"file://{tmp_path}/log",
            f"file://{tmp_path}/offsets",
        ).awaitTermination()
        stored = load.bronze_table(spark, f"file://{tmp_path}/bronze", ["a"])
        return sorted(tuple(r) for r in stored.select("mes_referencia", "a").collect())

    return tmp_path / "csv", once


def test_new_files_only(spark, run, tmp_path):
    folder, once = run
    (folder / "d_2026_01.csv").write_text("a;b\n1;x\n")
    assert once() == [("2026-01", "1")]
    (folder / "d_2026_02.csv").write_text("a;b\n2;x\n")
    assert once() == [("2026-01", "1"), ("2026-02", "2")]
    (folder / "e_2026_01.csv").write_text("a;b\n3;x\n")
    assert once() == [("2026-01", "3"), ("2026-02", "2")]
    assert spark.read.parquet(f"file://{tmp_path}/log").count() == 3


def test_late_part_keeps_its_drop_whole(run):
    folder, once = run
    drop = folder / "d_2026_01.csv"
    drop.mkdir()
    (drop / "part-0.csv").write_text("a;b\n1;x\n")
    once()
    (drop / "part-1.csv").write_text("a;b\n2;x\n")
    assert once() == [("2026-01", "1"), ("2026-01", "2")]


def test_stream_moves_past_a_problem(spark, run, tmp_path):
    folder, once = run
    (folder / "d_2026_01.csv").write_text("a;b\n1;x\n")
    (folder / "sem_mes.csv").write_text("a;b\n1;x\n")
    assert once() == [("2026-01", "1")]
    (folder / "d_2026_02.csv").write_text("a;b\n2;x\n")
    assert once() == [("2026-01", "1"), ("2026-02", "2")]
    told = problems(spark, f"file://{tmp_path}/offsets").collect()
    assert len(told) == 1 and told[0].lote == 0
    assert "sem_mes.csv" in told[0].problema and "mes nao identificado" in told[0].problema
    assert spark.read.parquet(f"file://{tmp_path}/log").count() == 2
