"""Views, stored tables, publication size, table scans, shared folder."""

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from doselake import registry
from doselake.operators import staging
from doselake.session import shared_folder
from doselake.sources import derived, seeds, tables


def test_view_is_recomputed_and_table_is_stored(spark, tmp_path):
    numbers = spark.range(10).selectExpr("id", "id % 3 AS k")
    assert staging.as_view(numbers, "v_numeros").count() == 10
    stored = staging.as_table(numbers, f"file://{tmp_path}", "gold", "numeros")
    assert stored.columns == ["id", "k"] and stored.count() == 10
    staging.as_table(numbers.limit(4), f"file://{tmp_path}", "gold", "numeros")
    size = staging.publication_size(spark, f"file://{tmp_path}/gold/numeros").first()
    on_disk = [p.stat().st_size for p in (tmp_path / "gold" / "numeros").glob("*.parquet")]
    assert (size["linhas"], size["arquivos"], size["bytes"]) == (4, len(on_disk), sum(on_disk))


def test_month_partition_stays_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, "1996-02"), (2, "1996-03")], "a int, mes_referencia string")
    stored = staging.as_table(rows, f"file://{tmp_path}", "bronze", "t", "mes_referencia")
    assert sorted(r["mes_referencia"] for r in stored.collect()) == ["1996-02", "1996-03"]


@pytest.mark.parametrize("dealt", [False, True])
def test_files_hold_few_rows(spark, tmp_path, monkeypatch, dealt):
    monkeypatch.setattr(staging, "ROWS_PER_FILE", 10)
    rows = spark.range(0, 95, 1, 2).select("id", F.lit("1996-02").alias("m"))
    stored = staging.as_table(rows, f"file://{tmp_path}", "bronze", "t", "m", dealt=dealt)
    files = [pq.read_metadata(p).num_rows for p in tmp_path.rglob("*.parquet")]
    assert max(files) == 10 and sum(files) == 95 and stored.distinct().count() == 95


def test_splits_of_the_lake_are_small(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    registry.lake_of(spark, SF_DIR)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == registry.SPLIT


def test_doses_are_dealt_before_their_texts_are_made(spark):
    plan = derived.bronze(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    above, found, below = plan.partition("RebalancePartitions")
    assert found and "co_documento" in above and "co_documento" not in below


def test_drops_are_written_from_where_rows_lie(spark, tmp_path):
    texts = [F.col("id").cast("string").alias(c) for c in tables.BRONZE_COLUMNS]
    rows = spark.range(0, 4, 1, 4).select(*texts, F.lit("1996-02").alias("mes_referencia"))
    derived.write_drops(rows, f"file://{tmp_path}/d")
    files = list(tmp_path.rglob("*.csv/*.csv")) or [p for p in tmp_path.rglob("part-*.csv")]
    assert len(files) == 4 and sum(len(p.read_text().splitlines()) - 1 for p in files) == 4


def test_scan_by_path_or_name(spark, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/p")
    spark.range(4).createOrReplaceTempView("t_quatro")
    found = tables.inputs(spark, f"file://{tmp_path}/p", "t_quatro", "t_quatro")
    assert (found.bronze.count(), found.diretorio.count()) == (3, 4)


def test_shared_folder_is_below_the_named_one_and_fresh(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark), shared_folder(spark)
    assert one.startswith(base) and one != two


def test_seeds(spark):
    assert [r["ordem"] for r in seeds.display_order(seeds.faixa_etaria(spark)).collect()] == list(range(8))
    assert seeds.uf_ibge(spark).count() == 27
    targets = seeds.meta_vacinal(spark)
    assert targets.count() == 19
    assert targets.agg({"meta_cobertura": "avg"}).first()[0] == pytest.approx(0.9315789473684)


def test_derived_month_shift():
    assert derived.YEAR_SHIFT == 25 and "substr(m, 5, 3)" in derived.shifted_month_sql("m")
