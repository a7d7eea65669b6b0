"""Loading drops into the month-partitioned bronze table (K1-K5)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import drops
from ..sources.tables import BRONZE_COLUMNS, MONTH_COLUMN
from . import snapshots

FILE_COLUMN = "arquivo_origem"

# --- fixed values: layout of the load log -------------------------------------------
LOG_SCHEMA = T.StructType(
    [
        T.StructField("carregado_em", T.TimestampType()),
        T.StructField("mes_referencia", T.DateType()),
        T.StructField("arquivo", T.StringType()),
        T.StructField("arquivo_sha256", T.StringType()),
        T.StructField("arquivo_bytes", T.LongType()),
        T.StructField("encoding", T.StringType()),
        T.StructField("delimitador", T.StringType()),
        T.StructField("linhas_no_csv", T.LongType()),
        T.StructField("linhas_carregadas", T.LongType()),
        T.StructField("colunas", T.LongType()),
        T.StructField("reconciliado", T.BooleanType()),
    ]
)
# ---------------------------------------------------------------------------------------

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("remessa", T.StringType()),
        T.StructField("arquivo", T.StringType()),
        T.StructField("mes_referencia", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("modificado", T.TimestampType()),
        T.StructField("encoding", T.StringType()),
        T.StructField("delimitador", T.StringType()),
        T.StructField("cabecalho", T.ArrayType(T.StringType())),
        T.StructField("colunas", T.ArrayType(T.StringType())),
        T.StructField("linhas_no_csv", T.LongType()),
        T.StructField("quebra_em_aspas", T.BooleanType()),
        T.StructField("arquivo_sha256", T.StringType()),
        T.StructField("problema", T.StringType()),
    ]
)
# What the bytes of a file tell, and its name does not.
FOUND = MANIFEST_SCHEMA.names[MANIFEST_SCHEMA.names.index("encoding") :]
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField(FILE_COLUMN, T.StringType()),
        T.StructField(MONTH_COLUMN, T.StringType()),
        T.StructField("linha", T.StringType()),
        T.StructField("campos", T.LongType()),
        T.StructField("colunas", T.LongType()),
        T.StructField("motivo", T.StringType()),
    ]
)

NEW_COLUMN = "falta na tabela"
MISSING_COLUMN = "falta no csv"

LINES = "linhas"
RECORDS = "registros"

SHORT = "colunas a menos"
LONG = "colunas a mais"
MALFORMED = "registro malformado"


class ReconciliationError(Exception):
    """Loaded rows differ from source rows, or files could not be loaded."""


@dataclass
class LoadReport:
    log: DataFrame | None = None
    drift: DataFrame | None = None
    problems: list[str] = field(default_factory=list)

    def raise_for_problems(self) -> None:
        if self.problems:
            raise ReconciliationError(
                f"{len(self.problems)} file(s) with problems: " + "; ".join(self.problems)
            )


# --- what readers see ----------------------------------------------------------------------


def bronze_table(spark: SparkSession, table: str, columns: Sequence[str] = BRONZE_COLUMNS) -> DataFrame:
    """The newest version of the bronze with the wanted columns, all text; absent ones are null."""
    months = snapshots.latest(spark, table).months
    names = [*columns, FILE_COLUMN, MONTH_COLUMN]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, snapshots.LOAD_COLUMN)])
    folders = [
        f"{snapshots.rows_folder(table, m.carga)}/{MONTH_COLUMN}={mes}" for mes, m in months.items() if m.carga
    ]
    if not folders:
        return spark.createDataFrame([], schema).select(names)
    rows = spark.read.schema(schema).option("basePath", f"{table}/linhas").parquet(*folders)
    return rows.select(names)


def target_columns(spark: SparkSession, table: str) -> list[str] | None:
    return snapshots.latest(spark, table).columns() or None


def load_log(spark: SparkSession, table: str, log_table: str) -> DataFrame:
    """The log rows of all loads that have a version of ``table`` (K2)."""
    return snapshots.visible(_stored(spark, log_table, LOG_SCHEMA), table)


def manifest_table(spark: SparkSession, table: str) -> DataFrame:
    """Every file state a load with a version has seen, with what it found out."""
    return snapshots.visible(_stored(spark, f"{table}/manifesto", MANIFEST_SCHEMA), table)


def quarantine(spark: SparkSession, table: str) -> DataFrame:
    """Rows that did not fit their header, with file and reason."""
    return snapshots.visible(_stored(spark, f"{table}/quarentena", QUARANTINE_SCHEMA), table)


def _stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    schema = T.StructType([*schema.fields, T.StructField(snapshots.LOAD_COLUMN, T.StringType())])
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException:  # no load has written there
        return spark.createDataFrame([], schema)


def schema_drift(headers: DataFrame, target: Sequence[str]) -> DataFrame:
    """Columns the table lacks or the drops lack, and in how many drops.

    ``headers`` holds the clean column names (``colunas``) of each ``remessa``. A
    warning, never a stop.
    """
    spark = headers.sparkSession
    held = (
        headers.select("remessa", F.explode("colunas").alias("coluna"))
        .groupBy("coluna")
        .agg(F.count_distinct("remessa").alias("_with"))
    )
    known = spark.createDataFrame([(c,) for c in target], "_known string")
    total = headers.agg(F.count_distinct("remessa").alias("n"))
    without = total.scalar() - F.coalesce("_with", F.lit(0))
    new = F.col("_known").isNull()
    return (
        held.join(known, F.col("coluna") == F.col("_known"), "full_outer")
        .select(
            F.coalesce("coluna", "_known").alias("coluna"),
            F.when(new, NEW_COLUMN).otherwise(MISSING_COLUMN).alias("situacao"),
            F.when(new, F.col("_with")).otherwise(without).alias("remessas"),
        )
        .filter("remessas > 0")
    )


# --- loading -------------------------------------------------------------------------------


def _formats(files: DataFrame) -> list[Row]:
    """One row per distinct header and format, with the names of its files."""
    kind = ["fica", "colunas", "encoding", "delimitador", "quebra_em_aspas"]
    return files.groupBy(kind).agg(F.collect_list("path").alias("paths")).collect()


def _read(spark: SparkSession, formats: Sequence[Row]) -> DataFrame:
    parts = [
        drops.read_rows(spark, f["paths"], f["colunas"], f["encoding"], f["delimitador"], f["quebra_em_aspas"])
        for f in formats
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _counts(rows: DataFrame, column: str, *read: str) -> DataFrame:
    """Whole rows, bad rows and line breaks inside quotes per file.

    ``read``: columns of the file, without which its reader would not judge rows.
    """
    bad = F.col(drops.BAD_COLUMN).isNotNull()
    for c in read:
        bad &= F.coalesce(F.length(c), F.lit(0)) >= 0
    return rows.groupBy(F.col(column).alias("uri")).agg(
        F.count_if(~bad).alias("linhas_carregadas"),
        F.count_if(bad).alias("ruins"),
        F.sum(drops.BREAKS_COLUMN).alias("quebras"),
    )


def reconcile(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Source and loaded rows per file, a file on either side alone included."""
    both = expected.join(loaded, "uri", "full_outer")
    zero = F.lit(0).cast("bigint")
    return both.select(
        "uri",
        F.coalesce("linhas_no_csv", zero).alias("linhas_no_csv"),
        F.coalesce("linhas_carregadas", zero).alias("linhas_carregadas"),
    ).withColumn("reconciliado", F.col("linhas_no_csv") == F.col("linhas_carregadas"))


def rows_per_file(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("uri")).agg(F.count("*").alias("linhas_carregadas"))


def _expected(files: DataFrame, counts: DataFrame, gate: str) -> DataFrame:
    """Rows each file should have: its lines, or its lines less those that begin inside quotes.

    Lines are counted by the scan of lines; the breaks inside quotes by looking into the
    rows that were stored. Records that a parse loses or glues make the two disagree.
    """
    if gate == LINES:
        return files.select("uri", "linhas_no_csv")
    in_header = F.regexp_count(F.array_join("cabecalho", ""), F.lit(drops.LINE_BREAK))
    inside = F.coalesce("quebras", F.lit(0)) + F.coalesce(in_header, F.lit(0))
    return files.join(counts, "uri", "left").select(
        "uri", (F.col("linhas_no_csv") - inside).alias("linhas_no_csv")
    )


def _log_rows(files: DataFrame, result: DataFrame, stamp: datetime) -> DataFrame:
    return result.join(files.drop("linhas_no_csv"), "uri").select(
        F.lit(stamp).alias("carregado_em"),
        F.to_date(F.concat(MONTH_COLUMN, F.lit("-01"))).alias("mes_referencia"),
        F.when(F.col("remessa") == F.col("arquivo"), F.col("arquivo"))
        .otherwise(F.concat("remessa", F.lit("/"), "arquivo"))
        .alias("arquivo"),
        "arquivo_sha256",
        F.col("bytes").alias("arquivo_bytes"),
        "encoding",
        "delimitador",
        "linhas_no_csv",
        "linhas_carregadas",
        F.size("colunas").cast("bigint").alias("colunas"),
        "reconciliado",
    )


def _bad_rows(staged: DataFrame, files: DataFrame) -> DataFrame:
    """The rows that do not fit, with how many fields they have and should have."""
    about = files.select("uri", "delimitador", F.size("colunas").cast("long").alias("colunas"))
    bad = staged.where(F.col(drops.BAD_COLUMN).isNotNull())
    plain = F.regexp_replace("linha", '"(?:[^"]|"")*"', "")
    return (
        bad.select(F.col(FILE_COLUMN).alias("uri"), MONTH_COLUMN, F.col(drops.BAD_COLUMN).alias("linha"))
        .join(about, "uri")
        .withColumn("campos", (F.length(plain) - F.length(F.replace(plain, F.col("delimitador")))).cast("long") + 1)
        .select(
            F.col("uri").alias(FILE_COLUMN),
            MONTH_COLUMN,
            "linha",
            "campos",
            "colunas",
            F.when(F.col("campos") < F.col("colunas"), SHORT)
            .when(F.col("campos") > F.col("colunas"), LONG)
            .otherwise(MALFORMED)
            .alias("motivo"),
        )
    )


def _chosen(files: DataFrame) -> DataFrame:
    """Usable files with ``fica``: whether their drop is the month's last by path.

    A drop lies where its file or its folder of parts lies; a part with a problem makes
    the whole drop unusable.
    """
    folder = F.regexp_extract("uri", r"^(.*\.csv)/[^/]+$", 1)
    dropped = files.withColumn("drop", F.when(folder != "", folder).otherwise(F.col("uri")))
    broken = dropped.where("problema is not null").select("drop").distinct()
    good = dropped.join(broken, "drop", "left_anti")
    last = good.groupBy(MONTH_COLUMN).agg(F.max("drop").alias("_last"))
    return good.join(last, MONTH_COLUMN).withColumn("fica", F.col("drop") == F.col("_last")).drop("drop", "_last")


def inspect(
    spark: SparkSession, source: str | Sequence[str], mes: str | None = None
) -> DataFrame:
    """Dry run (K4): month, format, header, counts and problems per file; no write."""
    listed, _ = drops.listing(spark, source, mes)
    return drops.manifest(spark, listed, with_hash=False)


def _told(files: DataFrame) -> list[str]:
    return [f"{f['remessa']}: {f['problema']}" for f in files.select("remessa", "problema").collect()]


def _facts(listed: DataFrame, table: str, load: str, only_new: bool) -> DataFrame:
    """Stores what is found out about new files; returns the files to load with all facts.

    A file is known by its place, size and time. Of known files no byte is read here;
    unless ``only_new``, they are loaded again by what the manifest says.
    """
    spark = listed.sparkSession
    state = ["uri", "bytes", "modificado"]
    known = manifest_table(spark, table).select(*state, *FOUND)
    seen = reduce(Column.__and__, [listed[c].eqNullSafe(known[c]) for c in state])
    folder = f"{table}/manifesto/{snapshots.LOAD_COLUMN}={load}"
    drops.facts(spark, listed.join(known, seen, "left_anti")).select(MANIFEST_SCHEMA.names).write.parquet(folder)
    files = spark.read.schema(MANIFEST_SCHEMA).parquet(folder)
    if not only_new:
        files = files.unionByName(listed.join(known, seen).select(*[listed[c] for c in listed.columns], *FOUND))
    return drops.judged(files)


def load(
    spark: SparkSession,
    source: str | Sequence[str],
    table: str,
    log_table: str,
    mes: str | None = None,
    gate: str = LINES,
    only_new: bool = False,
) -> LoadReport:
    """Load a folder or a list of files into ``table``, month by month.

    Rows are staged, counted and judged before anything of them can be read. A month is
    replaced when all files of its drop pass the gate; then one record makes the accepted
    months, the log rows and the manifest rows visible together (`snapshots`). A file whose
    counts differ or that has rows of the wrong width fails alone: it is logged, its bad
    rows go to the `quarantine`, its month stays as it was, and other months are replaced.
    Problems are collected in the report and raised by ``raise_for_problems``.

    ``gate`` compares loaded rows with physical lines, as the log records them, or with
    lines less those that begin inside quotes. ``only_new`` leaves out files the manifest
    knows by place, size and time; else they are loaded again.
    """
    report = LoadReport()
    listed, missing = drops.listing(spark, source, mes)
    report.problems += [f"{path}: nao encontrado" for path in missing]
    base = snapshots.latest(spark, table)
    own = uuid.uuid4().hex
    files = _facts(listed, table, own, only_new)
    report.problems += _told(files.where("problema is not null"))
    chosen = _chosen(files)
    formats = _formats(chosen)
    if not formats:
        if report.problems:  # so that they are not judged again
            snapshots.commit(spark, table, own, base, {})
        return report
    kept = chosen.where("fica")
    if base.months:
        report.drift = schema_drift(kept.select("remessa", "colunas"), base.columns())

    staged = _staged(spark, formats, kept, table, own)
    counts = _counts(staged, FILE_COLUMN)
    if replaced := [f for f in formats if not f["fica"]]:
        # Parsed and counted like the others, but a later drop holds their month.
        counts = counts.unionByName(
            reduce(DataFrame.unionByName, [_counts(_read(spark, [f]), "uri", f["colunas"][0]) for f in replaced])
        )
    counts = _written(counts, f"{table}/contagem/{snapshots.LOAD_COLUMN}={own}")
    result = reconcile(_expected(chosen, counts, gate), counts.drop("ruins", "quebras"))
    clean = result.join(counts.select("uri", "ruins"), "uri", "left")
    result = clean.withColumn("reconciliado", F.expr("reconciliado and coalesce(ruins, 0) = 0"))
    if counts.where("ruins > 0").limit(1).count():
        _bad_rows(staged, kept).write.parquet(f"{table}/quarentena/{snapshots.LOAD_COLUMN}={own}")
    stamp = datetime.now(timezone.utc)
    log = _written(_log_rows(chosen, result, stamp), f"{log_table}/{snapshots.LOAD_COLUMN}={own}")

    snapshots.commit(spark, table, own, base, _accepted(kept, result, own))
    report.log = log
    failed = result.where("not reconciliado").join(chosen.select("uri", "remessa", "arquivo"), "uri")
    for r in failed.collect():
        name = r["arquivo"] if r["arquivo"] == r["remessa"] else f"{r['remessa']}/{r['arquivo']}"
        quarantined = f", {r['ruins']} em quarentena" if r["ruins"] else ""
        report.problems.append(f"{name}: {r['linhas_no_csv']} linhas, {r['linhas_carregadas']} carregadas{quarantined}")
    return report


def _written(df: DataFrame, folder: str) -> DataFrame:
    """Written once and read back, so it is not computed a second time."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _with_month(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows`` where they lie, with the month of their file: the manifest, a row per file
    like the driver's file index, goes to them."""
    return rows.join(F.broadcast(kept.select("uri", MONTH_COLUMN)), "uri")


def _staged(spark: SparkSession, formats: list[Row], kept: DataFrame, table: str, load: str) -> DataFrame:
    """The rows of the kept files in folders by month.

    The rows come straight from the files, and a file is one month: every input split
    already belongs to one month (or, packed, to a few small ones), so the write needs no
    shuffle and its files are as large as the splits. The month is a fact of the file,
    looked up in the manifest and not parsed from the name per row.
    """
    rows = _with_month(_read(spark, [f for f in formats if f["fica"]]), kept)
    rows = rows.withColumnRenamed("uri", FILE_COLUMN)
    folder = snapshots.rows_folder(table, load)
    rows.write.partitionBy(MONTH_COLUMN).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _accepted(kept: DataFrame, result: DataFrame, load: str) -> dict[str, snapshots.Month]:
    """The months all files of whose drop are reconciled; only a drop without lines empties one."""
    months = (
        kept.join(result.select("uri", "linhas_carregadas", "reconciliado"), "uri", "left")
        .groupBy(MONTH_COLUMN)
        .agg(
            F.min(F.coalesce("reconciliado", F.lit(False))).alias("ok"),
            F.sum("linhas_carregadas").alias("linhas"),
            F.array_distinct(F.flatten(F.array_sort(F.collect_set("colunas")))).alias("colunas"),
        )
        .where("ok")
    )
    return {
        m[MONTH_COLUMN]: snapshots.Month(load if m["linhas"] else None, tuple(m["colunas"]))
        for m in months.collect()
    }
