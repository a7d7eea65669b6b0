"""Versions of a month table: loads stage folders, records decide what readers see.

Below a table, ``linhas/carga=C/mes_referencia=M`` holds the rows that load C staged for
month M. A version is one small file in ``versoes``: the load that wrote it, and the load
that holds each month. It is created in one step and never changed, so a month, the log
rows and the manifest rows of a load become readable together or not at all; a load that
dies leaves folders no version names. Readers resolve the newest version when they are
planned, and go on reading its folders while later versions are written.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, hadoop_path

LOAD_COLUMN = "carga"
_VERSION = "meses array<struct<mes string, carga string, colunas array<string>>>, carga string, versao long"


class CommitConflict(Exception):
    """Another load wrote the same version first; nothing of this one is visible."""


@dataclass(frozen=True)
class Month:
    carga: str | None  # none: the month is there and has no rows
    colunas: tuple[str, ...]


@dataclass(frozen=True)
class Version:
    number: int = 0
    months: dict[str, Month] = field(default_factory=dict)

    def columns(self) -> list[str]:
        """The columns of all months, in the order of the months that brought them."""
        return list(dict.fromkeys(c for _, m in sorted(self.months.items()) for c in m.colunas))


def versions(spark: SparkSession, table: str) -> DataFrame:
    """All complete records; a file that is still being written is not one."""
    try:
        found = spark.read.schema(_VERSION).option("mode", "DROPMALFORMED").json(f"{table}/versoes")
    except AnalysisException:
        found = spark.createDataFrame([], _VERSION)
    return found.where("versao is not null")


def latest(spark: SparkSession, table: str) -> Version:
    """The newest version; one record, with one entry a month."""
    newest = versions(spark, table).orderBy(F.desc("versao")).limit(1).collect()
    if not newest:
        return Version()
    months = {m["mes"]: Month(m["carga"], tuple(m["colunas"])) for m in newest[0]["meses"]}
    return Version(newest[0]["versao"], months)


def commit(spark: SparkSession, table: str, load: str, base: Version, changed: dict[str, Month]) -> Version:
    """Write the version after ``base``, in which the ``changed`` months are those of ``load``."""
    made = Version(base.number + 1, base.months | changed)
    months = [{"mes": k, "carga": m.carga, "colunas": m.colunas} for k, m in sorted(made.months.items())]
    record = json.dumps({"meses": months, "carga": load, "versao": made.number})
    path = hadoop_path(spark, f"{table}/versoes/{made.number:012d}.json")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = files.create(path, False)  # never over an existing file
    except Py4JJavaError as problem:
        if files.exists(path):
            raise CommitConflict(f"version {made.number} of {table} exists") from problem
        raise
    out.write(bytearray(record.encode()))
    out.close()
    return made


def visible(rows: DataFrame, table: str) -> DataFrame:
    """The rows of loads that have a version."""
    known = versions(rows.sparkSession, table).select(LOAD_COLUMN)
    return rows.join(known, LOAD_COLUMN, "left_semi")


def rows_folder(table: str, load: str) -> str:
    return f"{table}/linhas/{LOAD_COLUMN}={load}"


def prune(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Delete staged rows that none of the last ``keep`` versions names; their loads come back.

    For times without a load: the folder of one that is still staging goes too.
    """
    recent = versions(spark, table).orderBy(F.desc("versao")).limit(keep)
    named = {r[0] for r in recent.select(F.explode("meses.carga")).distinct().collect()}
    top = hadoop_path(spark, f"{table}/linhas")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in files.listStatus(top)] if files.exists(top) else []
    gone = [f for name in found if (f := name.partition("=")[2]) and f not in named]
    for load in gone:
        delete_folder(spark, rows_folder(table, load))
    return sorted(gone)
