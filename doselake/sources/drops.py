"""Monthly CSV drops: listing, format detection, counts, hashes, rows.

A *drop* is one delivery of one month: a ``name.csv`` file, or a ``name.csv``
folder of part files as Spark writes it. All facts about the files are columns of
a manifest with one row per file.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import clean_names, month_of

# --- fixed values: candidate formats in order of preference, and reading sizes ------
ENCODINGS = ["utf-8-sig", "utf-8", "ISO-8859-1"]
DELIMITERS = [";", ",", "\t"]
HASH_BLOCK = 1024 * 1024
# --------------------------------------------------------------------------------------

HEAD_BYTES = 256 * 1024  # read first; doubled until the header has ended
HEADER_LIMIT = 64 * 1024 * 1024  # a longer header is reported, never cut
_FORMAT_SCHEMA = (
    "uri string, encoding string, delimitador string, "
    "cabecalho array<string>, colunas array<string>, problema string"
)
# What `read_rows` adds to the columns of a file.
BAD_COLUMN = "_corrompida"
BREAKS_COLUMN = "_quebras"
LINE_BREAK = r"\r\n|\r|\n"
EMPTY = "arquivo vazio"
UNKNOWN_FORMAT = "formato desconhecido"
UNNAMED = "mes nao identificado"


class NoDrops(Exception):
    """The given place holds no CSV file."""


# --- listing ---------------------------------------------------------------------------


def _files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(paths)
    )


def _with_empty(found: DataFrame) -> DataFrame:
    """The files, those without bytes included.

    A scan yields no row for a file without bytes; the file index names it.
    """
    spark = found.sparkSession
    files = found.select(
        F.col("_metadata.file_path").alias("uri"),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"),
    )
    # The index spells "file:///x" what a row's metadata spells "file:/x", and names as
    # URIs do, in which a plus sign is no blank.
    names = [(uri.replace(":///", ":/", 1),) for uri in found.inputFiles()]
    indexed = spark.createDataFrame(names, "uri string")
    empty = indexed.join(files, "uri", "left_anti").select(
        "uri",
        F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))).alias("path"),
        F.lit(0).cast("long").alias("bytes"),
        F.lit(None).cast("timestamp").alias("modificado"),
    )
    return files.unionByName(empty)


def drop_name(uri: Column) -> Column:
    """Name of the drop: the ``.csv`` folder a part file lies in, else the file."""
    folder = F.regexp_extract(uri, r"([^/=]+\.csv)/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(file_name(uri))


def file_name(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def _with_identity(found: DataFrame, mes: str | None) -> DataFrame:
    files = _with_empty(found)
    # Names are taken from the path: the URI spells a blank "%20".
    path = F.col("path")
    return files.select(
        "uri",
        "path",
        drop_name(path).alias("remessa"),
        file_name(path).alias("arquivo"),
        (F.lit(mes) if mes else month_of(drop_name(path))).alias("mes_referencia"),
        "bytes",
        "modificado",
    )


def listing(
    spark: SparkSession, source: str | Sequence[str], mes: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Files of a folder (text) or of a list of files, and the listed ones missing.

    An explicit month holds for every file; otherwise the name decides.
    """
    if isinstance(source, str):
        try:
            return _with_identity(_files(spark, f"{source.rstrip('/')}/*.csv"), mes), []
        except AnalysisException as problem:
            raise NoDrops(f"no .csv in {source}") from problem
    try:
        return _with_identity(_files(spark, list(source)), mes), []
    except AnalysisException:
        # Some file is not there: find out which, one listing each.
        missing = [path for path in source if not _exists(spark, path)]
    present = [path for path in source if path not in missing]
    if not present:
        raise NoDrops(f"none of {len(missing)} files exists")
    return _with_identity(_files(spark, present), mes), missing


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        _files(spark, path)
    except AnalysisException:
        return False
    return True


# --- per-file facts that need the bytes ---------------------------------------------------


def _located(path: str) -> str:
    """Object stores go by pyarrow's names for them; dbfs is mounted."""
    scheme, _, rest = path.partition(":")
    if scheme == "dbfs":
        return "file:/dbfs/" + rest.lstrip("/")
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else path


def _open(path: str):
    path = _located(path)
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_stream(
            "/" + path[len("file:"):].lstrip("/"), compression=None
        )
    filesystem, inner = pafs.FileSystem.from_uri(quote(path, safe="/:@?=&"))
    return filesystem.open_input_stream(inner, compression=None)


def _decoded(data: bytes, encoding: str, whole: bool) -> str | None:
    try:
        return codecs.getincrementaldecoder(encoding)().decode(data, whole)
    except UnicodeDecodeError:
        return None


Format = tuple[str | None, str | None, list[str], str | None]


def _judged(data: bytes, whole: bool) -> Format | None:
    """(encoding, delimiter, header, problem); None where the header goes on."""
    texts = ((e, _decoded(data, e, whole)) for e in ENCODINGS)
    encoding, text = next(pair for pair in texts if pair[1] is not None)
    lines = list(io.StringIO(text, newline=""))
    if len(lines) < 2 and not whole:
        return None
    frequency = {d: lines[0].count(d) if lines else 0 for d in DELIMITERS}
    delimiter = max(frequency, key=frequency.get)
    if not frequency[delimiter]:
        return None, None, [], UNKNOWN_FORMAT
    reader = csv.reader(lines, delimiter=delimiter)
    try:
        header = next(reader)
    except csv.Error:  # a field that does not end
        return None, None, [], UNKNOWN_FORMAT
    if reader.line_num == len(lines) and not whole:
        return None
    return encoding, delimiter, header, None


def _format_of(path: str) -> Format:
    with _open(path) as raw:
        data = b""
        while len(data) < HEADER_LIMIT:
            wanted = len(data) or HEAD_BYTES
            block = raw.read(wanted)
            data += block
            if not data:
                return None, None, [], EMPTY
            found = _judged(data, whole=len(block) < wanted)
            if found is not None:
                return found
    return None, None, [], UNKNOWN_FORMAT


def _detect(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for uri, path in zip(batch["uri"], batch["path"]):
            encoding, delimiter, header, problem = _format_of(path)
            rows.append((uri, encoding, delimiter, header, clean_names(header), problem))
        yield pd.DataFrame(
            rows,
            columns=["uri", "encoding", "delimitador", "cabecalho", "colunas", "problema"],
        )


def formats(files: DataFrame) -> DataFrame:
    """Encoding, delimiter and header of every file, read up to the header's end.

    The encoding is that of the head; `manifest` judges it by the whole file.
    """
    return files.select("uri", "path").mapInPandas(_detect, _FORMAT_SCHEMA)


def column_mapping(formats_of_files: DataFrame) -> DataFrame:
    """Distinct (raw, clean) column names over the files."""
    pairs = F.arrays_zip(F.col("cabecalho").alias("original"), F.col("colunas").alias("coluna"))
    return formats_of_files.select(F.inline(pairs)).distinct()


def _digest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["path"]:
            state = hashlib.sha256()
            with _open(path) as raw:
                while block := raw.read(HASH_BLOCK):
                    state.update(block)
            digests.append(state.hexdigest())
        yield pd.DataFrame({"uri": batch["uri"], "arquivo_sha256": digests})


def hashes(files: DataFrame) -> DataFrame:
    """SHA-256 of every file, streamed in blocks inside the tasks.

    One file is one sequential digest; files are spread over tasks by their size.
    """
    return files.select("uri", "path").mapInPandas(_digest, "uri string, arquivo_sha256 string")


def ends_inside(line: Column, delimiter: str) -> Column:
    """Whether a line that starts a record ends inside a quoted field.

    A quote opens a field only where the field starts; after a closing quote all is text
    up to the delimiter. Only ASCII counts, so it holds in every encoding that extends it.
    """
    sep = f"\\x{{{ord(delimiter):x}}}"
    quoted = '[^"]*+(?:""[^"]*+)*+'  # up to the closing quote
    rest = f"[^{sep}]*+"
    fields = f'(?:(?:"{quoted}"{rest}|[^"{sep}]{rest})?+{sep})*+'
    # Most lines hold no quote and need no pattern.
    return F.when(F.contains(line, F.lit('"')), line.rlike(rf'\A{fields}"{quoted}\z')).otherwise(False)


def line_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Physical lines without the header, per file (S6), whether some line ends inside
    quotes (``quebras``: for each delimiter), and whether all are UTF-8.

    The scan is split and combined map-side, so a huge file is counted by many
    tasks. Each line is judged as if it started a record: the first one that ends inside
    quotes does start one, and without such a line every line is a whole record.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("uri"),
            *(ends_inside(F.col("value"), d).alias(f"_open_{k}") for k, d in enumerate(DELIMITERS)),
            F.is_valid_utf8("value").alias("_utf8"),
        )
    )
    opened = [F.max(f"_open_{k}") for k in range(len(DELIMITERS))]
    return lines.groupBy("uri").agg(
        F.greatest(F.count("*") - 1, F.lit(0)).alias("linhas_no_csv"),
        F.map_from_arrays(F.lit(DELIMITERS), F.array(*opened)).alias("quebras"),
        F.min("_utf8").alias("utf8"),
    )


def manifest(spark: SparkSession, files: DataFrame, with_hash: bool = True) -> DataFrame:
    """Everything known about the files without loading them (K4)."""
    return judged(facts(spark, files, with_hash))


def facts(spark: SparkSession, files: DataFrame, with_hash: bool = True) -> DataFrame:
    """What the bytes of the files tell: format, header, counts, digest, problems.

    The scan of lines is given the names of the files, which the driver's file index
    holds anyway; what is found out about them stays in the table.
    """
    names = [r["path"] for r in files.where("bytes > 0").select("path").collect()]
    filled = files.where("bytes > 0")
    table = files.join(formats(filled), "uri", "left")
    if names:
        table = table.join(line_counts(spark, names), "uri", "left")
    else:
        nothing = F.lit(None)
        kinds = {"linhas_no_csv": "long", "quebras": "map<string,boolean>", "utf8": "boolean"}
        table = table.withColumns({c: nothing.cast(kind) for c, kind in kinds.items()})
    # A byte that is no UTF-8 anywhere in the file rules UTF-8 out.
    other = F.col("encoding").startswith("utf-8") & ~F.col("utf8")
    encoding = F.when(other, ENCODINGS[-1]).otherwise(F.col("encoding"))
    table = table.withColumn("encoding", encoding).drop("utf8")
    broken = F.try_element_at("quebras", F.col("delimitador"))
    table = table.withColumn("quebra_em_aspas", broken).drop("quebras")
    if with_hash:
        table = table.join(hashes(filled), "uri", "left")
    return table.withColumns(
        {
            "linhas_no_csv": F.coalesce("linhas_no_csv", F.lit(0)),
            "quebra_em_aspas": F.coalesce("quebra_em_aspas", F.lit(False)),
            "problema": F.when(F.col("bytes") == 0, EMPTY).otherwise(F.col("problema")),
        }
    )


def judged(files: DataFrame) -> DataFrame:
    """The files with ``problema`` also where their name holds no month."""
    unnamed = F.when(F.col("mes_referencia").isNull(), UNNAMED)
    return files.withColumn("problema", F.coalesce("problema", unnamed))


# --- rows ------------------------------------------------------------------------------------


def read_rows(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    encoding: str,
    delimiter: str,
    spanning: bool = False,
) -> DataFrame:
    """Rows of files of one format, every column text, with ``uri``.

    An unquoted empty field is null, a quoted one an empty text. A row that does not fit
    the header has its text in `BAD_COLUMN`, which is null in all others. ``spanning`` is
    for files with line breaks inside quotes: each is then one task, and `BREAKS_COLUMN`
    counts those of a row.
    """
    charset = "ISO-8859-1" if encoding == "ISO-8859-1" else "UTF-8"
    schema = ", ".join(f"`{c}` string" for c in (*columns, BAD_COLUMN))
    rows = (
        spark.read.schema(schema)
        .options(
            header="true",
            sep=delimiter,
            encoding=charset,
            quote='"',
            escape='"',
            multiLine=str(spanning).lower(),
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=BAD_COLUMN,
            nullValue="\\N",
            columnPruning="false",
            recursiveFileLookup="true",
        )
        .csv(list(paths))
    )
    breaks = F.lit(0)
    if spanning:
        each = [F.coalesce(F.regexp_count(F.col(c), F.lit(LINE_BREAK)), F.lit(0)) for c in columns]
        breaks = reduce(Column.__add__, each)
    return rows.select(
        "*", breaks.cast("long").alias(BREAKS_COLUMN), F.col("_metadata.file_path").alias("uri")
    )
