"""Loading small hand-written CSV files: formats, gates, replacement, log."""

import hashlib

import pytest
from conftest import plan_of

from doselake.functions.names import clean_names, month_of
from doselake.operators import load, snapshots
from doselake.sources import drops


@pytest.fixture
def place(tmp_path):
    class Place:
        csv = tmp_path / "csv"
        table = f"file://{tmp_path}/bronze"
        log = f"file://{tmp_path}/log"

        def put(self, name, text, encoding="utf-8"):
            self.csv.mkdir(exist_ok=True)
            (self.csv / name).write_bytes(text.encode(encoding))
            return f"file://{self.csv / name}"

        def load(self, spark, source=None, **options):
            return load.load(spark, source or f"file://{self.csv}", self.table, self.log, **options)

        def rows(self, spark, *columns):
            stored = load.bronze_table(spark, self.table, columns)
            return sorted(
                (tuple(r) for r in stored.select("mes_referencia", *columns).collect()), key=str
            )

    return Place()


def test_formats_nulls_and_blanks(spark, place):
    place.put("vacinacao_jan_2026.csv", 'Código;Nome\n1;\n2;""\n3;"a;b"\n4;"x""y"\n5;é\n', "ISO-8859-1")
    place.put("vacinacao_fev_2026.csv", "Código,Nome\r\n1,\\\r\n2,é\r\n", "utf-8-sig")
    report = place.load(spark)
    assert report.problems == []
    assert place.rows(spark, "codigo", "nome") == sorted(
        [
            ("2026-01", "1", None),
            ("2026-01", "2", ""),
            ("2026-01", "3", "a;b"),
            ("2026-01", "4", 'x"y'),
            ("2026-01", "5", "é"),
            ("2026-02", "1", "\\"),
            ("2026-02", "2", "é"),
        ],
        key=str,
    )
    log = {r["arquivo"]: r for r in report.log.collect()}
    january = log["vacinacao_jan_2026.csv"]
    raw = (place.csv / "vacinacao_jan_2026.csv").read_bytes()
    assert january["encoding"] == "ISO-8859-1" and january["delimitador"] == ";"
    assert january["arquivo_sha256"] == hashlib.sha256(raw).hexdigest()
    assert january["arquivo_bytes"] == len(raw)
    assert (january["linhas_no_csv"], january["linhas_carregadas"], january["colunas"]) == (5, 5, 2)
    assert str(january["mes_referencia"]) == "2026-01-01" and january["reconciliado"]
    assert log["vacinacao_fev_2026.csv"]["encoding"] == "utf-8-sig"


def test_reload_replaces_only_its_month(spark, place):
    place.put("d_2026_01.csv", "a;b\n1;x\n2;y\n")
    place.put("d_2026_02.csv", "a;b\n3;z\n")
    place.load(spark).raise_for_problems()
    place.load(spark).raise_for_problems()
    assert len(place.rows(spark, "a")) == 3
    (place.csv / "d_2026_01.csv").write_text("a;b\n9;w\n")
    place.load(spark, [f"file://{place.csv}/d_2026_01.csv"]).raise_for_problems()
    assert place.rows(spark, "a") == [("2026-01", "9"), ("2026-02", "3")]
    assert spark.read.parquet(place.log).count() == 5


def test_later_drop_of_a_month_wins_and_both_are_logged(spark, place):
    place.put("a_2026_01.csv", "a;b\n1;x\n2;y\n")
    place.put("b_2026_01.csv", "a;b\n3;z\n")
    report = place.load(spark)
    assert report.problems == []
    assert place.rows(spark, "a") == [("2026-01", "3")]
    assert {r["arquivo"]: r["linhas_carregadas"] for r in report.log.collect()} == {
        "a_2026_01.csv": 2,
        "b_2026_01.csv": 1,
    }


def test_explicit_month_holds_for_every_file(spark, place):
    place.put("a.csv", "a;b\n1;x\n")
    place.put("b_2026_02.csv", "a;b\n2;y\n")
    place.load(spark, mes="2025-12").raise_for_problems()
    assert place.rows(spark, "a") == [("2025-12", "2")]


def test_quoted_line_break(spark, place):
    place.put("d_2026_01.csv", 'a;b\n1;"x\ny"\n2;z\n')
    report = place.load(spark)
    # Physical lines outnumber records: logged and reported, and the month does not appear.
    assert place.rows(spark, "a", "b") == []
    (entry,) = report.log.collect()
    assert (entry["linhas_no_csv"], entry["linhas_carregadas"]) == (3, 2)
    assert not entry["reconciliado"]
    with pytest.raises(load.ReconciliationError):
        report.raise_for_problems()
    assert place.load(spark, gate=load.RECORDS).problems == []
    assert place.rows(spark, "a", "b") == [("2026-01", "1", "x\ny"), ("2026-01", "2", "z")]


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_gate_of_records_counts_breaks_inside_quotes(spark, place, newline):
    lines = ['"a";"b' + newline + 'c"', '1;"x' + newline + newline + 'y"', '2;"p""' + newline + '""q"', "3;z"]
    place.put("d_2026_01.csv", newline.join([*lines, ""]))
    place.put("d_2026_02.csv", newline.join(["a;b", "4;w", ""]))
    report = place.load(spark, gate=load.RECORDS)
    assert report.problems == []
    log = {r["arquivo"]: (r["linhas_no_csv"], r["linhas_carregadas"]) for r in report.log.collect()}
    assert log == {"d_2026_01.csv": (3, 3), "d_2026_02.csv": (1, 1)}
    assert [r[1] for r in place.rows(spark, "a")] == ["1", "2", "3", "4"]


def test_gate_of_records_can_fail(spark, place):
    place.put("d_2026_01.csv", 'a;b\n1;x\n')
    place.load(spark).raise_for_problems()
    # A blank line is a line and no record.
    place.put("d_2026_01.csv", 'a;b\n1;"x\ny"\n\n2;z\n')
    report = place.load(spark, gate=load.RECORDS)
    assert report.problems == ["d_2026_01.csv: 3 linhas, 2 carregadas"]
    assert place.rows(spark, "a", "b") == [("2026-01", "1", "x")]


BAD = [("1", 1, load.SHORT), ("1;2;3", 3, load.LONG), ('"1;2";3;4', 3, load.LONG)]


@pytest.mark.parametrize(("bad", "fields", "reason"), BAD)
@pytest.mark.parametrize("quoted", ["", '0;"p\nq"\n'])
def test_bad_row_fails_its_file_only(spark, place, bad, fields, reason, quoted):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    place.load(spark).raise_for_problems()
    place.put("d_2026_01.csv", f"a;b\n{quoted}7;y\n{bad}\n")
    place.put("d_2026_02.csv", "a;b\n2;z\n")
    report = place.load(spark, gate=load.RECORDS)
    good = 1 + bool(quoted)
    assert report.problems == [f"d_2026_01.csv: {good + 1} linhas, {good} carregadas, 1 em quarentena"]
    assert place.rows(spark, "a", "b") == [("2026-01", "1", "x"), ("2026-02", "2", "z")]
    (row,) = load.quarantine(spark, place.table).collect()
    assert row[load.FILE_COLUMN].endswith("/d_2026_01.csv") and row["mes_referencia"] == "2026-01"
    assert (row["linha"], row["campos"], row["colunas"], row["motivo"]) == (bad, fields, 2, reason)
    log = {r["arquivo"]: r["reconciliado"] for r in report.log.collect()}
    assert log == {"d_2026_01.csv": False, "d_2026_02.csv": True}


def test_part_that_fails_keeps_its_drop_out(spark, place):
    folder = place.csv / "d_2026_03.csv"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("a;b\n1;x\n")
    (folder / "part-1.csv").write_text("a;b\n2\n")
    report = place.load(spark)
    assert len(report.problems) == 1 and place.rows(spark, "a") == []
    (folder / "part-1.csv").write_text("")
    report = place.load(spark)
    assert report.problems == [f"d_2026_03.csv: {drops.EMPTY}"] and place.rows(spark, "a") == []
    (folder / "part-1.csv").write_text("a;b\n2;y\n")
    place.load(spark).raise_for_problems()
    assert place.rows(spark, "a") == [("2026-03", "1"), ("2026-03", "2")]


def test_month_and_log_appear_together(spark, place, monkeypatch):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    place.load(spark).raise_for_problems()
    place.put("d_2026_01.csv", "a;b\n2;y\n")
    before = load.bronze_table(spark, place.table, ["a"])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "commit", dies)
        with pytest.raises(RuntimeError, match="lost"):
            place.load(spark)
    # All was staged, and nothing of it can be read.
    assert place.rows(spark, "a") == [("2026-01", "1")]
    assert load.load_log(spark, place.table, place.log).count() == 1
    assert load.manifest_table(spark, place.table).count() == 1
    place.load(spark, only_new=True).raise_for_problems()
    assert place.rows(spark, "a") == [("2026-01", "2")]
    assert load.load_log(spark, place.table, place.log).count() == 2
    # A reader that was planned earlier still reads its version.
    assert [r["a"] for r in before.select("a").collect()] == ["1"]


def test_second_writer_of_a_version_fails(spark, place):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    base = snapshots.latest(spark, place.table)
    place.load(spark).raise_for_problems()
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit(spark, place.table, "other", base, {})
    (place.csv.parent / "bronze/versoes/000000000002.json").write_text('{"meses": [], "carga"')
    assert snapshots.latest(spark, place.table).number == 1  # a torn record is none


def test_prune_keeps_what_recent_versions_name(spark, place):
    for row in ("1;x", "2;x", "3;x"):
        place.put("d_2026_01.csv", f"a;b\n{row}\n")
        place.load(spark).raise_for_problems()
    place.put("d_2026_02.csv", "a;b\n9;x\n")
    place.load(spark).raise_for_problems()
    assert len(snapshots.prune(spark, place.table, keep=1)) == 3
    assert place.rows(spark, "a") == [("2026-01", "3"), ("2026-02", "9")]
    assert snapshots.prune(spark, place.table, keep=1) == []


def test_known_files_are_not_read_again(spark, place):
    import os

    place.put("d_2026_01.csv", "a;b\n1;x\n")
    place.put("sem_mes.csv", "a;b\n1;x\n")
    place.put("vazio_2026_05.csv", "")
    assert len(place.load(spark, only_new=True).problems) == 2
    # Other bytes of the same size and time: a run that looked at them would fail.
    file = place.csv / "d_2026_01.csv"
    state = file.stat()
    file.write_bytes(b"\xff" * state.st_size)
    os.utime(file, ns=(state.st_atime_ns, state.st_mtime_ns))
    place.put("d_2026_02.csv", "a;b\n2;y\n")
    report = place.load(spark, only_new=True)
    assert report.problems == [] and [r["arquivo"] for r in report.log.collect()] == ["d_2026_02.csv"]
    assert place.rows(spark, "a") == [("2026-01", "1"), ("2026-02", "2")]
    assert load.manifest_table(spark, place.table).count() == 4
    assert place.load(spark, only_new=True).log is None
    # A month given by hand makes a file usable whose name has none.
    report = place.load(spark, [f"file://{place.csv}/sem_mes.csv"], mes="2026-07")
    assert report.problems == [] and place.rows(spark, "a")[-1] == ("2026-07", "1")


def test_unusable_files_are_counted_and_the_rest_loads(spark, place):
    place.put("vazio_2026_01.csv", "")
    place.put("coluna_2026_02.csv", "so_uma\n1\n")
    place.put("sem_mes.csv", "a;b\n1;x\n")
    good = place.put("d_2026_03.csv", "a;b\n1;x\n")
    report = place.load(spark)
    assert len(report.problems) == 3
    assert place.rows(spark, "a") == [("2026-03", "1")]
    missing = place.load(spark, [good, f"file://{place.csv}/nao_ha.csv"])
    assert len(missing.problems) == 1 and "nao encontrado" in missing.problems[0]


def test_empty_folder(spark, place):
    place.csv.mkdir()
    with pytest.raises(drops.NoDrops):
        place.load(spark)


def test_header_only_file(spark, place):
    place.put("d_2026_01.csv", "a;b\n")
    report = place.load(spark)
    assert report.problems == []
    (entry,) = report.log.collect()
    assert (entry["linhas_no_csv"], entry["linhas_carregadas"]) == (0, 0)


def test_drop_without_rows_empties_its_month(spark, place):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    place.put("d_2026_02.csv", "a;b\n2;x\n")
    place.load(spark).raise_for_problems()
    place.put("e_2026_01.csv", "a;b\n")
    place.load(spark).raise_for_problems()
    assert place.rows(spark, "a") == [("2026-02", "2")]
    # Blank lines are no records: the difference is reported and the month stays.
    place.put("e_2026_02.csv", "a;b\n\n\n")
    report = place.load(spark)
    assert len(report.problems) == 1 and place.rows(spark, "a") == [("2026-02", "2")]
    later = place.put("f_2026_02.csv", "a;b\n5;x\n")
    place.load(spark, [later]).raise_for_problems()
    assert place.rows(spark, "a") == [("2026-02", "5")]


def test_rows_get_their_month_where_they_lie(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "uri string, x int")
        kept = spark.createDataFrame([("a", "1996-02"), ("b", "1996-03")], "uri string, mes_referencia string")
        found = load._with_month(rows, kept)
        assert sorted(tuple(r) for r in found.collect()) == [("a", 1, "1996-02"), ("b", 2, "1996-03")]
        assert "hashpartitioning" not in plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drift_is_a_warning(spark, place):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    assert place.load(spark).drift is None
    place.put("d_2026_01.csv", "a;c\n1;y\n")
    report = place.load(spark)
    assert report.problems == []
    assert sorted(tuple(r) for r in report.drift.collect()) == [
        ("b", "falta no csv", 1),
        ("c", "falta na tabela", 1),
    ]
    assert place.rows(spark, "a", "b", "c") == [("2026-01", "1", None, "y")]


def test_drift_counts_drops(spark):
    headers = spark.createDataFrame(
        [("x", ["a", "b"]), ("x", ["a", "b"]), ("y", ["a", "c"]), ("z", ["a"])],
        "remessa string, colunas array<string>",
    )
    assert sorted(tuple(r) for r in load.schema_drift(headers, ["a", "b", "d"]).collect()) == [
        ("b", "falta no csv", 2),
        ("c", "falta na tabela", 1),
        ("d", "falta no csv", 3),
    ]


def test_dry_run_writes_nothing(spark, place, tmp_path):
    place.put("d_2026_01.csv", "a;b\n1;x\n")
    (found,) = load.inspect(spark, f"file://{place.csv}").collect()
    assert found["colunas"] == ["a", "b"] and found["linhas_no_csv"] == 1
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv"]


def test_part_files_are_one_drop(spark, place):
    folder = place.csv / "vacinacao_mar_2026.csv"
    folder.mkdir(parents=True)
    for i in (0, 1):
        (folder / f"part-{i}-202401.csv").write_text(f"a;b\n{i};x\n")
    report = place.load(spark)
    assert report.problems == []
    assert place.rows(spark, "a") == [("2026-03", "0"), ("2026-03", "1")]
    assert report.log.count() == 2


def test_quotes_beside_accents(spark, place):
    # In ISO-8859-1 an accented byte before a quote must not hide the quote.
    place.put("d_2026_01.csv", 'ção;b\n1;"xÃ"\n2;"é\né"\n', "ISO-8859-1")
    listed, _ = drops.listing(spark, f"file://{place.csv}")
    (found,) = drops.manifest(spark, listed, with_hash=False).collect()
    assert found["quebra_em_aspas"] and found["linhas_no_csv"] == 3
    place.load(spark, gate=load.RECORDS).raise_for_problems()
    assert place.rows(spark, "cao", "b") == [("2026-01", "1", "xÃ"), ("2026-01", "2", "é\né")]


@pytest.mark.parametrize(
    "names, cleaned",
    [
        (["Código", "Nome da Mãe"], ["codigo", "nome_da_mae"]),
        (["a", "a", "A", "a_2"], ["a", "a_2", "a_3", "a_2_2"]),
        (["1dose", "", "!!"], ["c_1dose", "coluna", "coluna_2"]),
        (["__x__y--z__"], ["x_y_z"]),
    ],
)
def test_clean_names(names, cleaned):
    assert clean_names(names) == cleaned


@pytest.mark.parametrize(
    "name, month",
    [
        ("pni_2026_08.csv", "2026-08"),
        ("pni_202608.csv", "2026-08"),
        ("pni-2026.08.csv", "2026-08"),
        ("08-2026.csv", "2026-08"),
        ("082026.csv", None),
        ("vacinacao_fev_2026.csv", "2026-02"),
        ("FEV2026.CSV", "2026-02"),
        ("2026dez.csv", "2026-12"),
        ("2026_13.csv", None),
        ("vacinacao.csv", None),
        ("1998_02.csv", None),
        # A numeric spelling wins over a name, and year-month over month-year.
        ("jan_2025_2026_08.csv", "2026-08"),
        ("03-2025-2026-08.csv", "2026-08"),
        # The last extension is not part of the name that is searched.
        ("x_2026.08", None),
    ],
)
def test_month_of(spark, name, month):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(name,)], "n string").select(month_of(F.col("n")))
    assert df.first()[0] == month


def test_head_cut_inside_a_character(spark, place):
    # A wide character right where the examined head ends must not hide UTF-8.
    place.put("d_2026_01.csv", "é;b\n" + "é" * 200_000 + ";x\n")
    listed, _ = drops.listing(spark, f"file://{place.csv}")
    (found,) = drops.formats(listed).collect()
    assert found["encoding"] == "utf-8-sig" and found["colunas"] == ["e", "b"]


def test_late_accent_decides_the_encoding(spark, place):
    text = "a;b\n" + "1;x\n" * 100_000 + "2;São\n"
    place.put("d_2026_01.csv", text, "ISO-8859-1")
    place.put("d_2026_02.csv", text, "utf-8")
    place.load(spark).raise_for_problems()
    stored = [r for r in place.rows(spark, "a", "b") if r[1] == "2"]
    assert stored == [("2026-01", "2", "São"), ("2026-02", "2", "São")]
    log = {r["arquivo"]: r["encoding"] for r in spark.read.parquet(place.log).collect()}
    assert log == {"d_2026_01.csv": "ISO-8859-1", "d_2026_02.csv": "utf-8-sig"}


@pytest.mark.parametrize("size", [9_000, 90_000])
def test_long_header_is_read_to_its_end(spark, place, size):
    names = [letter * size for letter in "abcdefghij"]
    place.put("d_2026_01.csv", ";".join(names) + "\n" + ";".join("0123456789") + "\n")
    listed, _ = drops.listing(spark, f"file://{place.csv}")
    (found,) = drops.formats(listed).collect()
    assert found["cabecalho"] == names


def test_header_that_never_ends_is_reported(spark, place):
    place.put("d_2026_01.csv", 'a;"b\n' + "1;x\n" * 200_000)
    assert place.load(spark).problems == [f"d_2026_01.csv: {drops.UNKNOWN_FORMAT}"]


def test_names_are_those_of_the_files(spark, place):
    place.put("lote 2608.csv", "a;b\n1;x\n")
    place.put("vacinação 2026_08.csv", "a;b\n2;y\n")
    place.put("a+b 2026_09.csv", "")
    report = place.load(spark)
    assert sorted(report.problems) == [
        f"a+b 2026_09.csv: {drops.EMPTY}", "lote 2608.csv: mes nao identificado",
    ]
    assert place.rows(spark, "a") == [("2026-08", "2")]
    (entry,) = report.log.collect()
    assert entry["arquivo"] == "vacinação 2026_08.csv"


def test_stores_go_by_other_names():
    assert drops._located("s3a://lake/x.csv") == "s3://lake/x.csv"
    assert drops._located("dbfs:/lake/x.csv") == "file:/dbfs/lake/x.csv"
    assert drops._located("hdfs://n/x.csv") == "hdfs://n/x.csv"


STRAY = ['5" cano', 'a""b', 'x"', ' "y', '"a"b', '"a" "b', '"a""b" c"', '""', "", "1", '"p\nq"', '"p""\n"";q\n"', '"\n"']


@pytest.mark.parametrize("delimiter", [";", ",", "\t"])
def test_files_without_breaks_read_the_same_either_way(spark, place, delimiter):
    import random

    rng = random.Random(delimiter)
    # Text after a closing quote at a line's end is the reader's to settle, by its mode.
    cells = [c.replace(";", delimiter) for c in STRAY if "\n" not in c and c != '"a""b" c"']
    body = [delimiter.join([str(i), rng.choice(cells), rng.choice(cells)]) for i in range(300)]
    path = place.put("d.csv", "\n".join([delimiter.join("ipr"), *body, ""]))
    counted = drops.line_counts(spark, [path]).first()
    assert not counted["quebras"][delimiter] and counted["linhas_no_csv"] == 300
    by_line, by_file = (
        sorted((tuple(r) for r in drops.read_rows(spark, [path], list("ipr"), "utf-8", delimiter, s).collect()), key=str)
        for s in (False, True)
    )
    assert by_line == by_file and len(by_line) == 300


def test_stray_quotes_load(spark, place):
    place.put("d_2026_01.csv", 'a;b\n1;5" cano\n2;"x\ny"\n3;z\n')
    place.put("d_2026_02.csv", 'a;b\n4" ;"x\ny" "\n5;z\n')  # an even number of quotes in each line
    place.load(spark, gate=load.RECORDS).raise_for_problems()
    assert place.rows(spark, "a", "b") == [
        ("2026-01", "1", '5" cano'), ("2026-01", "2", "x\ny"), ("2026-01", "3", "z"),
        ("2026-02", '4" ', '"x\ny" "'), ("2026-02", "5", "z"),
    ]


def test_equal_names_in_two_folders_are_two_drops(spark, place, tmp_path):
    for folder, row in (("a", "1;x"), ("b", "2;y")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "d_2026_01.csv").write_text(f"a;b\n{row}\n")
    found = [f"file://{tmp_path}/{folder}/d_2026_01.csv" for folder in ("b", "a")]
    report = place.load(spark, found)
    assert report.problems == []
    assert place.rows(spark, "a") == [("2026-01", "2")]
    assert report.log.count() == 2
