import pytest
from pyspark.sql import types as T

from tallyloom.sources import files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Sales 2024.csv").write_text("Order ID,Total\n1,2.5\n2,3\n")
    (tmp_path / "sales+2024.CSV").write_text("a,b\n1,x\n")
    (tmp_path / "data_dictionary.csv").write_text("Table,Field\n" * 5000)
    (tmp_path / "big.csv").write_text("a\n" + "12345678\n" * 3000)
    (tmp_path / "logo.png").write_bytes(b"\x89PNG")
    return str(tmp_path)


def found(df):
    return {r.file: (r.kept, r.reason) for r in df.collect()}


def test_discovery_rules(spark, folder):
    got = found(files.discover_files(spark, folder, max_mb=0.01))
    assert list(got) == sorted(got)
    assert got == {
        "Sales 2024.csv": (True, None), "sales+2024.CSV": (True, None),
        "big.csv": (False, "0.0 MB is over the cap of 0.01 MB"),
        "data_dictionary.csv": (False, "name looks non-tabular (matched 'dictionary')")}  # the name rule comes first
    assert found(files.discover_files(spark, folder, max_mb=0.01, include_large=True))["big.csv"] == (True, None)


def test_explicit_list_is_not_filtered(spark, folder):
    got = found(files.discover_files(spark, folder, ["data_dictionary.csv", "big.csv"], max_mb=0.01))
    assert got == {"big.csv": (True, None), "data_dictionary.csv": (True, None)}


def test_two_files_do_not_share_a_table(spark, folder):
    loaded = files.load_csv_folder(spark, files.discover_files(spark, folder, max_mb=0.01))
    assert sorted(loaded) == ["sales_2024", "sales_2024_2"]
    df, n = loaded["sales_2024"]
    assert df.columns == ["order_id", "total"] and n == df.count() == 2
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double"]


def test_preview(spark, folder):
    rows = files.preview(spark, files.discover_files(spark, folder, ["Sales 2024.csv"])).orderBy("position").collect()
    assert {r.reason for r in rows} == {None}
    assert [(r.table_name, r.row_count, r.source_column, r.clean_column) for r in rows] == [
        ("sales_2024", 2, "Order ID", "order_id"), ("sales_2024", 2, "Total", "total")]


def test_what_is_left_out_is_listed(spark, tmp_path):
    (tmp_path / "logo_sales.csv").write_text("a\n1\n")
    (tmp_path / "wide.csv").write_text("a\n" + "12345678\n" * 3_000_000)  # 26 MB
    found = files.discover_files(spark, str(tmp_path))
    assert {r.file: r.reason for r in files.skipped(found).collect()} == {"logo_sales.csv": "name looks non-tabular (matched 'logo')"}
    rows = files.preview(spark, found).collect()
    assert {(r.file, r.row_count, r.reason is None) for r in rows} == {("wide.csv", 3_000_000, True), ("logo_sales.csv", None, False)}
    assert files.discover_files(spark, str(tmp_path), skip_words=()).where("kept").count() == 2


def test_a_stray_quote_mark_needs_no_unsplit_read(spark, tmp_path):
    (tmp_path / "pipes.csv").write_text('id,size\n1,5" pipe\n2,plain\n')
    (tmp_path / "notes.csv").write_text('id,note\n1,"two\nlines"\n')
    facts = files.sniffed(spark, [str(tmp_path / n) for n in ("pipes.csv", "notes.csv")])
    assert [f.multi_line for f in facts.values()] == [False, True]
    loaded = files.load_csv_folder(spark, files.discover_files(spark, str(tmp_path)))
    assert [tuple(r) for r in loaded["pipes"][0].collect()] == [(1, '5" pipe'), (2, "plain")]


def test_names_with_pattern_characters(spark, tmp_path):
    (tmp_path / "Q1 [2024] 100%41 {a}.csv").write_text("a\n1\n2\n")
    df, n = load(spark, tmp_path, b"b\n1\n", table="q1_2024_100_41_a")
    assert n == df.count() == 2


def load(spark, tmp_path, content: bytes, table="t"):
    path = tmp_path / "t.csv"
    path.write_bytes(content)
    found = files.discover_files(spark, str(tmp_path))
    return files.load_csv_folder(spark, found)[table]


def test_encodings(spark, tmp_path):
    df, n = load(spark, tmp_path, "café,naïve\n€5,“x”\n".encode("cp1252"))
    assert df.columns == ["caf", "na_ve"] and n == 1
    assert tuple(df.first()) == ("€5", "“x”")


def test_undefined_cp1252_bytes_fall_back_to_latin1(spark, tmp_path):
    df, _ = load(spark, tmp_path, b"a\nx\x81\xe9\n")
    assert df.first()[0] == "x\x81é"


def test_utf8_with_mark_and_padding(spark, tmp_path):
    df, n = load(spark, tmp_path, "﻿Name,n\nüß,1\n\n\n".encode())
    assert df.columns == ["name", "n"] and n == df.count() == 1 and df.first()[0] == "üß"


def test_quotes_and_line_breaks_inside_values(spark, tmp_path):
    df, n = load(spark, tmp_path, b'zip,weights,ok\n1,"{""72"":98.7,""73"":1}",TRUE\n2,"a\nb",FALSE\n')
    assert n == 2
    assert [tuple(r) for r in df.collect()] == [(1, '{"72":98.7,"73":1}', True), (2, "a\nb", False)]


def test_header_only(spark, tmp_path):
    df, n = load(spark, tmp_path, b"A,B\n")
    assert df.columns == ["a", "b"] and n == df.count() == 0


def test_typed_load(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("id,phone,city,since,active\n1,,,2024-01-02, TRUE \n2,5,x,,no\n")
    schema = T.StructType.fromDDL("id INT, phone STRING, city STRING, since DATE, active BOOLEAN")
    rows = files.read_typed_csv(spark, str(path), schema, {"phone", "since"}).collect()
    assert [(r.id, r.phone, r.city, str(r.since), r.active) for r in rows] == [
        (1, None, "", "2024-01-02", True), (2, "5", "x", "None", False)]
