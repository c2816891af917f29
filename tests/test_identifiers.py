import pytest
from pyspark.sql import functions as F

from tallyloom.functions.identifiers import file_stem, id_like, identifier, rename_clean, table_name, unique_identifiers

NAMES = {"\tHarbour ": "harbour", "Berth No": "berth_no", "Draught (m) / max.": "draught_m_max", "7th pier": "c_7th_pier",
         "--": "col", "tide_table": "tide_table", "Fähre €": "f_hre", "": "col", "_x_": "x"}


def test_column_form_and_schema_form_agree(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "raw STRING").select("raw", identifier(F.col("raw")).alias("clean"))
    assert {r.raw: r.clean for r in df.collect()} == NAMES
    assert {n: unique_identifiers([n])[0] for n in NAMES} == NAMES


@pytest.mark.parametrize("raw, clean", [
    (["Tide", "tide#", "(TIDE)"], ["tide", "tide_2", "tide_3"]),
    (["knot", "knot_2", "Knot"], ["knot", "knot_2", "knot_3"]),
    (["x y", "x_y_2", "X/Y", "x..y", "?"], ["x_y", "x_y_2", "x_y_3", "x_y_4", "col"]),
])
def test_repeats_are_numbered(raw, clean):
    assert unique_identifiers(raw) == clean


def test_table_names(spark):
    paths = ["/in/Tide_Tables.csv", "Pilot Book North.csv", "x/y/1851.log.gz", "bare"]
    df = spark.createDataFrame([(p,) for p in paths], "p STRING")
    got = df.select(file_stem(F.col("p")), table_name(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        ("Tide_Tables", "tide_tables"), ("Pilot Book North", "pilot_book_north"),
        ("1851.log", "c_1851_log"), ("bare", "bare")]


def test_id_names(spark):
    names = ["berth_id", "Pilot_ID", "id", "Id", "ROWID", "guid", "tepid", "humid", "orchid", "ide", "idle", "depth"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    assert [r[0] for r in df.where(id_like(F.col("n"))).collect()] == names[:6]


def test_rename_drops_the_rescue_column(spark):
    df = spark.createDataFrame([(1, 2, "x")], ["A b", "A.b", "_rescued_data"])
    assert rename_clean(df).columns == ["a_b", "a_b_2"]
