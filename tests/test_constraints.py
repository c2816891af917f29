from tallyloom.operators.constraints import fk_violations, load_order, pk_violations, snapshot_diff
from tallyloom.sources.writers import load_relational, reconcile

FOREIGN = {"wells": {"field": "fields.code", "rig": "rigs.rig_no"}, "crews": {"base": "ports.port"},
           "shifts": {"crew": "crews.crew_no", "well": "wells.well_no"}}
TABLES = ["shifts", "crews", "wells", "ports", "rigs", "fields"]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (9,), (8,), (None,)], "k INT")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id INT")
    assert tuple(fk_violations(child, "k", parent, "id", "c").first()) == ("c", 2, 4)
    assert tuple(fk_violations(child.where("k < 3"), "k", parent, "id", "c").first()) == ("c", 0, 0)


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None), (2, None)], "a INT, b INT")
    assert tuple(pk_violations(df, ["a", "b"], "t").first()) == ("t", 1, 2, 2)
    assert tuple(pk_violations(df, ["a"], "t").first()) == ("t", 2, 5, 0)


def test_parents_load_first(spark):
    order = load_order(FOREIGN, TABLES)
    for child, links in FOREIGN.items():
        assert all(order.index(ref.split(".")[0]) < order.index(child) for ref in links.values())


def test_relational_load_runs_again(spark):
    """A store that refuses to empty a table whose rows others point at, and rows that point at nothing."""
    held = {}

    def empty(table):
        assert not any(held.get(child) for child, links in FOREIGN.items() for ref in links.values() if ref.startswith(f"{table}."))
        held[table] = 0

    def write(df, table):
        assert all(held[ref.split(".")[0]] for ref in FOREIGN.get(table, {}).values())
        held[table] += df.count()

    for n in (2, 3):
        order = load_relational({t: spark.range(n) for t in TABLES}, FOREIGN, write, empty)
        assert held == dict.fromkeys(TABLES, n) and order == load_order(FOREIGN, TABLES)


def test_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1), (4, None, None)], "id INT, x STRING, y INT")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, None, None), (5, "e", 1)], "id INT, x STRING, y INT")
    assert {tuple(r) for r in snapshot_diff(old, new, ["id"]).collect()} == {
        ("update", 2, "b", None), ("delete", 3, "c", 1), ("insert", 5, "e", 1)}


def test_changes_by_a_microsecond(spark):
    old = spark.sql("SELECT 1 AS id, 1 AS part, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001' AS t, array(1.5D, null) AS a, 'x' AS before")
    new = spark.sql("SELECT 1 AS id, 1 AS part, TIMESTAMP_NTZ'2024-01-01 00:00:00.000002' AS t, array(1.5D, null) AS a, 'x' AS before")
    assert [r.change for r in snapshot_diff(old, new, ["id", "part"]).collect()] == ["update"]
    assert snapshot_diff(old, old, ["id", "part"]).count() == 0


def test_reconciliation(spark):
    got = reconcile({"a": spark.range(3), "b": spark.range(2)}, {"a": 3, "b": 5})
    assert {tuple(r) for r in got.collect()} == {("a", 3, 3, "OK"), ("b", 2, 5, "MISMATCH")}


def test_null_keys_are_keys(spark):
    schema = "id int, part string, v string"
    old = spark.createDataFrame([(None, "a", "x"), (1, None, "y"), (2, "b", "z"), (None, None, "w")], schema)
    new = spark.createDataFrame([(None, "a", "X"), (1, None, "y"), (None, "b", "z")], schema)
    assert {tuple(r) for r in snapshot_diff(old, new, ["id", "part"]).collect()} == {
        ("update", None, "a", "X"), ("delete", 2, "b", "z"), ("delete", None, None, "w"), ("insert", None, "b", "z")}


def test_rows_that_share_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c")], "id int, v string")
    assert sorted(tuple(r) for r in snapshot_diff(old, new, ["id"]).collect()) == [("insert", 2, "c"), ("update", 1, "a")]
