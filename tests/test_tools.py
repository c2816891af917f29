import datetime as dt

import pytest

from tallyloom.operators import tools


@pytest.fixture
def tables(spark):
    sales = spark.createDataFrame(
        [("a", 1, 2.5, dt.date(2024, 1, 1)), ("a", 3, None, dt.date(2024, 1, 2)), ("b", 9, 1.0, None), (None, 2, None, None), ("10", 7, 0.5, None)],
        "name STRING, qty BIGINT, price DOUBLE, day DATE")
    return {"sales": sales, "empty": spark.createDataFrame([], "x INT, _rescued_data STRING")}


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_tables_and_columns(tables):
    assert pairs(tools.list_tables(tables)) == [("empty", 1), ("sales", 4)]
    assert pairs(tools.list_columns(tables))[1] == ("sales", 0, "name", "string")


def test_top_n(tables):
    assert pairs(tools.top_n_group_by(tables, "sales", "name", "qty", 2)) == [("b", 9), ("10", 7)]
    by_price = pairs(tools.top_n_group_by(tables, "sales", "name", "price", 99, "max"))
    assert by_price == [("a", 2.5), ("b", 1.0), ("10", 0.5), (None, None)]
    assert len(pairs(tools.top_n_group_by(tables, "sales", "name", "qty", -3, "count"))) == 1


def test_threshold_follows_the_column_type(tables):
    def names(column, op, value):
        return [r.name for r in tools.filter_by_threshold(tables, "sales", column, op, value, order_by=["qty"]).collect()]

    assert names("qty", "<=", "2") == ["a", None] and names("qty", "!=", 9.0) == ["a", None, "a", "10"]
    assert names("name", "=", "10") == ["10"] and names("name", "=", "o'x") == []
    assert names("day", ">", "2024-01-01") == ["a"] and names("price", ">", "nan") == []
    assert tools.filter_by_threshold(tables, "sales", "qty", ">", 0, 0).count() == 1


@pytest.mark.parametrize("call, message", [
    (lambda t: tools.top_n_group_by(t, "nope", "a", "b"), "Unknown table 'nope'. Valid: empty, sales"),
    (lambda t: tools.top_n_group_by(t, "sales", "x", "qty"), "Unknown column 'x'"),
    (lambda t: tools.top_n_group_by(t, "sales", "name", "qty", agg="median"), "Unknown aggregate 'median'"),
    (lambda t: tools.filter_by_threshold(t, "sales", "qty", "like", 1), "Unknown operator 'like'"),
    (lambda t: tools.filter_by_threshold(t, "sales", "qty", "=", "many"), "'many' is not a number"),
])
def test_wrong_names_are_refused(tables, call, message):
    with pytest.raises(ValueError, match=message.replace(".", r"\.").replace("(", r"\(")):
        call(tables)


@pytest.mark.parametrize("query", [
    "INSERT INTO t VALUES (1)", "DROP TABLE t", "SET a=b", "EXPLAIN SELECT 1", "SELECT 1; SELECT 2", "SELECT 1; DROP TABLE t",
    "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "SELECT java_method('java.lang.System', 'exit', 1)",
    "SELECT reflect('java.lang.System', 'getenv')", "SELECT `reflect`('java.lang.System', 'getenv') FROM t", "SELECT * FROM text.`/etc/hostname`",
    "SELECT a FROM t WHERE a IN (SELECT 1 FROM csv.`/etc/passwd`)", "WITH x AS (SELECT * FROM u) SELECT * FROM x", "SELECT (SELECT MAX(a) FROM u)", "SELECT TRANSFORM(a) USING 'cat' AS b FROM (SELECT 1 AS a)", "SELECT * FROM no_such_table",
    "SELECT * FROM IDENTIFIER('u')", "WITH x AS (WITH u AS (SELECT 1 AS a) SELECT * FROM u) SELECT * FROM u", "SELECT (WITH u AS (SELECT 1 AS a) SELECT MAX(a) FROM u) FROM u",
    "SELECT * FROM t JOIN u ON t.a < u.a", "SELECT * FROM t WHERE EXISTS (SELECT 1 FROM t WHERE a IN (SELECT a FROM u))", "SELECT * FROM (TABLE u)",
])
def test_commands_are_refused(spark, query):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW t AS SELECT 1 AS a")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW u AS SELECT 2 AS a")
    with pytest.raises(ValueError):
        tools.run_readonly_sql(spark, query, ["t"])
    assert spark.table("t").count() == 1


def test_queries_run(spark):
    assert pairs(tools.run_readonly_sql(spark, " select 'update' AS a, 'reflect' AS b ; ", [])) == [("update", "reflect")]
    assert tools.run_readonly_sql(spark, "WITH r AS (SELECT id FROM range(500)) SELECT * FROM r ORDER BY id DESC", []).collect()[0][0] == 499
    assert tools.run_readonly_sql(spark, "SELECT id FROM range(500) -- all", []).count() == 500
    assert tools.run_readonly_sql(spark, "SELECT id FROM range(500) -- some", [], limit=100).count() == 100
    spark.range(3).createOrReplaceTempView("some_rows")
    assert tools.run_readonly_sql(spark, "SELECT * FROM Some_Rows WHERE id > (SELECT MIN(id) FROM some_rows)", ["some_rows"]).count() == 2


def test_names_of_the_query_may_hide_tables(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW t AS SELECT id AS a FROM range(3) WHERE id > 0")
    spark.range(9).createOrReplaceTempView("u")
    assert tools.run_readonly_sql(spark, "WITH u AS (SELECT * FROM t) SELECT u.a FROM u JOIN t ON t.a = u.a", ["t"]).count() == 2
    assert tools.run_readonly_sql(spark, "SELECT a FROM t UNION ALL SELECT id FROM u WHERE id IN (SELECT a FROM t)", ["t", "u"]).count() == 4


def test_text_form(spark, tables):
    assert tools.as_text(tools.top_n_group_by, tables, "sales", "name", "qty", 1) == "{'group_value': 'b', 'metric_value': 9}"
    assert tools.as_text(tools.filter_by_threshold, tables, "empty", "x", "=", 1) == "(no rows)"
    assert tools.as_text(tools.run_readonly_sql, spark, "DROP TABLE t", []).startswith("Rejected")
    assert "divide" in tools.as_text(tools.run_readonly_sql, spark, "SELECT id / 0 FROM range(2)", []).lower()
    lines = tools.as_text(tools.run_readonly_sql, spark, "SELECT id FROM range(9)", [], shown=4).split("\n")
    assert len(lines) == 5 and "more than 4 rows" in lines[-1]
