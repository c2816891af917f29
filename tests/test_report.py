import pytest

from tallyloom.operators import report
from tallyloom.operators.profile import with_declared_keys

FIELDS = ("table_name STRING, ordinal INT, column_name STRING, kind STRING, row_count BIGINT, column_count INT,"
          "distinct_count BIGINT, null_pct DOUBLE, min_number DOUBLE, max_number DOUBLE, mean DOUBLE, median DOUBLE, stddev DOUBLE,"
          "min_time STRING, max_time STRING, high_cardinality BOOLEAN, note STRING,"
          "value_counts ARRAY<STRUCT<value: STRING, n: BIGINT>>, is_inferred_primary_key BOOLEAN")


@pytest.fixture
def profile(spark):
    def make(**tables):
        rows = []
        for table, cols in tables.items():
            for i, (name, kind, distinct, *flags) in enumerate(cols):
                category = kind == "categorical"
                many = "high" in flags
                rows.append((table, i, name, kind, 100 if "big" not in flags else 900, len(cols), distinct, 0.0, 1.0, 9.0, 5.25, 5.0,
                             2.0, "2024-01-01", "2024-02-01", many if category else None, "a lot" if many else None,
                             [("a", 3), ("b", 2)] if category and not many else None, "pk" in flags))
        return spark.createDataFrame(rows, FIELDS)

    return make


def charts(p, limit=2):
    return [(r.column_name, r.chart) for r in report.chart_columns(p, limit).orderBy("chart", "place").collect()]


def test_categories_worth_a_chart(profile):
    p = profile(t=[("id", "categorical", 9, "pk"), ("text", "categorical", 90, "high"), ("const", "categorical", 1),
                   ("price", "numerical", 9), ("a", "categorical", 3), ("b", "categorical", 3), ("c", "categorical", 3),
                   ("day", "temporal", 5), ("late", "temporal", 5)])
    assert charts(p) == [("a", "top"), ("b", "top"), ("day", "trend")]
    assert charts(p, 1) == [("a", "top"), ("day", "trend")]
    assert charts(profile(t=[("price", "numerical", 9)])) == []


def test_report_covers_the_first_tables(spark, profile):
    tables = {f"t{i}": [("kind", "categorical", 2), ("day", "temporal", 3)] for i in range(8)}
    frames = {t: spark.sql("SELECT 'a' AS kind, DATE'2024-01-05' AS day UNION ALL SELECT 'b', NULL") for t in tables}
    whole = {r.dataset for r in report.report_datasets(profile(**tables), frames).collect()}
    assert whole == {f"ds_t{i}_{x}" for i in range(8) for x in ("rows", "kind_top", "day_trend")}
    rows = report.report_datasets(profile(**tables), frames, limit=6).collect()
    names = {r.dataset for r in rows}
    assert names == {f"ds_t{i}_{x}" for i in range(6) for x in ("rows", "kind_top", "day_trend")} | {"ds_not_shown"}
    assert [r.n for r in rows if r.dataset == "ds_not_shown"] == [2]
    assert [(r.label, r.n) for r in rows if r.dataset == "ds_t0_kind_top"] == [("a", 3), ("b", 2)]
    assert {(r.label, r.n) for r in rows if r.dataset == "ds_t0_day_trend"} == {("2024-01", 1), (None, 1)}


def asked(p):
    return [r.question for r in report.example_questions(p).orderBy("place").collect()]


def test_questions(profile):
    p = profile(sales=[("row_id", "numerical", 9), ("pk", "numerical", 9, "pk"), ("note", "categorical", 90, "high"),
                       ("mode", "categorical", 3), ("amount", "numerical", 9), ("day", "temporal", 9)])
    assert asked(p) == [
        "What are the top 5 mode values in `sales` by total amount?", "What's the range and average amount in `sales`?",
        "How does the row count in `sales` trend over day?", "How many rows fall into each mode category in `sales`?"]


def test_only_a_date_gives_one_question(profile):
    assert asked(profile(log=[("at", "temporal", 5)])) == ["How does the row count in `log` trend over at?"]


def test_largest_table_first_and_six_at_most(profile):
    cols = [("mode", "categorical", 3), ("amount", "numerical", 9), ("day", "temporal", 9)]
    got = asked(profile(a=cols, z=[(*c, "big") for c in cols]))
    assert len(got) == 6 and all("`z`" in q for q in got[:4]) and all("`a`" in q for q in got[4:])


def test_schema_text(profile):
    p = profile(t=[("mode", "categorical", 3), ("note", "categorical", 90, "high"), ("day", "temporal", 5), ("x", "numerical", 3)])
    assert report.schema_text(p, "shop").first()[0] == (
        "Schema: shop\n\nTable `t` (100 rows):\n  - mode (categorical): e.g. a, b\n  - note (categorical)\n"
        "  - day (temporal): 2024-01-01 to 2024-02-01\n  - x (numerical)")


def test_data_dictionary(profile):
    p = profile(t=[("id", "numerical", 9, "pk"), ("mode", "categorical", 3), ("note", "categorical", 90, "high"), ("day", "temporal", 5)])
    lines = report.data_dictionary(p).first().section.split("\n")
    assert lines[:4] == ["## t", "- Rows: 100  |  Columns: 4", "- Inferred primary key: `id` (heuristic, not a declared constraint)", ""]
    assert lines[6:] == [
        "| id (PK, inferred) | numerical | 0.00% | 9 | min=1.0, max=9.0, mean=5.25, median=5.0, stddev=2.0 |",
        "| mode | categorical | 0.00% | 3 | a (3), b (2) |", "| note | categorical | 0.00% | 90 | a lot |",
        "| day | temporal | 0.00% | 5 | range: 2024-01-01 to 2024-02-01 |"]


def test_data_dictionary_of_declared_keys(spark, profile):
    p = with_declared_keys(profile(orders=[("order_id", "numerical", 9, "pk"), ("customer_id", "numerical", 9)]),
                           {"orders": ["order_id"]}, {"orders": {"customer_id": "customers.customer_id"}})
    lines = report.data_dictionary(p).first().section.split("\n")
    assert lines[2:4] == ["- Primary key: `order_id`", "- Foreign keys: `customer_id` -> `customers.customer_id`"]
    assert [line.split(" | ")[0] for line in lines[-2:]] == ["| order_id (PK)", "| customer_id (FK)"]
