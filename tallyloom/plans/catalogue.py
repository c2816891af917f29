"""The library's operators run over the given tables: one function per registered query.

Each takes (spark, folder of parquet tables) and returns a DataFrame. What the dataset
steps share (chunks, their vectors, the profile) is written once per session and folder to
the shared folder and read from there, as it would be in use.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyloom.functions import identifiers, models, text as text_functions
from tallyloom.functions.vectors import comparable
from tallyloom.operators import chunks, codes, constraints, context, keywords, profile, projection, report, rerank, retrieval, sketches, tools
from tallyloom.operators.joins import sent_if_few
from tallyloom.plans import onboarding, retail
from tallyloom.session import materialize, shared_dir, spread, stamp
from tallyloom.sources import catalog, files, paged_text, pages, writers
from tallyloom.streaming import sync

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"], "lineitem": ["l_orderkey", "l_linenumber"],
}
FOREIGN_KEYS = {
    "nation": {"n_regionkey": "region.r_regionkey"},
    "customer": {"c_nationkey": "nation.n_nationkey"},
    "supplier": {"s_nationkey": "nation.n_nationkey"},
    "orders": {"o_custkey": "customer.c_custkey"},
    "lineitem": {"l_orderkey": "orders.o_orderkey", "l_partkey": "part.p_partkey", "l_suppkey": "supplier.s_suppkey"},
    "labels": {"doc_id": "documents.doc_id"},
}

# Arguments of the queries that take one.
CUSTOMER = 7
QUERY_VECTOR = 7
MIN_SCORE = 0.4
CLUSTERS = 5
EXAMPLES = 40
QUALITY_AT, CANDIDATES = 10, 40
PAGE_RANGE = 1 << 20

_staged: dict[tuple, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_all(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {t: read(spark, sf_dir, t) for t in names or TABLES}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> DataFrame:
    """What ``write`` puts into a folder, on first use and again once a table has changed."""
    key = (spark.sparkContext.applicationId, sf_dir, name, *(stamp(spark, f"{sf_dir}/{t}.parquet") for t in TABLES))
    if key not in _staged:
        path = shared_dir(spark, name)
        write(path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *partition_by: str) -> DataFrame:
    """A result that several queries read."""
    return stored(spark, sf_dir, name, lambda path: build().write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path))


# Retail ------------------------------------------------------------------------------

def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("order_item_id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("category_id"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_brand").alias("category_id")).distinct().select(
        "category_id", F.col("category_id").alias("category_name"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"))


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products per supplier: on hand is the part's size, and the reorder level is the
    average line ordered from that supplier, rounded up. Promotional parts are discontinued."""
    ordered = items(spark, sf_dir).groupBy("product_id", "supplier_id").agg(
        F.ceil(F.avg("quantity")).cast("int").alias("reorder_level"))
    part = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("category_id"),
        F.col("p_size").alias("quantity_on_hand"), (F.col("p_type") == "PROMO").alias("discontinued"))
    return ordered.join(part, "product_id")


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def top_selling_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = retail.top_selling_products(items(spark, sf_dir), products(spark, sf_dir), categories(spark, sf_dir))
    return _money(top, "revenue")


def customer_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = retail.customer_order_history(orders(spark, sf_dir), items(spark, sf_dir), CUSTOMER)
    return _money(history, "order_total").withColumn("order_date", F.col("order_date").cast("string"))


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(retail.monthly_revenue(orders(spark, sf_dir), items(spark, sf_dir)), "revenue")


def low_stock_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.low_stock_products(stock(spark, sf_dir), suppliers(spark, sf_dir))


def restock_urgency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.restock_urgency(stock(spark, sf_dir))


def restock_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by the nearest of some labelled rows: the first of each label by their text, as the
    rule labels them."""
    rows = retail.restock_text(stock(spark, sf_dir))
    label = retail.urgency(F.col("quantity_on_hand"), F.col("reorder_level"))
    first = Window.partitionBy("label").orderBy("text")
    examples = (rows.select("text", label.alias("label")).distinct().withColumn("place", F.row_number().over(first))
                .where(F.col("place") <= EXAMPLES).orderBy("label", "place").collect())
    return rows.withColumn("restock_urgency", models.classify(F.col("text"), [(r.text, r.label) for r in examples]))


def _sql_function(call: str, *money: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stocked = stock(spark, sf_dir)
        if not call.startswith("low_stock"):  # one row per product where stock plays no part
            sold = products(spark, sf_dir)
            stocked = sold.select("*", *[
                F.lit(None).cast(f.dataType).alias(f.name) for f in stocked.schema if f.name not in sold.columns])
        retail.register_sql_functions(spark, {
            "order_items": items(spark, sf_dir), "orders": orders(spark, sf_dir), "products": stocked,
            "categories": categories(spark, sf_dir), "suppliers": suppliers(spark, sf_dir)})
        rows = spark.sql(f"SELECT * FROM {call}")
        if "order_date" in rows.columns:
            rows = rows.withColumn("order_date", F.col("order_date").cast("string"))
        return _money(rows, *money)

    return run


# Generic tools -----------------------------------------------------------------------

def _top_n(agg: str, metric: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = {"orders": read(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))}
        top = tools.top_n_group_by(tables, "orders", "o_orderpriority", metric, n=5, agg=agg)
        return top.withColumn("metric_value", F.round(F.col("metric_value").cast("double"), 2))

    return run


def filter_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_all(spark, sf_dir, "lineitem")
    hits = tools.filter_by_threshold(
        tables, "lineitem", "l_extendedprice", ">=", "100000", limit=100, order_by=tables["lineitem"].columns)
    return hits.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


READONLY_QUERY = """
    WITH spent AS (
      SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey)
    SELECT c_mktsegment, COUNT(*) AS buyers, CAST(SUM(total) AS DOUBLE) AS spent
    FROM spent JOIN customer ON c_custkey = o_custkey
    WHERE c_mktsegment <> 'update'
    GROUP BY c_mktsegment ORDER BY c_mktsegment;
"""


def readonly_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name, df in read_all(spark, sf_dir, "orders", "customer").items():
        df.createOrReplaceTempView(name)
    return tools.run_readonly_sql(spark, READONLY_QUERY, ["orders", "customer"], limit=100)


# What the gate must refuse, and what it must not, over the tables orders and customer.
GATE_CASES = (
    ("file", "SELECT * FROM text.`/etc/hostname`"), ("hidden_file", "SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM csv.`/etc/passwd`)"),
    ("other_table", "WITH x AS (SELECT * FROM secret) SELECT * FROM x"), ("command", "DROP VIEW orders"), ("second_command", "SELECT 1) ; DROP VIEW orders; --"),
    ("code", "SELECT reflect('java.util.UUID', 'randomUUID') FROM orders"), ("script", "SELECT TRANSFORM(o_orderkey) USING 'cat' FROM orders"),
    ("literal", "SELECT COUNT(*) AS n FROM orders WHERE o_orderpriority <> 'reflect' AND o_orderstatus <> 'text.`/etc/hostname`'"),
    ("computed_name", "SELECT COUNT(*) AS n FROM IDENTIFIER('secret')"),
    ("inner_name", "WITH x AS (WITH secret AS (SELECT 1 AS a) SELECT * FROM secret) SELECT COUNT(*) AS n FROM secret"),
    ("name_in_subquery", "SELECT COUNT(*) AS n FROM secret WHERE (WITH secret AS (SELECT 1 AS a) SELECT MAX(a) FROM secret) = 1"),
    ("own_name", "WITH x AS (SELECT * FROM customer) SELECT COUNT(*) AS n FROM x"),
    ("shadowed_name", "WITH secret AS (SELECT * FROM orders) SELECT COUNT(*) AS n FROM secret"),
)


GATE_ACCEPTS = ("literal", "own_name", "shadowed_name")


def readonly_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each case of the gate: null where it is refused, else the count it returns."""
    allowed = read_all(spark, sf_dir, "orders", "customer")
    for name, df in allowed.items():
        df.createOrReplaceTempView(name)
    read(spark, sf_dir, "nation").createOrReplaceTempView("secret")
    parts = []
    for name, query in GATE_CASES:
        case = F.lit(name).alias("case_name")
        try:
            parts.append(tools.run_readonly_sql(spark, query, list(allowed)).select(case, F.col("n")))
        except ValueError:
            parts.append(spark.range(1).select(case, F.lit(None).cast("bigint").alias("n")))
    return reduce(DataFrame.unionAll, parts)


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.list_tables(read_all(spark, sf_dir), counted=True)


# Profile and report ------------------------------------------------------------------

def stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "profile", lambda: profile.profile_tables(read_all(spark, sf_dir), columnar=True))


def flat(profiled: DataFrame) -> DataFrame:
    """The profile with its value counts as text."""
    values = F.array_join(F.transform("value_counts", lambda v: F.concat(
        v["value"], F.lit(" ("), v["n"].cast("string"), F.lit(")"))), ", ")
    return profiled.withColumn("value_counts", values).drop("is_inferred_primary_key")


def _profile(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat(profile.profile_table(read(spark, sf_dir, table), table, columnar=True))


def profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the estimated profile reports exactly, and whether its estimates are close: distinct
    counts within 15%, medians with a hundredth of the rows between them and the middle."""
    rows = read(spark, sf_dir, "lineitem")
    exact = stored_profile(spark, sf_dir).where("table_name = 'lineitem'").select("ordinal", F.col("distinct_count").alias("differ"))
    found = profile.profile_table(rows, "lineitem", exact=False)
    medians = {r.column_name: r.median for r in found.collect() if r.median is not None}  # a row per column
    below = {c: F.avg((F.col(c) < m).cast("int")) <= 0.51 for c, m in medians.items()}
    reached = {c: F.avg((F.col(c) <= m).cast("int")) >= 0.49 for c, m in medians.items()}
    near = rows.agg(*((below[c] & reached[c]).alias(c) for c in medians)).unpivot([], list(medians), "column_name", "median_close")
    return found.join(exact, "ordinal").join(near, "column_name", "left").select(
        "column_name", "row_count", "null_count", "min_number", "max_number", "mean", "stddev", "min_time", "max_time",
        (F.abs(F.col("distinct_count") - F.col("differ")) <= 0.15 * F.col("differ")).alias("distinct_close"), F.coalesce("median_close", F.lit(True)).alias("median_close"))


def profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the merged profile of a growing table reports exactly: lineitem, arriving in three parts."""
    rows, key = read(spark, sf_dir, "lineitem"), F.pmod("l_orderkey", F.lit(3))
    folder, states = shared_dir(spark, "growing"), shared_dir(spark, "states")
    for part in range(3):
        rows.where(key == part).write.mode("append").parquet(folder)
        sketches.update_states(spark, folder, states)
    return flat(sketches.merged_profile(spark, folder, states)).drop("ordinal", "data_type", "distinct_count", "median")


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(catalog.table_profile(stored_profile(spark, sf_dir), "orders"))


def inferred_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.inferred_keys(stored_profile(spark, sf_dir))


def declared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = profile.with_declared_keys(stored_profile(spark, sf_dir), PRIMARY_KEYS, FOREIGN_KEYS)
    return keyed.select("table_name", "column_name", "distinct_count", "is_primary_key", "is_foreign_key", "references")


def top_values_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_profile(spark, sf_dir).select(
        "table_name", "column_name", F.posexplode("value_counts").alias("at", "v")).select(
        "table_name", "column_name", (F.col("at") + 1).alias("place"), "v.value", "v.n")


def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.distinct_values(read(spark, sf_dir, "embeddings"), "label")


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.value_counts(read(spark, sf_dir, "lineitem"), "l_quantity")


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        report.monthly_trend(read(spark, sf_dir, table), column).select(F.lit(table).alias("table_name"), "period", "n")
        for table, column in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def chart_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.chart_columns(stored_profile(spark, sf_dir))


def report_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_datasets(stored_profile(spark, sf_dir), read_all(spark, sf_dir))


def question_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.question_columns(stored_profile(spark, sf_dir))


def example_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.example_questions(stored_profile(spark, sf_dir))


def schema_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.schema_text(stored_profile(spark, sf_dir), "testdata")


def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.data_dictionary(stored_profile(spark, sf_dir))


# Keys, names and files ---------------------------------------------------------------

def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared keys, and orders against the customers in credit only."""
    tables = read_all(spark, sf_dir)
    checks = [
        (table, column, *reference.split("."))
        for table, links in sorted(FOREIGN_KEYS.items()) for column, reference in links.items()]
    found = [constraints.fk_violations(tables[t], c, tables[p], pk, f"{t}.{c}") for t, c, p, pk in checks]
    in_credit = tables["customer"].where(F.col("c_acctbal") > 0)
    found.append(constraints.fk_violations(tables["orders"], "o_custkey", in_credit, "c_custkey", "orders.o_custkey in credit"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_all(spark, sf_dir)
    found = [constraints.pk_violations(tables[t], key, t) for t, key in sorted(PRIMARY_KEYS.items())]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as they stood at the start of 2001, against those kept since 1996 with open
    ones since closed. One order on each side has lost its key: the last before 1996 and the last
    of all since 2001."""
    table, date = read(spark, sf_dir, "orders"), F.col("o_orderdate")
    before, since = (F.max(F.when(c, F.col("o_orderkey"))) for c in (date < F.lit("1996-01-01").cast("timestamp_ntz"), date >= F.lit("2001-01-01").cast("timestamp_ntz")))
    lost = [k for k in table.agg(before, since).first() if k is not None]
    table = table.withColumn("o_orderkey", F.when(~F.col("o_orderkey").isin(lost), F.col("o_orderkey")))
    old = table.where(date < F.lit("2001-01-01").cast("timestamp_ntz"))
    new = table.where(date >= F.lit("1996-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus")))
    return constraints.snapshot_diff(old, new, ["o_orderkey"]).withColumn("o_orderdate", date.cast("string"))


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "part").select(F.col("p_brand").alias("raw")).union(
        read(spark, sf_dir, "part").select("p_name")).union(read(spark, sf_dir, "pages").select("url")).distinct()
    return names.select(
        "raw", identifiers.identifier(F.col("raw")).alias("identifier"), identifiers.table_name(F.col("raw")).alias("table_name"),
        identifiers.id_like(identifiers.identifier(F.col("raw"))).alias("id_like"))


def _exported(spark: SparkSession, sf_dir: str, table: str, plain: bool = False) -> str:
    """A table as a folder of CSV files, with headers to be cleaned unless plain."""
    key = (spark.sparkContext.applicationId, sf_dir, f"csv {table} {plain}")
    if key not in _staged:
        path = shared_dir(spark, "csv")
        df = read(spark, sf_dir, table)
        names = df.columns if plain else [f" {c.replace('_', ' ').title()}! " for c in df.columns]
        df.toDF(*names).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(
            path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        _staged[key] = path
    return _staged[key]


def csv_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as CSV and read back under cleaned names, with inferred types."""
    path = _exported(spark, sf_dir, "events")
    df = identifiers.rename_clean(files.read_csv(spark, path))
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz").cast("string"))


def row_count_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written as CSV and loaded again, against the rows counted in the raw files."""
    loaded, source = {}, {}
    for table in ("customer", "orders", "lineitem", "events", "conversations"):
        path = _exported(spark, sf_dir, table)
        facts = files.sniff_folder(spark, path)
        loaded[table] = identifiers.rename_clean(files.read_csv(spark, path, facts.encoding, facts.multi_line))
        source[table] = files.count_csv_rows(spark, path, facts)
    return writers.reconcile(loaded, source)


def csv_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of the exported conversations would do, over all their files."""
    found = files.discover_files(spark, _exported(spark, sf_dir, "conversations"))
    return files.preview(spark, found).groupBy("position", "source_column", "clean_column").agg(
        F.sum("row_count").alias("row_count"))


def _exported_files(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> str:
    """A folder with one CSV file per table, under the given names."""
    folder = shared_dir(spark, "files")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(folder))
    for name, table in names.items():
        parts = shared_dir(spark, "part")
        read(spark, sf_dir, table).coalesce(1).write.csv(parts, header=True, quote='"', escape='"')
        written = [f.getPath() for f in system.listStatus(path(parts)) if f.getPath().getName().startswith("part-")]
        system.rename(written[0], path(folder, name))
    return folder


# Files of a folder to onboard; only the name of the last one is no table's.
ONBOARDED = {"Customer List.csv": "customer", "nation.csv": "nation", "logo_region.csv": "region"}


def csv_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is kept of a folder under a cap of a kilobyte, and why the rest is not. Sizes are masked."""
    found = files.discover_files(spark, _exported_files(spark, sf_dir, ONBOARDED), max_mb=0.001)
    return found.select("file", "kept", F.regexp_replace("reason", "[0-9.]+", "#").alias("reason"))


def document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.list_documents(spark, _exported_files(spark, sf_dir, ONBOARDED), ".csv").select(F.col("source_file").alias("file"), F.length("content") > 0).toDF("file", "has_content")


def paged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to files as pages, several to a file, and read back in ranges of bytes: how often each text is a page,
    and in a last row how many numbers are missing or given twice."""
    folder = shared_dir(spark, "paged")
    spread(read(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("text"))).write.option("lineSep", "\f").text(folder)
    found = materialize(paged_text.read_pages(spark, folder, range_bytes=PAGE_RANGE).select(
        "source_file", "page_number", F.md5("text").alias("text_md5")), "pages")
    files = found.groupBy("source_file").agg(
        (F.count(F.lit(1)) - F.countDistinct("page_number") + F.max("page_number") - F.countDistinct("page_number")).alias("gaps"))
    gaps = files.agg(F.lit("gaps").alias("text_md5"), F.coalesce(F.sum("gaps"), F.lit(0)).alias("n"))
    return found.groupBy("text_md5").agg(F.count(F.lit(1)).alias("n")).unionAll(gaps)


def onboarded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder taken through all steps of onboarding: loaded and source rows per table, columns and
    key as profiled, and the files left out."""
    output = shared_dir(spark, "onboarded")
    name = f"shop_{os.path.basename(output)[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{output}/tables'")
    done = onboarding.onboard(spark, onboarding.Dataset(_exported_files(spark, sf_dir, ONBOARDED), name, f"{output}/texts"))
    keys = profile.inferred_keys(done["profile"]).select("table_name", "column_count", "inferred_primary_key")
    left_out = done["skipped"].select(
        F.col("file").alias("table_name"), *[F.lit(None).cast(t).alias(c) for c, t in (("loaded_rows", "bigint"), ("source_rows", "bigint"))], F.lit("SKIPPED").alias("status"),
        F.lit(None).cast("int").alias("column_count"), F.lit(None).cast("string").alias("inferred_primary_key"))
    return done["ingest"].join(keys, "table_name").unionByName(left_out)


def saved_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables saved to a database, one of them again under other columns, as the catalog then lists them."""
    path = shared_dir(spark, "saved")
    name = f"saved_{os.path.basename(path)[-12:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    for table in ("customer", "supplier", "part"):
        writers.save_table(read(spark, sf_dir, table), f"{name}.{table}")
    writers.save_table(identifiers.rename_clean(read(spark, sf_dir, "orders").toDF("Order Key", "o_cust?", "status", "price", "date", "Priority ")), f"{name}.part")
    tables = catalog.read_tables(spark, name)
    counts = writers.reconcile(tables, {t: 0 for t in tables}).select("table_name", F.col("loaded_rows").alias("row_count"))
    return tools.list_columns(tables).join(counts, "table_name")


def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile written as JSON, a folder per table, and read back."""
    path = shared_dir(spark, "profile-json")
    writers.write_profile(stored_profile(spark, sf_dir), path)
    nested = spark.read.json(f"{path}/json")
    return nested.select("table_name", "row_count", F.inline("columns")).select("table_name", "row_count", "column_name", "kind", "distinct_count")


def csv_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written in a single-byte encoding, and read back as what the bytes say they are."""
    path = shared_dir(spark, "encoded")
    text = F.translate("text", "\n", " ")
    read(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("Text")).write.csv(
        path, header=True, quote='"', escape='"', encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    facts = files.sniff_folder(spark, path)
    df = identifiers.rename_clean(files.read_csv(spark, path, facts.encoding, facts.multi_line))
    return df.select(F.col("doc_id").cast("bigint"), "lang", F.md5("text").alias("digest"), F.lit(facts.encoding).alias("encoding"))


def typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV and read back under their declared schema."""
    schema = read(spark, sf_dir, "orders").schema
    df = files.read_typed_csv(spark, _exported(spark, sf_dir, "orders", plain=True), schema, {"o_orderpriority"})
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


# Documents and vectors ---------------------------------------------------------------

def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pages.text_pages(docs, F.concat(F.lit("doc_"), F.col("doc_id").cast("string")), F.col("text"))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_pages(document_pages(spark, sf_dir))


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table of chunks with their vectors."""
    return staged(spark, sf_dir, "chunk-vectors", lambda: document_chunks(spark, sf_dir).withColumn(
        "embedding", models.embed(F.col("content"))))


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(read(spark, sf_dir, "pages").select("url", "html"))
    return chunks.chunk_pages(pages.html_pages(rows, F.col("url"), F.col("html")))


def spaced_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_pages(document_pages(spark, sf_dir), min_advance=True)


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.document_metadata(read(spark, sf_dir, "pages"), F.col("url"), F.col("html"))


def chunk_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.length_histogram(document_chunks(spark, sf_dir))


def source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.source_count(document_chunks(spark, sf_dir))


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-zero entries of the default vectors of all documents."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    entries = docs.select("doc_id", F.posexplode(models.embed(F.col("text"))).alias("bucket", "weight"))
    return entries.where(F.col("weight") != 0).select(
        "doc_id", "bucket", F.round(F.col("weight").cast("double"), 5).alias("weight"))


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return read(spark, sf_dir, "embeddings").where(F.col("vec_id") == QUERY_VECTOR).first().embedding


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.top_hits(read(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir))
    return hits.select("vec_id", "label", "score")


def _label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per label: its first vector."""
    return read(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.min("vec_id").alias("query_id"), F.min_by("embedding", "vec_id").alias("embedding"))


def _batch_hits(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    return retrieval.batch_hits(read(spark, sf_dir, "embeddings"), _label_queries(spark, sf_dir), k)


def cosine_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_hits(spark, sf_dir, retrieval.TOP_K)


def label_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.label_votes(_batch_hits(spark, sf_dir, 9), read(spark, sf_dir, "embeddings"))


def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.similar_pairs(read(spark, sf_dir, "embeddings"), MIN_SCORE)


def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector against the first one of its label."""
    vectors = read(spark, sf_dir, "embeddings")
    pairs = vectors.join(_label_queries(spark, sf_dir).select("label", "query_id"), "label").select(
        F.col("query_id").alias("left_id"), F.col("vec_id").alias("right_id"))
    return retrieval.score_pairs(pairs, vectors)


def bucketed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vectors, a folder per bucket."""
    vectors = read(spark, sf_dir, "embeddings")
    width = len(_query_vector(spark, sf_dir))
    return staged(spark, sf_dir, "bucketed-vectors", lambda: retrieval.with_buckets(vectors, width), "bucket")


def ann_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = retrieval.approximate_hits(bucketed_vectors(spark, sf_dir), _query_vector(spark, sf_dir))
    return hits.select("vec_id", "label", "score")


def ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the best four and of the best ten of every fiftieth vector, how many the approximate search reads, and whether these are nine tenths;
    and what the search itself returns for each label's first vector: of how many, and how many hits."""
    index = bucketed_vectors(spark, sf_dir)
    searched = reduce(DataFrame.unionAll, [
        retrieval.approximate_hits(index, q.embedding).select(F.lit(q.query_id).alias("query_id"), F.col("vec_id").alias("hit_id"))
        for q in _label_queries(spark, sf_dir).where(comparable(F.col("embedding"))).collect()],  # a row per label
        spark.createDataFrame([], f"query_id {index.schema['vec_id'].dataType.simpleString()}, hit_id {index.schema['vec_id'].dataType.simpleString()}"))
    returned = searched.agg(F.countDistinct("query_id").alias("questions"), F.count("hit_id").alias("returned"))
    vectors, width = read(spark, sf_dir, "embeddings"), len(_query_vector(spark, sf_dir))
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    parts = [retrieval.recall(vectors, asked, width, k).select(F.lit(k).alias("k"), "right", "hits") for k in (retrieval.TOP_K, 10)]
    return parts[0].unionAll(parts[1]).withColumn("recall_holds", F.col("right") >= 0.9 * F.col("hits")).crossJoin(returned)


def coded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best ten of every fiftieth vector, found by byte codes and read whole only where these leave a doubt."""
    vectors = read(spark, sf_dir, "embeddings")
    index = stored(spark, sf_dir, "coded-vectors", lambda path: codes.write_index(vectors, path))
    asked = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return codes.coded_hits(index, asked, 10)


def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return projection.project(projection.fit_plane(vectors), vectors).select("vec_id", "x", "y")


def kmeans_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.cluster(read(spark, sf_dir, "embeddings"), CLUSTERS).select("vec_id", "cluster")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _found(spark: SparkSession, sf_dir: str, page: list[str] | None = None) -> DataFrame:
    vectors = catalog.not_empty(chunk_vectors(spark, sf_dir), "The chunk table")
    asked = questions(spark, sf_dir).withColumn("embedding", models.embed(F.col("text")))
    hits = retrieval.batch_hits(vectors, asked, id_column="chunk_id", page=page)
    return retrieval.hit_rows(hits, vectors)


def keyword_index(spark: SparkSession, sf_dir: str) -> keywords.KeywordIndex:
    """The stored index of the words of all chunks."""
    key = (spark.sparkContext.applicationId, sf_dir, "keywords", stamp(spark, f"{sf_dir}/documents.parquet"))
    if key not in _staged:
        path = shared_dir(spark, "keywords")
        keywords.write_keyword_index(chunk_vectors(spark, sf_dir), path)
        _staged[key] = path
    return keywords.read_keyword_index(spark, _staged[key])


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(spark, sf_dir).withColumn("embedding", models.embed(F.col("text")))


def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keyword_hits(keyword_index(spark, sf_dir), questions(spark, sf_dir)).withColumnRenamed("hit_id", "chunk_id")


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best chunks for every question by vectors of at least ``MIN_SCORE`` and words together."""
    hits = keywords.hybrid_hits(chunk_vectors(spark, sf_dir), keyword_index(spark, sf_dir), _asked(spark, sf_dir), min_score=MIN_SCORE)
    return hits.withColumnRenamed("hit_id", "chunk_id")


def _candidates(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    hits = keywords.hybrid_hits(chunk_vectors(spark, sf_dir), keyword_index(spark, sf_dir), _asked(spark, sf_dir), k, CANDIDATES)
    return hits.withColumnRenamed("hit_id", "chunk_id")


def reranked_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of ten times as many candidates, by late interaction."""
    return rerank.reranked(_candidates(spark, sf_dir, CANDIDATES), chunk_vectors(spark, sf_dir), questions(spark, sf_dir))


def expanded_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts around the hits of every question, a chunk to each side."""
    spans = staged(spark, sf_dir, "chunk-spans", lambda: chunks.chunk_pages(document_pages(spark, sf_dir), with_span=True))
    return rerank.expanded(_candidates(spark, sf_dir, QUALITY_AT), spans)


def retrieval_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each search finds the documents that hold a question's passage: their chunks are worth 1, those that hold all of it 2."""
    table, index, asked = chunk_vectors(spark, sf_dir), keyword_index(spark, sf_dir), _asked(spark, sf_dir)
    docs = document_pages(spark, sf_dir)
    holding = materialize(keywords.holding_documents(index, asked, table, docs), "holding")
    passages = questions(spark, sf_dir).select("query_id", text_functions.collapse_whitespace(F.col("text")).alias("passage"))
    grade = F.when(F.contains("content", "passage"), 2).otherwise(1)
    graded = materialize(sent_if_few(holding).join(table.select("source_file", "chunk_id", "content"), "source_file").join(passages, "query_id").select(
        "query_id", "source_file", "chunk_id", grade.alias("grade")), "graded")
    some = lambda g: F.array_repeat(F.lit(g), F.least(F.count_if(F.col("grade") == g), F.lit(QUALITY_AT)).cast("int"))
    relevant = graded.groupBy("query_id", "source_file").agg(F.concat(some(2), some(1)).alias("grades"))
    searches = {
        "vector": retrieval.batch_hits(table, asked, QUALITY_AT, id_column="chunk_id"), "keyword": keywords.keyword_hits(index, asked, QUALITY_AT),
        "hybrid": keywords.hybrid_hits(table, index, asked, QUALITY_AT, CANDIDATES)}
    parts = []
    for name, hits in searches.items():
        judged = hits.withColumnRenamed("hit_id", "chunk_id").join(graded, ["query_id", "chunk_id"], "left").select(
            "query_id", "rank", "source_file", F.coalesce("grade", F.lit(0)).alias("grade"))
        parts.append(keywords.ranking_quality(judged, relevant, QUALITY_AT).select(F.lit(name).alias("search"), "*"))
    return reduce(DataFrame.unionAll, parts)


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir).select(
        "query_id", "rank", "score", "source_file", "page_number", "chunk_index", "preview")


def search_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks closest to the first question's text."""
    asked = questions(spark, sf_dir).orderBy("query_id").first().text
    return retrieval.similarity_search(chunk_vectors(spark, sf_dir), ["chunk_id", "source_file"], text=asked)


def distinct_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best pages for each question, by their best chunk."""
    return _found(spark, sf_dir, ["source_file", "page_number"]).select("query_id", "rank", "source_file", "page_number", "chunk_index")


def context_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.assemble_context(_found(spark, sf_dir), questions(spark, sf_dir))


def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.assemble_context(_found(spark, sf_dir), questions(spark, sf_dir), with_relevance=True)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = questions(spark, sf_dir)
    return context.prompt_rows(context.assemble_context(_found(spark, sf_dir), asked), asked)


def prompt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts(spark, sf_dir).select("query_id", "question", F.posexplode("messages").alias("turn", "m")).select(
        "query_id", "question", "turn", "m.role", "m.content")


def generate_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.answer(prompts(spark, sf_dir))


def labelled_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three turns of conversation closest to each question, with who spoke."""
    turns = spread(read(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", "conv_id", "turn").alias("turn_id"), "role", "text")
    asked = questions(spark, sf_dir).withColumn("embedding", models.embed(F.col("text")))
    hits = retrieval.batch_hits(turns.withColumn("embedding", models.embed(F.col("text"))), asked, 3, id_column="turn_id")
    return retrieval.labelled_hits(hits, turns, "role", "text", "turn_id")


def incremental_sync(spark: SparkSession, sf_dir: str, every: str | None = None) -> DataFrame:
    """The vector table after two arrivals of chunks: those of all documents, then those of
    the English ones again, revised."""
    chunked = chunk_vectors(spark, sf_dir).drop("embedding")
    english = read(spark, sf_dir, "documents").where(F.col("lang") == "en").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source_file"))
    folder = shared_dir(spark, "sync")
    source, index, checkpoint = (f"{folder}/{name}" for name in ("source", "index", "checkpoint"))
    arrivals = (chunked, chunked.join(sent_if_few(english), "source_file", "left_semi").withColumn(
        "content", F.concat("content", F.lit(" (revised)"))))
    for arrival in arrivals:
        arrival.select(*chunked.columns).write.mode("append").parquet(source)
        query = sync.start_sync(spark, source, chunked.schema, index, checkpoint, every=every)
        if every:
            query.processAllAvailable()
            query.stop()
        else:
            query.awaitTermination()
    return sync.read_index(spark, index).select(
        "chunk_id", "source_file", "chunk_index", "content", F.size("embedding").alias("width"))


def continuous_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a sync that keeps running."""
    return incremental_sync(spark, sf_dir, every="1 second")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in (
        top_selling_products, customer_order_history, monthly_revenue, low_stock_products, restock_urgency,
        restock_classified, filter_by_threshold, readonly_sql, readonly_refusals, table_inventory, table_profile, inferred_keys,
        declared_keys, top_values_all_columns, value_counts, monthly_trend, chart_columns, report_datasets,
        question_columns, example_questions, schema_text, data_dictionary, fk_violations, pk_violations, snapshot_diff,
        clean_names, csv_reload, csv_preview, typed_csv, row_count_reconciliation, page_metadata, page_chunks, spaced_chunks,
        chunk_length_histogram, source_count, hash_embed, cosine_topk, cosine_topk_batch, label_vote, similar_pairs,
        score_pairs, ann_topk, ann_recall, coded_search, pca_2d, kmeans_labels, search_documents, distinct_page_hits, context_assembly,
        search_text, prompt_rows, generate_answer, incremental_sync, continuous_sync, distinct_labels, labelled_ranking, search_by_text,
        keyword_search, hybrid_search, retrieval_quality, reranked_hits, expanded_hits, csv_discovery, document_listing, paged_documents, onboarded_tables, saved_tables, profile_json, csv_encoded)}
    named["chunk_documents"] = document_chunks
    for agg, metric in (("sum", "o_totalprice"), ("avg", "o_totalprice"), ("count", "o_orderkey"),
                        ("min", "o_totalprice"), ("max", "o_totalprice")):
        named[f"top_n_group_by_{agg}"] = _top_n(agg, metric)
    for table in ("lineitem", "orders", "customer", "events", "documents"):
        named[f"profile_{table}"] = _profile(table)
    named["profile_approx"], named["profile_incremental"] = profile_approx, profile_incremental
    named["sql_top_selling_products"] = _sql_function("top_selling_products()", "revenue")
    named["sql_customer_order_history"] = _sql_function(f"customer_order_history({CUSTOMER})", "order_total")
    named["sql_monthly_revenue"] = _sql_function("monthly_revenue()", "revenue")
    named["sql_low_stock_products"] = _sql_function("low_stock_products()")
    return named
