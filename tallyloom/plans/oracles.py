"""The same questions as plain SQL, for checking results with another engine.

Every statement reads the given tables by name. Column names and values match the
DataFrames of ``catalogue``.
"""

from __future__ import annotations

from tallyloom.functions import models
from tallyloom.functions.vectors import NORM_GUARD, SCORE_DIGITS
from tallyloom.operators import context, keywords, retrieval
from tallyloom.plans import catalogue, retail
from tallyloom.sources import pages

# The given tables: column -> type, in order.
COLUMNS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
NUMBERS = ("INT", "BIGINT", "DOUBLE")


def _columns(table: str) -> list[tuple[int, str, str, str]]:
    out = []
    for i, column in enumerate(COLUMNS[table].split(", ")):
        name, dtype = column.split(" ", 1)
        kind = "numerical" if dtype in NUMBERS else "temporal" if dtype.startswith("TIMESTAMP") else "categorical"
        out.append((i, name, dtype, kind))
    return out


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Retail ------------------------------------------------------------------------------

ITEMS = """items AS (
  SELECT l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price
  FROM lineitem)"""

TOP_SELLING = f"""WITH {ITEMS}
SELECT p_name AS product_name, p_brand AS category_name, CAST(SUM(quantity) AS BIGINT) AS units_sold,
       CAST(SUM(quantity * unit_price) AS DOUBLE) AS revenue
FROM items JOIN part ON p_partkey = product_id
GROUP BY ALL ORDER BY SUM(quantity * unit_price) DESC, product_name, category_name LIMIT 5"""

ORDER_HISTORY = f"""WITH {ITEMS}
SELECT o_orderkey AS order_id, CAST(o_orderdate AS VARCHAR) AS order_date, o_orderstatus AS status,
       COUNT(order_item_id) AS item_count, CAST(SUM(quantity * unit_price) AS DOUBLE) AS order_total
FROM orders JOIN items ON order_id = o_orderkey WHERE o_custkey = {catalogue.CUSTOMER} GROUP BY ALL"""

MONTHLY_REVENUE = f"""WITH {ITEMS}
SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(SUM(quantity * unit_price) AS DOUBLE) AS revenue,
       COUNT(DISTINCT o_orderkey) AS order_count
FROM orders JOIN items ON order_id = o_orderkey GROUP BY 1"""

STOCK = f"""WITH {ITEMS},
stock AS (
  SELECT p_name AS product_name, p_size AS quantity_on_hand, reorder_level, supplier_id
  FROM (SELECT product_id, supplier_id, CAST(CEIL(AVG(quantity)) AS INTEGER) AS reorder_level FROM items GROUP BY ALL)
  JOIN part ON p_partkey = product_id
  WHERE p_size <= reorder_level AND NOT (p_type = 'PROMO'))"""

LOW_STOCK = f"""{STOCK}
SELECT product_name, quantity_on_hand, reorder_level, s_name AS supplier_name
FROM stock JOIN supplier ON s_suppkey = supplier_id"""

URGENCY = f"""{STOCK}
SELECT product_name, quantity_on_hand, reorder_level,
       CASE WHEN quantity_on_hand * 2 <= reorder_level THEN 'urgent' ELSE 'monitor' END AS restock_urgency
FROM stock"""


# Profile -----------------------------------------------------------------------------

def _top_values(table: str, column: str) -> str:
    return f"""SELECT CAST({column} AS VARCHAR) AS value, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL
      GROUP BY 1 ORDER BY n DESC, value LIMIT 10"""


def _profile_row(table: str, i: int, name: str, dtype: str, kind: str) -> str:
    number, moment, word = (kind == k for k in ("numerical", "temporal", "categorical"))

    def when(use: bool, expr: str, dtype: str) -> str:
        return expr if use else f"CAST(NULL AS {dtype})"

    values = f"(SELECT COALESCE(string_agg(value || ' (' || n || ')', ', ' ORDER BY n DESC, value), '') FROM ({_top_values(table, name)}))"
    return f"""SELECT '{table}' AS table_name, {i} AS ordinal, '{name}' AS column_name, '{dtype}' AS data_type, '{kind}' AS kind,
  COUNT(*) AS row_count, {len(_columns(table))} AS column_count, COUNT(*) - COUNT({name}) AS null_count,
  CASE WHEN COUNT(*) > 0 THEN ROUND((COUNT(*) - COUNT({name})) * 100.0 / COUNT(*), 2) ELSE 0.0 END::DOUBLE AS null_pct,
  COUNT(DISTINCT {name}) AS distinct_count,
  {when(number, f'MIN({name})::DOUBLE', 'DOUBLE')} AS min_number, {when(number, f'MAX({name})::DOUBLE', 'DOUBLE')} AS max_number,
  {when(number, f'ROUND(AVG({name}::DOUBLE), 4)', 'DOUBLE')} AS mean,
  {when(number, f'quantile_disc({name}::DOUBLE, 0.5)', 'DOUBLE')} AS median,
  {when(number, f'ROUND(stddev_samp({name}::DOUBLE), 4)', 'DOUBLE')} AS stddev,
  {when(moment, f'MIN({name})::VARCHAR', 'VARCHAR')} AS min_time, {when(moment, f'MAX({name})::VARCHAR', 'VARCHAR')} AS max_time,
  {when(word, f'COUNT(DISTINCT {name}) > 50', 'BOOLEAN')} AS high_cardinality,
  {when(word, f"CASE WHEN COUNT(DISTINCT {name}) > 50 THEN COUNT(DISTINCT {name}) || ' unique values across ' || COUNT(*) || ' rows; too many to list (an identifier or free text)' END", 'VARCHAR')} AS note,
  {when(word, f"CASE WHEN COUNT(DISTINCT {name}) <= 50 THEN {values} END", 'VARCHAR')} AS value_counts
FROM {table}"""


def profile_sql(*tables: str) -> str:
    return _union([_profile_row(t, *column) for t in tables for column in _columns(t)])


ID_LIKE = "(lower(column_name) IN ('id', 'rowid', 'uuid', 'guid') OR lower(column_name) LIKE '%\\_id' ESCAPE '\\')"

# The profile of all tables with the inferred key.
PROFILE = f"""profiled AS ({profile_sql(*sorted(COLUMNS))}),
profile AS (
  SELECT *, is_unique AND row_number() OVER (
    PARTITION BY table_name ORDER BY is_unique DESC, {ID_LIKE} DESC, ordinal) = 1 AS is_key
  FROM (SELECT *, row_count > 0 AND null_count = 0 AND distinct_count = row_count AS is_unique FROM profiled))"""

INFERRED_KEYS = f"""WITH {PROFILE}
SELECT table_name, MAX(row_count) AS row_count, MAX(column_count) AS column_count,
       MAX(CASE WHEN is_key THEN column_name END) AS inferred_primary_key
FROM profile GROUP BY table_name"""


def _declared_keys() -> str:
    keys = [(t, c, "TRUE", "NULL") for t, columns in catalogue.PRIMARY_KEYS.items() for c in columns]
    keys += [(t, c, "FALSE", f"'{ref}'") for t, links in catalogue.FOREIGN_KEYS.items() for c, ref in links.items()]
    listed = ", ".join(f"('{t}', '{c}', {pk}, {ref})" for t, c, pk, ref in keys)
    return f"""WITH {PROFILE},
keys AS (SELECT t, c, bool_or(pk) AS pk, MAX(ref) AS ref FROM (VALUES {listed}) AS k(t, c, pk, ref) GROUP BY t, c)
SELECT table_name, column_name, distinct_count, COALESCE(pk, FALSE) AS is_primary_key, ref IS NOT NULL AS is_foreign_key,
       ref AS "references"
FROM profile LEFT JOIN keys ON t = table_name AND c = column_name"""


def _all_top_values() -> str:
    parts = [
        f"""SELECT '{t}' AS table_name, '{name}' AS column_name, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS place, value, n
FROM ({_top_values(t, name)}) WHERE (SELECT COUNT(DISTINCT {name}) <= 50 FROM {t})"""
        for t in sorted(COLUMNS) for _, name, _, kind in _columns(t) if kind == "categorical"]
    return _union(parts)


TRENDS = {t: [name for _, name, _, kind in _columns(t) if kind == "temporal"] for t in COLUMNS}


def _trend(table: str, column: str) -> str:
    return f"SELECT strftime({column}, '%Y-%m') AS period, COUNT(*) AS n FROM {table} GROUP BY 1"


MONTHLY_TREND = _union([
    f"SELECT '{t}' AS table_name, period, n FROM ({_trend(t, c)})"
    for t, c in (("events", "ts"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate"))])

CHARTS = f"""{PROFILE},
charts AS (
  SELECT table_name, column_name, chart, place FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY table_name, chart ORDER BY ordinal) AS INTEGER) AS place FROM (
      SELECT *, CASE WHEN kind = 'categorical' AND NOT high_cardinality AND NOT is_key AND distinct_count >= 2 THEN 'top'
                     WHEN kind = 'temporal' THEN 'trend' END AS chart FROM profile) WHERE chart IS NOT NULL)
  WHERE place <= CASE WHEN chart = 'top' THEN 2 ELSE 1 END)"""


def _report() -> str:
    covered = sorted(COLUMNS)
    names = ", ".join(f"'{t}'" for t in covered)
    trends = [
        f"SELECT 'ds_{t}_{c}_trend' AS dataset, period AS label, n FROM ({_trend(t, c)})" for t in covered for c in TRENDS[t][:1]]
    return _union([
        f"""WITH {CHARTS}, tops AS ({_all_top_values()})
SELECT 'ds_' || table_name || '_rows' AS dataset, CAST(NULL AS VARCHAR) AS label, row_count AS n
FROM profile WHERE ordinal = 0 AND table_name IN ({names})""",
        f"""SELECT 'ds_' || table_name || '_' || column_name || '_top' AS dataset, value AS label, n
FROM tops JOIN charts USING (table_name, column_name) WHERE chart = 'top' AND table_name IN ({names})""",
        *trends])


QUESTIONS = f"""{PROFILE},
picked AS (
  SELECT table_name, MAX(row_count) AS row_count,
    arg_min(column_name, ordinal) FILTER (kind = 'categorical' AND NOT high_cardinality) AS category,
    arg_min(column_name, ordinal) FILTER (kind = 'numerical' AND NOT is_key AND NOT {ID_LIKE}) AS measure,
    arg_min(column_name, ordinal) FILTER (kind = 'temporal') AS moment
  FROM profile GROUP BY table_name)"""

EXAMPLE_QUESTIONS = f"""WITH {QUESTIONS},
asked AS (
  SELECT row_count, table_name, 0 AS template, 'What are the top 5 ' || category || ' values in `' || table_name || '` by total ' || measure || '?' AS question FROM picked
  UNION ALL SELECT row_count, table_name, 1, 'What''s the range and average ' || measure || ' in `' || table_name || '`?' FROM picked
  UNION ALL SELECT row_count, table_name, 2, 'How does the row count in `' || table_name || '` trend over ' || moment || '?' FROM picked
  UNION ALL SELECT row_count, table_name, 3, 'How many rows fall into each ' || category || ' category in `' || table_name || '`?' FROM picked)
SELECT CAST(row_number() OVER (ORDER BY row_count DESC, table_name, template) AS INTEGER) AS place, question
FROM asked WHERE question IS NOT NULL ORDER BY 1 LIMIT 6"""

SCHEMA_TEXT = f"""WITH {PROFILE}, tops AS ({_all_top_values()}),
samples AS (
  SELECT table_name, column_name, string_agg(value, ', ' ORDER BY place) AS sample FROM tops WHERE place <= 4 GROUP BY ALL),
lines AS (
  SELECT table_name, row_count, ordinal, '  - ' || column_name || ' (' || kind || CASE
      WHEN kind = 'categorical' AND NOT high_cardinality THEN '): e.g. ' || COALESCE(sample, '')
      WHEN kind = 'temporal' THEN '): ' || COALESCE(min_time, 'none') || ' to ' || COALESCE(max_time, 'none')
      ELSE ')' END AS line
  FROM profile LEFT JOIN samples USING (table_name, column_name)),
tables AS (
  SELECT table_name, chr(10) || 'Table `' || table_name || '` (' || row_count || ' rows):' || chr(10)
      || string_agg(line, chr(10) ORDER BY ordinal) AS text
  FROM lines GROUP BY table_name, row_count)
SELECT 'Schema: testdata' || chr(10) || string_agg(text, chr(10) ORDER BY table_name) AS schema_text FROM tables"""


def _plain(x: str) -> str:
    return f"COALESCE(regexp_replace(CAST(CAST({x} AS DECIMAL(38,10)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1'), 'None')"


DATA_DICTIONARY = f"""WITH {PROFILE}, tops AS ({_all_top_values()}),
samples AS (
  SELECT table_name, column_name, string_agg(value || ' (' || n || ')', ', ' ORDER BY place) AS sample
  FROM tops WHERE place <= 5 GROUP BY ALL),
lines AS (
  SELECT table_name, row_count, column_count, ordinal, CASE WHEN is_key THEN column_name END AS key,
    '| ' || column_name || CASE WHEN is_key THEN ' (PK, inferred)' ELSE '' END || ' | ' || kind || ' | '
    || printf('%.2f', null_pct) || '% | ' || distinct_count || ' | ' || CASE
      WHEN kind = 'numerical' THEN 'min=' || {_plain('min_number')} || ', max=' || {_plain('max_number')} || ', mean=' || {_plain('mean')}
        || ', median=' || {_plain('median')} || ', stddev=' || {_plain('stddev')}
      WHEN kind = 'temporal' THEN 'range: ' || COALESCE(min_time, 'None') || ' to ' || COALESCE(max_time, 'None')
      WHEN high_cardinality THEN note ELSE COALESCE(sample, '') END || ' |' AS line
  FROM profile LEFT JOIN samples USING (table_name, column_name))
SELECT table_name, '## ' || table_name || chr(10) || '- Rows: ' || row_count || '  |  Columns: ' || column_count || chr(10)
    || COALESCE('- Inferred primary key: `' || MAX(key) || '` (heuristic, not a declared constraint)' || chr(10), '')
    || chr(10) || '| Column | Kind | Null % | Distinct | Summary |' || chr(10) || '|---|---|---|---|---|' || chr(10)
    || string_agg(line, chr(10) ORDER BY ordinal) AS section
FROM lines GROUP BY table_name, row_count, column_count"""


# Keys, names and files ---------------------------------------------------------------

def _fk(table: str, column: str, parent: str, key: str, name: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, COUNT(DISTINCT {column}) AS missing_keys, COUNT(*) AS violating_rows
FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"""


FK_VIOLATIONS = _union([
    _fk(t, c, *ref.split("."), f"{t}.{c}") for t, links in catalogue.FOREIGN_KEYS.items() for c, ref in links.items()
] + [_fk("orders", "o_custkey", "(SELECT * FROM customer WHERE c_acctbal > 0)", "c_custkey", "orders.o_custkey in credit")])


def _pk(table: str, key: list[str]) -> str:
    null = " OR ".join(f"{c} IS NULL" for c in key)
    return f"""SELECT '{table}' AS constraint_name, COUNT(*) FILTER (n > 1 AND NOT has_null) AS repeated_keys,
  CAST(COALESCE(SUM(n) FILTER (n > 1 AND NOT has_null), 0) AS BIGINT) AS repeated_rows,
  CAST(COALESCE(SUM(n) FILTER (has_null), 0) AS BIGINT) AS null_rows
FROM (SELECT ({null}) AS has_null, COUNT(*) AS n FROM {table} GROUP BY {', '.join(key)}, ({null}))"""


PK_VIOLATIONS = _union([_pk(t, key) for t, key in catalogue.PRIMARY_KEYS.items()])

SNAPSHOT_DIFF = """WITH dated AS (
  SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate, CASE WHEN o_orderkey IN (
      (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < '1996-01-01'), (SELECT max(o_orderkey) FROM orders WHERE o_orderdate >= '2001-01-01'))
    THEN NULL ELSE o_orderkey END AS o_orderkey) FROM orders),
old AS (SELECT * FROM dated WHERE o_orderdate < '2001'),
new AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
        FROM dated WHERE o_orderdate >= '1996')
SELECT 'insert' AS change, * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.o_orderkey IS NOT DISTINCT FROM new.o_orderkey)
UNION ALL SELECT 'delete', * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE old.o_orderkey IS NOT DISTINCT FROM new.o_orderkey)
UNION ALL SELECT 'update', * FROM (SELECT * FROM new EXCEPT SELECT * FROM old) n WHERE EXISTS (SELECT 1 FROM old WHERE old.o_orderkey IS NOT DISTINCT FROM n.o_orderkey)"""


def _identifier(x: str) -> str:
    core = f"COALESCE(NULLIF(lower(trim(regexp_replace({x}, '[^0-9a-zA-Z]+', '_', 'g'), '_')), ''), 'col')"
    return f"CASE WHEN regexp_matches({core}, '^[0-9]') THEN 'c_' || {core} ELSE {core} END"


CLEAN_NAMES = f"""WITH names AS (
  SELECT p_brand AS raw FROM part UNION SELECT p_name FROM part UNION SELECT url FROM pages),
clean AS (
  SELECT raw, {_identifier('raw')} AS identifier,
    regexp_replace(regexp_extract(raw, '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS stem FROM names)
SELECT raw, identifier, {_identifier('stem')} AS table_name,
  identifier IN ('id', 'rowid', 'uuid', 'guid') OR ends_with(identifier, '_id') AS id_like FROM clean"""

CSV_RELOAD = """SELECT CAST(event_id AS INTEGER) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS INTEGER) AS user_id,
  event_type, value, props FROM events"""

CSV_PREVIEW = _union([
    f"SELECT {i} AS position, ' {name.replace('_', ' ').title()}! ' AS source_column, '{name}' AS clean_column, COUNT(*) AS row_count FROM conversations"
    for i, name, _, _ in _columns("conversations")])

RECONCILIATION = _union([
    f"SELECT '{t}' AS table_name, COUNT(*) AS loaded_rows, COUNT(*) AS source_rows, 'OK' AS status FROM {t}"
    for t in ("customer", "orders", "lineitem", "events", "conversations")])

DISCOVERY = """SELECT * FROM (VALUES ('Customer List.csv', FALSE, '# MB is over the cap of # MB'), ('nation.csv', TRUE, NULL),
  ('logo_region.csv', FALSE, 'name looks non-tabular (matched ''logo'')')) AS v(file, kept, reason) WHERE (SELECT COUNT(*) > 0 FROM customer)"""

LISTING = "SELECT * FROM (VALUES " + ", ".join(f"('{name}', TRUE)" for name in catalogue.ONBOARDED) + ") AS v(file, has_content)"

PAGED = """SELECT md5(COALESCE(text, '')) AS text_md5, COUNT(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'gaps', 0"""

ONBOARDED = """SELECT 'customer_list' AS table_name, COUNT(*) AS loaded_rows, COUNT(*) AS source_rows, 'OK' AS status, 5 AS column_count, 'c_custkey' AS inferred_primary_key FROM customer
UNION ALL SELECT 'nation', COUNT(*), COUNT(*), 'OK', 3, 'n_nationkey' FROM nation
UNION ALL SELECT 'logo_region.csv', NULL, NULL, 'SKIPPED', NULL, NULL"""

SAVED = _union([
    f"SELECT '{t}' AS table_name, {i} AS ordinal, '{name}' AS column_name, '{dtype.lower()}' AS data_type, (SELECT COUNT(*) FROM {t}) AS row_count"
    for t in ("customer", "supplier") for i, name, dtype, _ in _columns(t)
] + [
    f"SELECT 'part', {i}, '{name}', '{dtype.lower()}', (SELECT COUNT(*) FROM orders)"
    for (i, _, dtype, _), name in zip(_columns("orders"), ("order_key", "o_cust", "status", "price", "date", "priority"))])

ENCODED = "SELECT doc_id, lang, md5(replace(text, chr(10), ' ')) AS digest, 'cp1252' AS encoding FROM documents"

INVENTORY = _union([
    f"SELECT '{t}' AS table_name, {len(_columns(t))} AS column_count, COUNT(*) AS row_count FROM {t}" for t in COLUMNS])


# Documents and vectors ---------------------------------------------------------------

def _collapsed(source: str) -> str:
    """(source_file, t): white space of ``raw`` collapsed."""
    return f"""SELECT source_file, trim(regexp_replace(raw, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')) AS t FROM ({source})"""


def chunks_sql(source: str, min_advance: bool = False) -> str:
    """CTEs that end in ``chunks``. ``source`` selects (source_file, raw). Each step of the
    recursion holds the start of a chunk and where the one before it ended."""
    floor = "a + 150" if min_advance else "a"
    return f"""pages_in AS ({source}),
texts AS (
  SELECT source_file, trim(regexp_replace(raw, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')) AS t
  FROM pages_in),
steps AS (
  SELECT source_file, t, length(t) AS n, 0 AS k, 0 AS a, 0 AS b0 FROM texts WHERE t <> ''
  UNION ALL
  SELECT source_file, t, n, k + 1, greatest(b - 150, a + 1), b FROM (
    SELECT *, CASE WHEN dot + 1 > {floor} + 1 THEN dot + 1 WHEN gap + 1 > {floor} + 1 THEN gap + 1 ELSE e END AS b FROM (
      SELECT *, CASE WHEN position(' .' IN rw) = 0 THEN -1 ELSE e - position(' .' IN rw) - 1 END AS dot,
                CASE WHEN position(' ' IN rw) = 0 THEN -1 ELSE e - position(' ' IN rw) END AS gap FROM (
        SELECT *, least(a + 1000, n) AS e, reverse(substr(t, a + 1, least(a + 1000, n) - a)) AS rw FROM steps)
      WHERE e < n))),
spans AS (SELECT source_file, t, k, a, COALESCE(lead(b0) OVER (PARTITION BY source_file ORDER BY k), n) AS b FROM steps),
cut AS (SELECT source_file, k, trim(substr(t, a + 1, b - a)) AS content FROM spans),
chunks AS (
  SELECT md5(source_file || ':1:' || chunk_index) AS chunk_id, source_file, 1 AS page_number, chunk_index, content FROM (
    SELECT source_file, CAST(row_number() OVER (PARTITION BY source_file ORDER BY k) - 1 AS INTEGER) AS chunk_index, content
    FROM cut WHERE content <> ''))"""


DOCUMENTS = "SELECT 'doc_' || doc_id AS source_file, text AS raw FROM documents"
HTML = "html"
for _pattern in ("(?is)<script[^>]*>.*?</script>", "(?is)<style[^>]*>.*?</style>", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
    HTML = f"regexp_replace({HTML}, '{_pattern}', ' ', 'g')"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    HTML = f"replace({HTML}, '{_entity}', '{_char}')"
PAGES = f"SELECT url AS source_file, {HTML} AS raw FROM pages"

CHUNKS = f"WITH RECURSIVE {chunks_sql(DOCUMENTS)}\nSELECT * FROM chunks"

HISTOGRAM = f"""WITH RECURSIVE {chunks_sql(DOCUMENTS)},
lengths AS (SELECT length(content) AS chars, MIN(length(content)) OVER () AS low, MAX(length(content)) OVER () AS high FROM chunks)
SELECT CAST(least(floor((chars - low) / greatest((high - low) / 20, 1e-9)), 19) AS INTEGER) AS bin,
  CAST(MIN(chars) AS INTEGER) AS from_chars, CAST(MAX(chars) AS INTEGER) AS to_chars, COUNT(*) AS n FROM lengths GROUP BY 1"""

METADATA = f"""SELECT url AS source_file,
  COALESCE(NULLIF(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''), '{pages.NOT_SET}') AS title,
  COALESCE(NULLIF(trim(regexp_extract(html, '(?is)<meta\\s+name=["'']author["'']\\s+content=["''](.*?)["'']', 1)), ''), '{pages.NOT_SET}') AS author
FROM pages"""


def vectors_sql(name: str, source: str) -> str:
    """CTE ``name`` (id, bucket, w): the non-zero entries of the default vector of each text.
    ``source`` selects (id, content)."""
    return f"""{name}_words AS (
  SELECT id, unnest(regexp_extract_all(lower(content), '[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+')) AS word FROM ({source})),
{name}_counts AS (
  SELECT id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 384 AS bucket, COUNT(*) AS n FROM {name}_words GROUP BY 1, 2),
{name} AS (SELECT id, bucket, CAST(n / sqrt(SUM(n * n) OVER (PARTITION BY id)) AS FLOAT)::DOUBLE AS w FROM {name}_counts)"""


HASH_EMBED = f"""WITH {vectors_sql('vec', 'SELECT doc_id AS id, text AS content FROM documents')}
SELECT id AS doc_id, CAST(bucket AS INTEGER) AS bucket, round(w, 5) AS weight FROM vec"""

SEARCH = f"""{chunks_sql(DOCUMENTS)},
{vectors_sql('cv', 'SELECT chunk_id AS id, content FROM chunks')},
{vectors_sql('qv', 'SELECT item_id AS id, text AS content FROM benchmark')},
cn AS (SELECT id, sqrt(SUM(w * w)) + {NORM_GUARD} AS norm FROM cv GROUP BY id),
qn AS (SELECT id, sqrt(SUM(w * w)) + {NORM_GUARD} AS norm FROM qv GROUP BY id),
scored AS (
  SELECT qv.id AS query_id, cv.id AS chunk_id, round(SUM(cv.w * qv.w) / any_value(cn.norm) / any_value(qn.norm), {SCORE_DIGITS}) AS score
  FROM qv JOIN cv ON cv.bucket = qv.bucket JOIN cn ON cn.id = cv.id JOIN qn ON qn.id = qv.id GROUP BY 1, 2),
hits AS (
  SELECT query_id, CAST(rank AS INTEGER) AS rank, score, chunks.* FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scored)
  JOIN chunks USING (chunk_id) WHERE rank <= 4)"""

SEARCH_BY_TEXT = f"""WITH RECURSIVE {SEARCH}
SELECT chunk_id, source_file, score FROM hits WHERE query_id = (SELECT MIN(item_id) FROM benchmark)"""

def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{keywords.WORDS}')"


# What the default encoder and scorer take as words.
WORDS = "[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+"
KEYWORDS = f"""post AS (SELECT chunk_id, term, any_value(n) AS n, COUNT(*) AS tf FROM (
    SELECT chunk_id, unnest({_tokens('content')}) AS term, len({_tokens('content')}) AS n FROM chunks) GROUP BY 1, 2),
size AS (SELECT COUNT(*) AS n, AVG(len({_tokens('content')})) AS words FROM chunks),
asked AS (SELECT DISTINCT item_id AS query_id, unnest({_tokens('text')}) AS term FROM benchmark),
idf AS (SELECT term, ln(1 + (any_value(size.n) - COUNT(*) + 0.5) / (COUNT(*) + 0.5)) AS idf FROM post, size GROUP BY term),
bm AS (
  SELECT query_id, chunk_id, round(SUM(idf * tf * ({keywords.SATURATION} + 1) / (tf + {keywords.SATURATION} * (1 - {keywords.LENGTH_WEIGHT} + {keywords.LENGTH_WEIGHT} * post.n / size.words))), 9) AS score
  FROM asked JOIN post USING (term) JOIN idf USING (term), size GROUP BY 1, 2),
worded AS (SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM bm),
near AS (SELECT query_id, chunk_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM scored)"""
KEYWORD_SEARCH = f"""WITH RECURSIVE {chunks_sql(DOCUMENTS)}, scored AS (SELECT 0 AS query_id, '' AS chunk_id, 0 AS score), {KEYWORDS}
SELECT query_id, rank, chunk_id, score FROM worded WHERE rank <= 4"""


def _fused(name: str, k: int, wide: int, least: str = "-1") -> str:
    return f"""{name} AS (
  SELECT query_id, chunk_id, round(coalesce(1.0::DOUBLE / ({keywords.RANK_OFFSET} + v.rank), 0) + coalesce(1.0::DOUBLE / ({keywords.RANK_OFFSET} + w.rank), 0), 9) AS score,
         v.rank AS vector_rank, w.rank AS keyword_rank
  FROM (SELECT * FROM near WHERE rank <= {wide} AND score >= {least}) v FULL JOIN (SELECT * FROM worded WHERE rank <= {wide}) w USING (query_id, chunk_id)),
{name}_hits AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank, chunk_id, score, vector_rank, keyword_rank
  FROM {name} QUALIFY rank <= {k})"""


SEARCH_DOCUMENTS = f"""WITH RECURSIVE {SEARCH}
SELECT query_id, rank, score, source_file, page_number, chunk_index, substr(content, 1, 160) || '...' AS preview
FROM hits"""

HYBRID_SEARCH = f"""WITH RECURSIVE {SEARCH}, {KEYWORDS}, {_fused('mixed', 4, 40, str(catalogue.MIN_SCORE))}
SELECT * FROM mixed_hits"""

AT = catalogue.QUALITY_AT
RETRIEVAL_QUALITY = f"""WITH RECURSIVE {SEARCH}, {KEYWORDS}, {_fused('mixed', AT, catalogue.CANDIDATES)},
passages AS (SELECT source_file AS query_id, t AS passage FROM ({_collapsed("SELECT item_id AS source_file, text AS raw FROM benchmark")})),
graded AS (
  SELECT query_id, source_file, chunk_id, CASE WHEN contains(content, passage) THEN 2 ELSE 1 END AS grade
  FROM passages JOIN texts ON contains(t, passage) JOIN chunks USING (source_file)),
ideal AS (
  SELECT query_id, SUM((2 ** grade - 1) / log2(place + 1)) AS ideal FROM (
    SELECT query_id, grade, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC) AS place FROM graded QUALIFY place <= {AT}) GROUP BY 1),
known AS (SELECT query_id, COUNT(DISTINCT source_file) AS known FROM graded GROUP BY 1),
found AS (
  SELECT 'vector' AS search, query_id, rank, chunk_id FROM near WHERE rank <= {AT} UNION ALL
  SELECT 'keyword', query_id, rank, chunk_id FROM worded WHERE rank <= {AT} UNION ALL
  SELECT 'hybrid', query_id, rank, chunk_id FROM mixed_hits),
got AS (
  SELECT search, query_id, COUNT(DISTINCT source_file) AS found, MIN(rank) AS first, SUM((2 ** grade - 1) / log2(rank + 1)) AS dcg
  FROM found JOIN graded USING (query_id, chunk_id) GROUP BY 1, 2)
SELECT s.search, query_id, coalesce(found, 0) AS found, known, round(coalesce(found, 0) / least(known, {AT}), 6) AS recall,
       round(coalesce(1.0::DOUBLE / first, 0), 6) AS reciprocal_rank, round(coalesce(dcg, 0) / ideal, 6) AS ndcg
FROM (VALUES ('vector'), ('keyword'), ('hybrid')) AS s(search), known JOIN ideal USING (query_id)
LEFT JOIN got ON got.search = s.search AND got.query_id = known.query_id"""

RERANKED = f"""WITH RECURSIVE {SEARCH}, {KEYWORDS}, {_fused('mixed', catalogue.CANDIDATES, catalogue.CANDIDATES)},
qw AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS asked FROM (SELECT item_id AS query_id, text FROM benchmark)),
cw AS (SELECT DISTINCT chunk_id, unnest(regexp_extract_all(lower(content), '{WORDS}')) AS given FROM chunks WHERE chunk_id IN (SELECT chunk_id FROM mixed_hits)),
grams AS (SELECT DISTINCT word, unnest(list_transform(range(1, length(word) + 1), lambda i: substr('^' || word || '$', i, 3))) AS gram
          FROM (SELECT asked AS word FROM qw UNION SELECT given FROM cw)),
sizes AS (SELECT word, COUNT(*) AS n FROM grams GROUP BY word),
alike AS (
  SELECT a.word AS asked, b.word AS given, COUNT(*) / sqrt(any_value(x.n) * any_value(y.n)) AS likeness
  FROM (SELECT * FROM grams WHERE word IN (SELECT asked FROM qw)) a JOIN (SELECT * FROM grams WHERE word IN (SELECT given FROM cw)) b USING (gram)
  JOIN sizes x ON x.word = a.word JOIN sizes y ON y.word = b.word GROUP BY 1, 2),
best AS (
  SELECT query_id, chunk_id, asked, MAX(likeness) AS likeness
  FROM mixed_hits JOIN qw USING (query_id) JOIN cw USING (chunk_id) JOIN alike USING (asked, given) GROUP BY 1, 2, 3),
sums AS (SELECT query_id, chunk_id, SUM(likeness) AS total FROM best GROUP BY 1, 2),
judged AS (SELECT h.query_id, h.chunk_id, h.rank AS first_rank, round(coalesce(total, 0) / n, {SCORE_DIGITS}) AS score
  FROM mixed_hits h JOIN (SELECT query_id, COUNT(*) AS n FROM qw GROUP BY 1) USING (query_id) LEFT JOIN sums ON sums.query_id = h.query_id AND sums.chunk_id = h.chunk_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_rank) AS INTEGER) AS rank, chunk_id, score, first_rank
FROM judged QUALIFY rank <= 4"""

EXPANDED = f"""WITH RECURSIVE {SEARCH}, {KEYWORDS}, {_fused('mixed', AT, catalogue.CANDIDATES)},
placed AS (SELECT source_file, t, a, b, CAST(row_number() OVER (PARTITION BY source_file ORDER BY k) - 1 AS INTEGER) AS i FROM spans WHERE trim(substr(t, a + 1, b - a)) <> ''),
found AS (SELECT query_id, rank, source_file, chunk_index AS i FROM mixed_hits JOIN chunks USING (chunk_id)),
edges AS (SELECT *, CASE WHEN i - lag(i) OVER w <= 3 THEN 0 ELSE 1 END AS apart FROM found WINDOW w AS (PARTITION BY query_id, source_file ORDER BY i)),
islands AS (
  SELECT query_id, source_file, MIN(rank) AS best, MIN(i) - 1 AS low, MAX(i) + 1 AS high FROM (
    SELECT *, SUM(apart) OVER (PARTITION BY query_id, source_file ORDER BY i) AS island FROM edges) GROUP BY query_id, source_file, island)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY best) AS INTEGER) AS rank, source_file, 1 AS page_number, MIN(i) AS first_chunk, MAX(i) AS last_chunk,
       trim(substr(any_value(t), MIN(a) + 1, MAX(b) - MIN(a))) AS content
FROM islands JOIN placed USING (source_file) WHERE i BETWEEN low AND high GROUP BY query_id, source_file, low, best"""

DISTINCT_PAGES = f"""WITH RECURSIVE {SEARCH},
firsts AS (
  SELECT query_id, score, chunks.* FROM scored JOIN chunks USING (chunk_id)
  QUALIFY row_number() OVER (PARTITION BY query_id, source_file, page_number ORDER BY score DESC, chunk_id) = 1)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank, source_file, page_number, chunk_index
FROM firsts QUALIFY rank <= 4"""


def _contexts(relevance: str) -> str:
    return f"""contexts AS (
  SELECT item_id AS query_id, COALESCE(string_agg('[' || source_file || ', page ' || page_number || {relevance} || ']' || chr(10) || content,
    chr(10) || chr(10) ORDER BY rank), '{context.NOTHING_FOUND}') AS context, any_value(text) AS question
  FROM benchmark LEFT JOIN hits ON query_id = item_id GROUP BY item_id)"""


CONTEXT = f"WITH RECURSIVE {SEARCH},\n" + _contexts("''") + "\nSELECT query_id, context FROM contexts"
SEARCH_TEXT = f"WITH RECURSIVE {SEARCH},\n" + _contexts("', relevance ' || printf('%.2f', score)") + "\nSELECT query_id, context FROM contexts"
PROMPTS = f"WITH RECURSIVE {SEARCH},\n" + _contexts("''") + f"""
SELECT query_id, question, 0 AS turn, 'system' AS role, '{context.INSTRUCTION}' AS content FROM contexts
UNION ALL
SELECT query_id, question, 1, 'user', 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || question FROM contexts"""

# The sentence of the context that shares most words with the question, the first of several; lines are sentences too.
_WORDS = "list_distinct(regexp_extract_all(lower({}), '[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+'))"
ANSWERS = f"WITH RECURSIVE {SEARCH},\n" + _contexts("''") + f""",
pieces AS (
  SELECT query_id, question, string_split_regex(regexp_replace('Context:' || chr(10) || context || chr(10) || chr(10), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1) || '|\\n+') AS s
  FROM contexts),
sentences AS (SELECT query_id, question, unnest(s) AS s, generate_subscripts(s, 1) AS place FROM pieces),
best AS (
  SELECT query_id, question, arg_max(s, (len(list_intersect({_WORDS.format('s')}, {_WORDS.format('question')})), -place)) AS s FROM sentences GROUP BY ALL)
SELECT query_id, question, array_to_string(list_filter(string_split_regex(s, '\\s+'), lambda w: w <> '')[:{models.MAX_ANSWER_TOKENS}], ' ') AS answer FROM best"""

APPROX = f"""SELECT column_name, row_count, null_count, min_number, max_number, mean, stddev, min_time, max_time, TRUE AS distinct_close, TRUE AS median_close
FROM ({profile_sql('lineitem')})"""

MERGED = f"""SELECT column_name, kind, row_count, null_count, min_number, max_number, mean, stddev, min_time, max_time, value_counts
FROM ({profile_sql('lineitem')})"""

SYNCED = f"""WITH RECURSIVE {chunks_sql(DOCUMENTS)}
SELECT chunk_id, source_file, chunk_index, CASE WHEN lang = 'en' THEN content || ' (revised)' ELSE content END AS content, 384 AS width
FROM chunks JOIN documents ON source_file = 'doc_' || doc_id"""

def _score(a: str, b: str) -> str:
    def length(v: str) -> str:
        return f"(sqrt(list_dot_product({v}, {v})) + {NORM_GUARD})"

    return f"round(list_dot_product({a}, {b}) / {length(a)} / {length(b)}, {SCORE_DIGITS})"


LABELLED = f"""WITH turns AS (SELECT conv_id || ':' || turn AS turn_id, role, text FROM conversations),
{vectors_sql('cv', 'SELECT turn_id AS id, text AS content FROM turns')},
{vectors_sql('qv', 'SELECT item_id AS id, text AS content FROM benchmark')},
cn AS (SELECT id, sqrt(SUM(w * w)) + {NORM_GUARD} AS norm FROM cv GROUP BY id),
qn AS (SELECT id, sqrt(SUM(w * w)) + {NORM_GUARD} AS norm FROM qv GROUP BY id),
scored AS (
  SELECT qv.id AS query_id, cv.id AS turn_id, round(SUM(cv.w * qv.w) / any_value(cn.norm) / any_value(qn.norm), {SCORE_DIGITS}) AS score
  FROM qv JOIN cv ON cv.bucket = qv.bucket JOIN cn ON cn.id = cv.id JOIN qn ON qn.id = qv.id GROUP BY 1, 2),
hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, turn_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, score, role AS label, text FROM hits JOIN turns USING (turn_id) WHERE rank <= 3"""

CLASSIFIED = f"""{STOCK},
rows_in AS (
  SELECT *, 'Product: ' || product_name || ', quantity on hand: ' || quantity_on_hand || ', reorder level: ' || reorder_level AS text
  FROM stock),
{vectors_sql('tv', 'SELECT DISTINCT text AS id, text AS content FROM rows_in')},
ruled AS (
  SELECT DISTINCT text, CASE WHEN quantity_on_hand * 2 <= reorder_level THEN 'urgent' WHEN quantity_on_hand <= reorder_level THEN 'monitor' ELSE 'ok' END AS label
  FROM rows_in),
examples AS (
  SELECT text, label, row_number() OVER (ORDER BY label, place) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY text) AS place FROM ruled) WHERE place <= {catalogue.EXAMPLES}),
known AS MATERIALIZED (SELECT place, label, bucket, w FROM examples JOIN tv ON tv.id = examples.text),
scored AS (SELECT id, place, any_value(label) AS label, round(SUM(tv.w * known.w), {SCORE_DIGITS}) AS score FROM tv JOIN known USING (bucket) GROUP BY id, place),
best AS (SELECT id, arg_max(label, (score, -place)) AS restock_urgency FROM scored GROUP BY id)
SELECT product_name, quantity_on_hand, reorder_level, text, restock_urgency FROM rows_in JOIN best ON id = text"""

VECTORS = "vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
FIRSTS = "firsts AS (SELECT label, MIN(vec_id) AS query_id, arg_min(v, vec_id) AS q FROM vecs GROUP BY label)"

COSINE_TOPK = f"""WITH {VECTORS}
SELECT a.vec_id, a.label, {_score('a.v', 'b.v')} AS score
FROM vecs a JOIN vecs b ON b.vec_id = {catalogue.QUERY_VECTOR} ORDER BY score DESC, a.vec_id LIMIT 4"""


def _planes(width: int = 64) -> str:
    return ", ".join(f"({i}, {plane.tolist()}::DOUBLE[])" for i, plane in enumerate(retrieval._planes(width, retrieval.PLANES, 0)))


def _read(asked: str = f"side.vec_id % 50 = 0 OR side.vec_id = {catalogue.QUERY_VECTOR}") -> str:
    """On which side of the planes vectors lie, and which buckets each question reads."""
    return f"""side AS (SELECT vec_id, i, list_dot_product(v, w) AS s FROM vecs, (VALUES {_planes()}) AS p(i, w)),
home AS (SELECT vec_id, CAST(SUM(CASE WHEN s >= 0 THEN 1 << i ELSE 0 END) AS INTEGER) AS bucket FROM side GROUP BY 1),
nearest AS (
  SELECT vec_id AS query_id, b AS bucket FROM (
    SELECT side.vec_id, CAST(r.b AS INTEGER) AS b, SUM(CASE WHEN (xor(CAST(r.b AS INTEGER), home.bucket) >> i) & 1 = 1 THEN s * s ELSE 0 END) AS cost
    FROM side JOIN home USING (vec_id), range(1 << {retrieval.PLANES}) r(b) WHERE {asked} GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cost, b) <= {retrieval.PROBES})"""


READ = _read()
ANN_TOPK = f"""WITH {VECTORS}, {READ}
SELECT a.vec_id, a.label, {_score('a.v', 'b.v')} AS score
FROM vecs a JOIN home USING (vec_id) JOIN nearest n ON n.query_id = {catalogue.QUERY_VECTOR} AND n.bucket = home.bucket JOIN vecs b ON b.vec_id = n.query_id
ORDER BY score DESC, a.vec_id LIMIT 4"""
ANN_RECALL = f"""WITH {VECTORS}, {FIRSTS}, {_read("side.vec_id % 50 = 0 OR side.vec_id IN (SELECT query_id FROM firsts)")},
ranked AS (
  SELECT q.vec_id AS query_id, a.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_score('a.v', 'q.v')} DESC, a.vec_id) AS rank
  FROM vecs q, vecs a WHERE q.vec_id % 50 = 0),
searched AS (SELECT query_id, least(4, COUNT(*)) AS n FROM firsts JOIN nearest USING (query_id) JOIN home USING (bucket) GROUP BY 1)
SELECT k, "right", hits, "right" >= 0.9 * hits AS recall_holds, questions, returned FROM (
  SELECT k, COUNT(n.bucket) AS "right", COUNT(*) AS hits
  FROM (VALUES (4), (10)) AS x(k) JOIN ranked ON rank <= k JOIN home USING (vec_id) LEFT JOIN nearest n ON n.query_id = ranked.query_id AND n.bucket = home.bucket GROUP BY k),
  (SELECT COUNT(*) AS questions, CAST(SUM(n) AS BIGINT) AS returned FROM searched)"""

CODED = f"""WITH {VECTORS}
SELECT q.vec_id AS query_id, a.vec_id AS hit_id, {_score('a.v', 'q.v')} AS score,
  CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_score('a.v', 'q.v')} DESC, a.vec_id) AS INTEGER) AS rank
FROM vecs q, vecs a WHERE q.vec_id % 50 = 0 QUALIFY rank <= 10"""


def _batch(k: int) -> str:
    return f"""{VECTORS}, {FIRSTS},
scored AS (SELECT query_id, vec_id AS hit_id, vecs.label, {_score('v', 'q')} AS score FROM vecs CROSS JOIN firsts),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, hit_id) AS rank FROM scored QUALIFY rank <= {k})"""


COSINE_BATCH = f"WITH {_batch(4)}\nSELECT query_id, CAST(rank AS INTEGER) AS rank, hit_id, score FROM hits"

LABEL_VOTE = f"""WITH {_batch(9)},
votes AS (SELECT query_id, label, COUNT(*) AS votes, MAX(score) AS best_score FROM hits GROUP BY ALL)
SELECT query_id, label, votes, best_score FROM votes
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, best_score DESC, label) = 1"""

SIMILAR_PAIRS = f"""WITH vecs AS (SELECT MIN(vec_id) AS id, COUNT(*) AS copies, embedding::DOUBLE[] AS v FROM embeddings GROUP BY embedding)
SELECT * FROM (
  SELECT a.id AS left_id, b.id AS right_id, {_score('a.v', 'b.v')} AS score, a.copies AS left_copies, b.copies AS right_copies
  FROM vecs a JOIN vecs b ON a.id < b.id OR a.id = b.id AND a.copies > 1)
WHERE score >= {catalogue.MIN_SCORE}"""

SCORE_PAIRS = f"""WITH {VECTORS}, {FIRSTS}
SELECT query_id AS left_id, vec_id AS right_id, {_score('q', 'v')} AS score FROM vecs JOIN firsts USING (label)"""


def _top_n(agg: str, metric: str) -> str:
    return f"""SELECT o_orderpriority AS group_value, round(CAST({agg}({metric}) AS DOUBLE), 2) AS metric_value FROM orders
GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 5"""


def all_oracles() -> dict[str, str]:
    price = "CAST(o_totalprice AS DECIMAL(18,2))"
    named = {
        "top_selling_products": TOP_SELLING, "sql_top_selling_products": TOP_SELLING,
        "customer_order_history": ORDER_HISTORY, "sql_customer_order_history": ORDER_HISTORY,
        "monthly_revenue": MONTHLY_REVENUE, "sql_monthly_revenue": MONTHLY_REVENUE,
        "low_stock_products": LOW_STOCK, "sql_low_stock_products": LOW_STOCK, "restock_urgency": URGENCY, "restock_classified": CLASSIFIED,
        "filter_by_threshold": "SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem "
                               "WHERE l_extendedprice >= 100000 ORDER BY ALL LIMIT 100",
        "readonly_sql": catalogue.READONLY_QUERY.strip().rstrip(";"),
        "readonly_refusals": "SELECT * FROM (VALUES " + ", ".join(f"('{name}', CAST(NULL AS BIGINT))" for name, _ in catalogue.GATE_CASES if name not in catalogue.GATE_ACCEPTS)
                             + ") AS v(case_name, n) UNION ALL SELECT 'literal', COUNT(*) FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL"
                               " UNION ALL SELECT 'own_name', COUNT(*) FROM customer UNION ALL SELECT 'shadowed_name', COUNT(*) FROM orders",
        "table_inventory": INVENTORY, "table_profile": profile_sql("orders"), "inferred_keys": INFERRED_KEYS,
        "declared_keys": _declared_keys(), "top_values_all_columns": _all_top_values(),
        "value_counts": _top_values("lineitem", "l_quantity"), "monthly_trend": MONTHLY_TREND,
        "chart_columns": f"WITH {CHARTS}\nSELECT * FROM charts", "report_datasets": _report(),
        "question_columns": f"WITH {QUESTIONS}\nSELECT * FROM picked", "example_questions": EXAMPLE_QUESTIONS,
        "schema_text": SCHEMA_TEXT, "data_dictionary": DATA_DICTIONARY, "fk_violations": FK_VIOLATIONS,
        "pk_violations": PK_VIOLATIONS, "snapshot_diff": SNAPSHOT_DIFF, "clean_names": CLEAN_NAMES,
        "csv_reload": CSV_RELOAD, "csv_preview": CSV_PREVIEW,
        "typed_csv": "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders", "row_count_reconciliation": RECONCILIATION, "page_metadata": METADATA,
        "chunk_documents": CHUNKS, "page_chunks": f"WITH RECURSIVE {chunks_sql(PAGES)}\nSELECT * FROM chunks",
        "spaced_chunks": f"WITH RECURSIVE {chunks_sql(DOCUMENTS, min_advance=True)}\nSELECT * FROM chunks",
        "chunk_length_histogram": HISTOGRAM,
        "source_count": f"WITH RECURSIVE {chunks_sql(DOCUMENTS)}\nSELECT COUNT(*) AS chunks, COUNT(DISTINCT source_file) AS source_files FROM chunks",
        "hash_embed": HASH_EMBED, "cosine_topk": COSINE_TOPK, "cosine_topk_batch": COSINE_BATCH, "label_vote": LABEL_VOTE,
        "similar_pairs": SIMILAR_PAIRS, "score_pairs": SCORE_PAIRS, "labelled_ranking": LABELLED,
        "distinct_labels": "SELECT DISTINCT label FROM embeddings", "search_documents": SEARCH_DOCUMENTS, "keyword_search": KEYWORD_SEARCH, "reranked_hits": RERANKED, "expanded_hits": EXPANDED, "hybrid_search": HYBRID_SEARCH,
        "retrieval_quality": RETRIEVAL_QUALITY,
        "ann_topk": ANN_TOPK, "ann_recall": ANN_RECALL, "coded_search": CODED,
        "search_by_text": SEARCH_BY_TEXT, "generate_answer": ANSWERS, "profile_approx": APPROX, "profile_incremental": MERGED, "continuous_sync": SYNCED, "csv_discovery": DISCOVERY, "document_listing": LISTING, "paged_documents": PAGED,
        "onboarded_tables": ONBOARDED, "saved_tables": SAVED, "csv_encoded": ENCODED,
        "profile_json": f"WITH {PROFILE}\nSELECT table_name, row_count, column_name, kind, distinct_count FROM profile",
        "distinct_page_hits": DISTINCT_PAGES, "context_assembly": CONTEXT, "search_text": SEARCH_TEXT,
        "prompt_rows": PROMPTS, "incremental_sync": SYNCED,
        "top_n_group_by_sum": _top_n("SUM", price), "top_n_group_by_avg": _top_n("AVG", price),
        "top_n_group_by_count": _top_n("COUNT", "o_orderkey"), "top_n_group_by_min": _top_n("MIN", price),
        "top_n_group_by_max": _top_n("MAX", price),
    }
    for table in ("lineitem", "orders", "customer", "events", "documents"):
        named[f"profile_{table}"] = profile_sql(table)
    return named
