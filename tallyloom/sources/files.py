"""Folders of CSV files: which to load, how they are encoded, and reading them typed.

A scan over raw lines (``sniff``) finds the encoding of each file and whether quoted
values span lines. Only files that need it are read in multi-line mode, which cannot be
split; all others are read by as many tasks as they have splits.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.identifiers import rename_clean, unique_identifiers
from tallyloom.session import at_once

# Names of files that hold no table, and the wording of why one is left out.
SKIP_WORDS = ("dictionary", "readme", "background", "logo", "data_dict")
NAMED = "name looks non-tabular (matched '%s')"
OVERSIZED = "%.1f MB is over the cap of %s MB"

MEGABYTE = 1024 * 1024
UTF8, CP1252, LATIN1 = "utf-8", "cp1252", "latin-1"
# The two single-byte encodings differ in these characters only.
_C1 = {chr(b): bytes([b]).decode(CP1252, "ignore") for b in range(0x80, 0xA0)}
UNDEFINED_IN_CP1252 = "".join(c for c, meaning in _C1.items() if not meaning)
C1_CHARS = "".join(c for c, meaning in _C1.items() if meaning)
C1_MEANINGS = "".join(_C1.values())


def literal(path: str) -> str:
    """A path that means itself, whatever pattern characters its name holds."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, file, size_mb) of the files in a folder whose name ends in the suffix, in
    either case. File contents are not read."""
    found = spark.read.format("binaryFile").load(folder).select("path", "length")
    return found.select(
        "path", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), (F.col("length") / MEGABYTE).alias("size_mb")
    ).where(F.lower("file").endswith(suffix))


def discover_files(spark: SparkSession, folder: str, explicit: list[str] | None = None,
                   max_mb: float | None = None, include_large: bool = False, suffix: str = ".csv",
                   skip_words: tuple[str, ...] = SKIP_WORDS) -> DataFrame:
    """(path, file, size_mb, kept, reason) of the files of a folder, by name. An explicit
    list is taken as it is; otherwise names that tell of documentation are skipped, then
    files over the size cap, if one is given. Nothing is left out without a row that says why."""
    files = list_files(spark, folder, "" if explicit else suffix)
    if explicit:
        return files.where(F.col("file").isin(explicit)).select(
            "*", F.lit(True).alias("kept"), F.lit(None).cast("string").alias("reason")).orderBy("file")
    word = F.coalesce(*[F.when(F.contains(F.lower("file"), F.lit(w)), F.lit(w)) for w in skip_words], F.lit(None))
    reason = F.when(word.isNotNull(), F.format_string(NAMED, word))
    if max_mb is not None and not include_large:
        reason = reason.when(F.col("size_mb") > max_mb, F.format_string(OVERSIZED, "size_mb", F.lit(f"{max_mb:g}")))
    return files.withColumn("reason", reason).select(
        "path", "file", "size_mb", F.col("reason").isNull().alias("kept"), "reason").orderBy("file")


def sniff(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, encoding, multi_line, lines) per file, from one scan over the raw lines. A
    quoted value that spans lines leaves an odd number of quotes on a line, one of them at
    the edge of a field; a quote mark inside a plain value (5" pipe) does not."""
    raw = F.col("value").cast("binary")
    as_latin1 = F.decode(raw, "ISO-8859-1")
    quotes = F.length(as_latin1) - F.length(F.replace(as_latin1, F.lit('"'), F.lit("")))
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    lines = spark.read.text([literal(p) for p in paths]).select(
        path.alias("path"), F.is_valid_utf8("value").alias("utf8"),
        as_latin1.rlike(f"[{UNDEFINED_IN_CP1252}]").alias("undefined"),
        ((quotes % 2 == 1) & as_latin1.rlike('(^|,)"|"(,|\\s*$)')).alias("odd"),
        (F.trim(as_latin1) != "").alias("filled"))
    encoding = F.when(F.bool_and("utf8"), UTF8).when(F.bool_or("undefined"), LATIN1).otherwise(CP1252)
    return lines.groupBy("path").agg(
        encoding.alias("encoding"), F.bool_or("odd").alias("multi_line"), F.count_if("filled").alias("lines"), F.lit(1).alias("files"))


def sniff_folder(spark: SparkSession, path: str) -> T.Row:
    """The facts of a file, or of a folder of files that make up one table: encoding,
    multi_line, lines and files."""
    facts = sniff(spark, [path]).agg(
        F.max_by("encoding", F.col("encoding") != UTF8).alias("encoding"), F.bool_or("multi_line").alias("multi_line"),
        F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("files")).first()
    return facts if facts.files else T.Row(encoding=UTF8, multi_line=False, lines=0, files=0)


def _from_c1(text: Column) -> Column:
    return F.translate(text, C1_CHARS, C1_MEANINGS)


def read_csv(spark: SparkSession, path: str, encoding: str = UTF8, multi_line: bool = False,
             infer: bool = True) -> DataFrame:
    """A CSV file with a header. Doubled quotes inside quoted values are part of the value."""
    df = spark.read.csv(
        literal(path), header=True, inferSchema=infer, multiLine=multi_line, quote='"', escape='"',
        encoding="UTF-8" if encoding == UTF8 else "ISO-8859-1")
    if encoding != CP1252:
        return df
    names = [c.translate(str.maketrans(C1_CHARS, C1_MEANINGS)) for c in df.columns]
    kept = [_from_c1(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return df.select(*kept).toDF(*names)


def count_csv_rows(spark: SparkSession, path: str, facts) -> int:
    """Data rows of a file or folder, counted apart from the typed load: its filled lines
    less the headers, or parsed as text where values span lines."""
    if not facts.multi_line:
        return max(facts.lines - facts.files, 0)
    return read_csv(spark, path, facts.encoding, True, infer=False).count()


def sniffed(spark: SparkSession, paths: list[str]) -> dict[str, T.Row]:
    """The facts of each file, one row per file."""
    def plain(path: str) -> str:
        return re.sub("^file:/+", "/", path)

    facts = {plain(r.path): r for r in sniff(spark, paths).collect()}
    blank = T.Row(encoding=UTF8, multi_line=False, lines=0, files=1)
    return {p: facts.get(plain(p), blank) for p in paths}


def table_names(files: list[str]) -> list[str]:
    """One table name per file, none twice."""
    return unique_identifiers(f.rsplit(".", 1)[0] if "." in f[1:] else f for f in files)


def skipped(discovered: DataFrame) -> DataFrame:
    """(file, size_mb, reason) of what a load leaves out."""
    return discovered.where("not kept").select("file", "size_mb", "reason")


def preview(spark: SparkSession, discovered: DataFrame) -> DataFrame:
    """What a load would do: (file, table_name, row_count, size_mb, position, source_column,
    clean_column, reason) per column of every kept file, and one row, with the reason, for
    every file left out."""
    found = discovered.collect()
    files = [f for f in found if f.kept]
    if not files:
        raise ValueError("No CSV files to load")
    facts = sniffed(spark, [f.path for f in files])
    rows = []
    for file, table in zip(files, table_names([f.file for f in files])):
        fact = facts[file.path]
        header = read_csv(spark, file.path, fact.encoding, fact.multi_line, infer=False).columns
        n = count_csv_rows(spark, file.path, fact)
        rows += [(file.file, table, n, file.size_mb, i, raw, clean, None)
                 for i, (raw, clean) in enumerate(zip(header, unique_identifiers(header)))]
    rows += [(f.file, None, None, f.size_mb, None, None, None, f.reason) for f in found if not f.kept]
    return spark.createDataFrame(
        rows, "file STRING, table_name STRING, row_count BIGINT, size_mb DOUBLE, position INT,"
              "source_column STRING, clean_column STRING, reason STRING")


def load_csv_folder(spark: SparkSession, discovered: DataFrame) -> dict[str, tuple[DataFrame, int]]:
    """table -> (rows under clean names, row count of the source file)."""
    files = discovered.where("kept").collect()
    if not files:
        raise ValueError("No CSV files to load")
    facts = sniffed(spark, [f.path for f in files])

    def load(file) -> tuple[DataFrame, int]:
        fact = facts[file.path]
        return rename_clean(read_csv(spark, file.path, fact.encoding, fact.multi_line)), count_csv_rows(spark, file.path, fact)

    return dict(zip(table_names([f.file for f in files]), at_once(spark, load, files)))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, blank_as_null: set[str] = frozenset()) -> DataFrame:
    """A CSV file, or a folder of them, under a declared schema. Blank means null only in the listed columns;
    booleans are true for the word true in any case, and false for everything else."""
    facts = sniff_folder(spark, path)
    text = read_csv(spark, path, facts.encoding, facts.multi_line, infer=False)

    def coerced(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            return F.coalesce(F.lower(F.trim(value)) == "true", F.lit(False))
        value = F.nullif(value, F.lit("")) if field.name in blank_as_null else F.coalesce(value, F.lit(""))
        return value.cast(field.dataType)

    return text.select(*[coerced(f).alias(f.name) for f in schema.fields])
