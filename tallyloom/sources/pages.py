"""Documents as page rows: (source_file, page_number, text), pages numbered from 1."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: what stands for a title or author that the document does not name.
NOT_SET = "(not set in this document)"

PAGE_BREAK = "\f"
PAGE_SCHEMA = "source_file STRING, page_number INT, text STRING"


def list_documents(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """The documents of a folder with their bytes; ``ValueError`` when there are none."""
    found = spark.read.format("binaryFile").load(folder).where(F.lower("path").endswith(suffix))
    if found.select("path").isEmpty():
        raise ValueError(f"No {suffix} documents in {folder}")
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("source_file"), "content")


def extract_pages(documents: DataFrame, extractor: Callable[[bytes], Iterable[str | None]]) -> DataFrame:
    """Page rows from document bytes, through a function that yields the text of each page
    in order (a PDF reader, say). A page without text yields an empty string."""
    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["source_file"], batch["content"]):
                texts = [t or "" for t in extractor(content)]
                yield pd.DataFrame({
                    "source_file": file, "page_number": range(1, len(texts) + 1), "text": texts})

    return documents.mapInPandas(pages, PAGE_SCHEMA)


def text_pages(documents: DataFrame, file: Column, text: Column) -> DataFrame:
    """Page rows of plain text, split at form feeds."""
    return documents.select(
        file.alias("source_file"), F.posexplode(F.split(F.coalesce(text, F.lit("")), PAGE_BREAK)).alias("at", "text")
    ).select("source_file", (F.col("at") + 1).alias("page_number"), "text")


def html_pages(documents: DataFrame, file: Column, html: Column) -> DataFrame:
    """One page row per HTML document."""
    return documents.select(file.alias("source_file"), F.lit(1).alias("page_number"), html_text(html).alias("text"))


def html_text(html: Column) -> Column:
    """The readable text of an HTML document: no scripts, styles, comments or tags."""
    text = html
    for pattern in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"):
        text = F.regexp_replace(text, pattern, " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def document_metadata(documents: DataFrame, file: Column, html: Column) -> DataFrame:
    """(source_file, title, author), with a fixed text for what is not set."""
    def found(pattern: str) -> Column:
        return F.coalesce(F.nullif(F.trim(F.regexp_extract(html, pattern, 1)), F.lit("")), F.lit(NOT_SET))

    return documents.select(
        file.alias("source_file"), found(r"(?is)<title[^>]*>(.*?)</title>").alias("title"),
        found(r"""(?is)<meta\s+name=["']author["']\s+content=["'](.*?)["']""").alias("author"))
