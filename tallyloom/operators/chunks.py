"""Page rows into overlapping chunk rows with stable keys."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.batches import few_rows
from tallyloom.functions.text import chunk_key, collapse_whitespace, cut_spans

# Characters per chunk, and how many the next chunk repeats.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 150
HISTOGRAM_BINS = 20


# Chunks leave a task in batches of about this many characters, so a long text never has
# all of its chunks in memory. Pages are turned into texts a few at a time.
BATCH_CHARS = 1_000_000
HELD_PAGES = 64


def chunk_pages(pages: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                min_advance: bool = False, with_span: bool = False) -> DataFrame:
    """(chunk_id, source_file, page_number, chunk_index, content) from (source_file,
    page_number, text), and ``start`` and ``stop``, the place of the content in the page's collapsed
    text, if asked for. Pages are independent, so there is no shuffle."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the chunk size")
    names = ["source_file", "page_number", "chunk_index", "content", "start", "stop"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0

        def flush() -> pa.RecordBatch:
            columns = zip(*out)
            types = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in few_rows(batches, HELD_PAGES):
            for file, page, text in zip(*(column.to_pylist() for column in batch.columns)):
                raw = ((a, text[a:b]) for a, b in cut_spans(text or "", size, overlap, min_advance))
                chunks = ((a + len(c) - len(c.lstrip(" ")), c.strip(" ")) for a, c in raw)
                for index, (start, chunk) in enumerate(c for c in chunks if c[1]):
                    out.append((file, page, index, chunk, start, start + len(chunk)))
                    held += len(chunk)
                    if held >= BATCH_CHARS:
                        yield flush()
                        out, held = [], 0
        if out:
            yield flush()

    rows = pages.select("source_file", "page_number", collapse_whitespace(F.col("text")).alias("text")).mapInArrow(
        cut, "source_file STRING, page_number INT, chunk_index INT, content STRING, start BIGINT, stop BIGINT")
    key = chunk_key(F.col("source_file"), F.col("page_number"), F.col("chunk_index"))
    return rows.select(key.alias("chunk_id"), *(names if with_span else names[:4]))


def length_histogram(chunks: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(bin, from_chars, to_chars, n): chunk lengths in equal bins between the shortest and
    the longest. Lengths are counted first; there are at most as many as a chunk has
    characters, which bounds the window."""
    lengths = chunks.groupBy(F.length("content").alias("chars")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    spread = lengths.withColumn("low", F.min("chars").over(every)).withColumn("high", F.max("chars").over(every))
    width = F.greatest((F.col("high") - F.col("low")) / bins, F.lit(1e-9))
    place = F.least(F.floor((F.col("chars") - F.col("low")) / width), F.lit(bins - 1))
    return (
        spread.groupBy(place.cast("int").alias("bin"))
        .agg(F.min("chars").alias("from_chars"), F.max("chars").alias("to_chars"), F.sum("n").alias("n"))
        .orderBy("bin"))


def source_count(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("source_file").alias("source_files"))
