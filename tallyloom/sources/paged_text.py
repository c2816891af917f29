"""Text files with page breaks, read as pages in ranges of bytes.

A file is read by as many tasks as it has ranges, and a task holds one page at a time, so that neither long documents nor
their number matter. A page belongs to the range in which it begins. Pages are numbered from the counts
of the ranges before, for which page breaks alone are counted.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyloom.operators.joins import sent_if_few
from tallyloom.session import materialize

# Fixed value: the byte that ends a page.
BREAK = b"\f"
# Bytes per range, bytes read at a time, and bytes of pages per batch of rows.
RANGE_BYTES, BLOCK, BATCH = 128 << 20, 1 << 20, 8 << 20
COUNTED = "source_file string, part int, pages bigint"
READ = "source_file string, part int, place bigint, text string"


@dataclass
class FileRange(InputPartition):
    path: str
    part: int
    start: int
    end: int


def _blocks(file: pa.NativeFile, size: int) -> Iterator[bytes]:
    while block := file.read(min(size, BLOCK)):
        yield block
        size -= len(block)


class PagedTextReader(DataSourceReader):
    def __init__(self, path: str, suffix: str, range_bytes: int, counted: bool):
        self.path, self.suffix, self.range_bytes, self.counted = path, suffix, range_bytes, counted

    def files(self) -> list[tuple[str, int]]:
        """Name within the folder and size of each file, hidden ones left out."""
        system, root = fs.FileSystem.from_uri(self.path)
        known = system.get_file_info(fs.FileSelector(root, recursive=True))
        named = [(posixpath.relpath(f.path, root), f.size) for f in known if f.type == fs.FileType.File]
        return sorted((name, size) for name, size in named
                      if name.lower().endswith(self.suffix) and not any(part[0] in "._" for part in name.split("/")))

    def partitions(self) -> list[FileRange]:
        step = self.range_bytes
        ranges = [FileRange(name, i, start, min(start + step, size))
                  for name, size in self.files() for i, start in enumerate(range(0, size, step))]
        return ranges or [FileRange("", 0, 0, 0)]

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, root = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(posixpath.join(root, partition.path)) as file:
            yield from self._counts(file, partition) if self.counted else self._pages(file, partition)

    def _counts(self, file: pa.NativeFile, r: FileRange) -> Iterator[pa.RecordBatch]:
        """A page begins at the start of a file and after each break, unless the file ends there."""
        low = max(r.start - 1, 0)
        file.seek(low)
        last = r.end - 1  # a break in the last byte begins a page of the next range, or none
        n = sum(block.count(BREAK) for block in _blocks(file, last - low)) + (r.start == 0)
        yield pa.RecordBatch.from_pydict({"source_file": [r.path], "part": pa.array([r.part], pa.int32()), "pages": [n]})

    def _pages(self, file: pa.NativeFile, r: FileRange) -> Iterator[pa.RecordBatch]:
        at = max(r.start - 1, 0)
        file.seek(at)
        inside = r.start == 0  # else the first page begins after the first break
        page, place, held, weight = [], 0, [], 0
        while block := file.read(BLOCK):
            parts = block.split(BREAK)
            for i, part in enumerate(parts):
                at += len(part)
                if inside:
                    page.append(part)
                if i == len(parts) - 1:
                    break
                at += 1
                if inside:
                    held.append((place, b"".join(page)))
                    place, weight, page = place + 1, weight + len(held[-1][1]), []
                inside = at < r.end
                if not inside:
                    break
            if weight >= BATCH:
                yield self._batch(r, held)
                held, weight = [], 0
            if not inside and at >= r.end:
                break
        if inside and any(page):
            held.append((place, b"".join(page)))
        if held:
            yield self._batch(r, held)

    @staticmethod
    def _batch(r: FileRange, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "source_file": [r.path] * len(held), "part": pa.array([r.part] * len(held), pa.int32()), "place": [place for place, _ in held],
            "text": [text.decode("utf-8", "replace") for _, text in held]})


class PagedText(DataSource):
    """The data source ``paged_text``. Options: path, suffix, range_bytes, and counted, which asks for the pages of each range only."""

    @classmethod
    def name(cls) -> str:
        return "paged_text"

    def _counted(self) -> bool:
        return self.options.get("counted", "false") == "true"

    def schema(self) -> str:
        return COUNTED if self._counted() else READ

    def reader(self, schema) -> PagedTextReader:
        return PagedTextReader(self.options["path"], self.options.get("suffix", ".txt"), int(self.options.get("range_bytes", RANGE_BYTES)), self._counted())


def read_pages(spark: SparkSession, folder: str, suffix: str = ".txt", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, page_number, text): the pages of all files below a folder whose names end in ``suffix``, numbered from 1.

    Pages end at form feeds; what follows the last one is a page unless it is empty, and an empty file has none. Bytes that
    are no UTF-8 are replaced. A page has to fit into a value. Tasks reach the folder through ``pyarrow.fs``."""
    spark.dataSource.register(PagedText)
    rows = spark.read.format("paged_text").options(path=folder, suffix=suffix, range_bytes=str(range_bytes))
    counts = materialize(rows.option("counted", "true").load(), "page-counts")
    before = Window.partitionBy("source_file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_file", "part", F.coalesce(F.sum("pages").over(before), F.lit(0)).alias("before"))  # a row per range
    return rows.option("counted", "false").load().join(sent_if_few(starts), ["source_file", "part"]).select(
        "source_file", (F.col("before") + F.col("place") + 1).alias("page_number"), "text")
