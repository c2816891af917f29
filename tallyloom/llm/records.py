"""Token ids as length-delimited binary records with masked checksums, and an index of their offsets.

A file is a run of frames: the payload's length (8 bytes), the length's checksum (4), the payload, the payload's
checksum (4), all little-endian. A checksum is CRC-32C, turned right by 15 bits and moved by a constant, so that
checksums stored inside payloads stay harmless: the framing of TFRecord files, which their readers understand. A payload
is one byte that is 1 if the document has an id, one that says how many bytes a token id takes (2 if the tokenizer has no id above
65,535, else 4), one that counts the zeros after the last id, a zero, the document's id (8 bytes), and the token ids.

Files ascend by doc_id. Beside them lies the index, a Parquet table with a row per record: part, name, position, doc_id,
at, length, n_tokens, start (ids before it in its file). A reader takes any stretch or any shuffled order of it and seeks.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.tokens import Ids
from tallyloom.llm.wordbytes import SLICE

# Fixed values of the framing: the reversed CRC-32C polynomial and the mask.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
HEAD, TAIL, OWN = 12, 4, 12
# Words of four bytes that a checksum takes in a block; blocks of many records advance side by side.
BLOCK = 256
# Bytes that one task of a reader covers, and that it reads at once.
SPLIT, READ = 64_000_000, 8_000_000
INDEX = "part int, name string, position long, doc_id long, at long, length long, n_tokens long, start long"


class BadRecord(ValueError):
    """A record whose checksum does not fit."""


def _map(images: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A linear map of 32 bits, given by its images of each bit, as tables for the low and the high half."""
    halves = []
    for part in (images[:16], images[16:]):
        table = np.zeros(1 << 16, np.uint32)
        for i, image in enumerate(part):
            table[1 << i:2 << i] = table[:1 << i] ^ image
        halves.append(table)
    return halves[0], halves[1]


def _apply(table: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    return table[0][x & np.uint32(0xFFFF)] ^ table[1][x >> np.uint32(16)]


class Checksums:
    """Masked CRC-32C of many messages at once; each holds a whole number of four-byte words, at least one."""

    def __init__(self):
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        images = bits
        for _ in range(32):
            images = (images >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (images & np.uint32(1)))
        self.word = _map(images)
        images = bits
        for _ in range(BLOCK):
            images = _apply(self.word, images)
        self.block = _map(images)

    def __call__(self, messages: list[bytes]) -> np.ndarray:
        words = np.fromiter((len(m) // 4 for m in messages), np.int64, len(messages))
        blocks = -(-words // BLOCK)
        first = np.cumsum(blocks) - blocks
        # Zeros in front change nothing while the register is zero; starting from ones is the same as turning the first word over.
        room = np.zeros(int(blocks.sum()) * BLOCK, np.uint32)
        begin = (first + blocks) * BLOCK - words
        at = np.arange(int(words.sum())) + np.repeat(begin - np.cumsum(words) + words, words)
        room[at] = np.frombuffer(b"".join(messages), "<u4")
        room[begin] ^= np.uint32(0xFFFFFFFF)
        state = np.zeros(int(blocks.sum()), np.uint32)
        for column in np.ascontiguousarray(room.reshape(-1, BLOCK).T):
            state = _apply(self.word, state ^ column)
        crc = np.zeros(len(messages), np.uint32)
        for step in range(int(blocks.max(initial=0))):
            going = np.flatnonzero(blocks > step)
            crc[going] = _apply(self.block, crc[going]) ^ state[first[going] + step]
        crc ^= np.uint32(0xFFFFFFFF)
        return (crc >> np.uint32(15) | crc << np.uint32(17)) + np.uint32(MASK)


def framed(payloads: list[bytes], checksums: Checksums) -> list[bytes]:
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = checksums(lengths).astype("<u4"), checksums(payloads).astype("<u4")
    return [b"".join((n, h.tobytes(), p, t.tobytes())) for n, h, p, t in zip(lengths, heads, payloads, tails)]


def unframed(frames: list[bytes], checksums: Checksums) -> list[bytes]:
    """The payloads; ``BadRecord`` where a length or a checksum does not fit."""
    payloads = [f[HEAD:-TAIL] for f in frames]
    want = framed(payloads, checksums) if all(len(p) >= OWN and len(p) % 4 == 0 for p in payloads) else None
    if want != frames:
        raise BadRecord("a record is damaged")
    return payloads


def packed(doc: int | None, ids: bytes, width: int) -> bytes:
    """The payload of a document whose ids take ``width`` bytes each."""
    pad = -len(ids) % 4
    return bytes((doc is not None, width, pad, 0)) + (doc or 0).to_bytes(8, "little", signed=True) + ids + bytes(pad)


def unpacked(payload: bytes) -> tuple[int | None, bytes]:
    """The document and its ids as unsigned 32-bit numbers."""
    known, width, pad, _ = payload[:4]
    ids = payload[OWN:len(payload) - pad]
    if width == 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return int.from_bytes(payload[4:OWN], "little", signed=True) if known else None, ids


def stretches(sizes: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold up to ``most`` bytes, or one text."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, "right")))
        yield low, high
        low = high


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, append ``end_id``, write the records under ``path`` and return the index, also kept there.

    Documents are range-partitioned and sorted by id (null ids first, equal ids by a hash of the text, equal rows in any order, so that
    a hot id is cut into ranges too), and a task writes the records of its range into one file under a name of its own. The index
    names the files of tasks that succeeded; what a lost or repeated task has written is named nowhere. A task holds a
    few MB of texts, or one long text.

    Null and empty texts are the end id alone; repeated rows are records of their own; an empty table gives an empty index; other
    columns are ignored. ``path`` is one that executors reach through ``pyarrow.fs`` (a mounted folder, object stores, HDFS)."""
    sent = docs.sparkSession.sparkContext.broadcast(Ids(tokenizer))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name = TaskContext.get().partitionId(), f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.records"
        ids, checksums = sent.value, Checksums()
        width = 2 if max(ids.size, end_id + 1) <= 1 << 16 else 4
        kind, end = f"<u{width}", end_id.to_bytes(width, "little")
        system, root = fs.FileSystem.from_uri(path)
        out, at, position, start = None, 0, 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for low, high in stretches(sizes):
                names = batch.column("doc_id").slice(low, high - low)
                found, offsets = ids.encode(batch.column("text").slice(low, high - low))
                stored = found.astype(kind)
                frames = framed([packed(d, stored[a:b].tobytes() + end, width) for d, a, b in zip(names.to_pylist(), offsets, offsets[1:])], checksums)
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}")
                out.write(b"".join(frames))
                lengths = [len(f) for f in frames]
                starts = [at + x for x in accumulate(lengths, initial=0)]
                counts = (np.diff(offsets) + 1).tolist()
                begun = [start + x for x in accumulate(counts, initial=0)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(frames), pa.int32()), pa.array([name] * len(frames)), pa.array(range(position, position + len(frames)), pa.int64()),
                    names, pa.array(starts[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(counts, pa.int64()), pa.array(begun[:-1], pa.int64())],
                    names=[c.split()[0] for c in INDEX.split(", ")])
                at, position, start = starts[-1], position + len(frames), begun[-1]
        if out is not None:
            out.close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", "text_hash", "row_number"]
    keyed = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("row_number", F.monotonically_increasing_id())
    laid = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    laid.mapInArrow(written, INDEX).write.mode("overwrite").parquet(f"{path}/index")
    return read_index(docs.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str, seed: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every record, read from the files and checked. ``start`` counts the ids of all
    records before it; ``ids`` are the bytes as stored. With ``seed`` the rows come in a random order that the seed fixes.

    The index is small against the files, so it is dealt anew by the bytes it points at: tasks cover ``SPLIT`` bytes each, whole stretches
    in order, or single records in a shuffled read. One row for each file reaches the driver."""
    index = read_index(spark, path)
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.sum("length").alias("bytes")).orderBy("part").collect()
    before = list(zip((t.part for t in totals), accumulate((t.ids for t in totals), initial=0)))
    index = index.join(F.broadcast(spark.createDataFrame(before, "part int, ids_before long")), "part").withColumn("start", F.col("start") + F.col("ids_before"))
    tasks = max(1, math.ceil(sum(t.bytes for t in totals) / SPLIT))
    if seed is None:
        dealt = index.repartition(tasks, "part", F.floor(F.col("at") / SPLIT)).sortWithinPartitions("part", "at")
    else:
        key = F.xxhash64(F.lit(seed), "part", "position")
        dealt = index.withColumn("key", key).repartitionByRange(tasks, "key").sortWithinPartitions("key")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums = Checksums()
        system, root = fs.FileSystem.from_uri(path)
        held, file = None, None
        for batch in batches:
            rows = batch.to_pandas()
            names, ats, lengths = rows["name"].tolist(), rows["at"].tolist(), rows["length"].tolist()
            low = 0
            while low < len(rows):
                high = low + 1
                while high < len(rows) and names[high] == names[low] and ats[high] == ats[high - 1] + lengths[high - 1] and ats[high] - ats[low] < READ:
                    high += 1
                if held != names[low]:
                    held, file = names[low], system.open_input_file(f"{root}/{names[low]}")
                data = file.read_at(ats[high - 1] + lengths[high - 1] - ats[low], ats[low])
                frames = [data[a - ats[low]:a - ats[low] + n] for a, n in zip(ats[low:high], lengths[low:high])]
                payloads = unframed(frames, checksums)
                docs, ids = zip(*map(unpacked, unframed(frames, checksums)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), batch.column("start").slice(low, high - low), pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                low = high

    return dealt.select("name", "at", "length", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
