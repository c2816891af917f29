"""Pack token sequences into windows of fixed size, each document where the sum of squares grows least."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.records import stretches
from tallyloom.llm.tokens import Ids

SIZE = 1024
# Pieces written at once.
ROWS = 4096
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Windows of ``size`` tokens. ``counts[h]`` is how many windows are filled to level h (0 < h < size). A piece
    of s tokens goes to the level whose window it makes the sum of counts[h]**2 least; the fullest
    such level among equals, level 0 being a new window.

    Rows (document, first token, ids, tokens of the document, window, offset) come out as windows fill; the
    open ones are at most a few for each level."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.counts = np.zeros(size + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(size)]  # windows by level: [level, pieces]

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        """Whole windows of a long document stand alone; what is left of it is packed."""
        whole = len(ids) - len(ids) % self.size
        for at in range(0, whole, self.size):
            yield from self._closed([(doc, at, ids[at:at + self.size], len(ids))])
        if whole < len(ids):
            yield from self._place((doc, whole, ids[whole:].copy(), len(ids)))

    def _place(self, piece: tuple) -> Iterator[tuple]:
        s = len(piece[2])
        h = self.best(s)
        window = self.open[h].pop() if h else [0, []]
        if h:
            self.counts[h] -= 1
        window[0] += s
        window[1].append(piece)
        if window[0] == self.size:
            yield from self._closed(window[1])
        else:
            self.open[window[0]].append(window)
            self.counts[window[0]] += 1

    def best(self, s: int) -> int:
        left = self.counts[:self.size - s + 1]
        # The sum changes by (counts[h] - 1)**2 - counts[h]**2 + (counts[h + s] + 1)**2 - counts[h + s]**2.
        change = 1 - 2 * left + 2 * self.counts[s:] + 1
        change[-1] = 1 - 2 * left[-1]  # a full window is no longer partial
        impossible = left == 0
        change[impossible] = np.iinfo(np.int64).max
        change[0] = 2 * self.counts[s] + 1  # a new window; nothing leaves a level
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def finish(self) -> Iterator[tuple]:
        """What is still open: the emptiest windows are cut up to fill the fullest, so one at most stays partial."""
        windows = sorted((w for level in self.open for w in level), key=lambda w: w[0])
        low, high = 0, len(windows) - 1
        while low < high:
            taker, giver = windows[high], windows[low]
            doc, start, ids, n = giver[1].pop()
            room = self.size - taker[0]
            if len(ids) > room:
                giver[1].append((doc, start + room, ids[room:], n))
                ids = ids[:room]
            giver[0] -= len(ids)
            taker[0] += len(ids)
            taker[1].append((doc, start, ids, n))
            high -= taker[0] == self.size
            low += giver[0] == 0
        for w in windows:
            if w[0]:
                yield from self._closed(w[1])
        self.__init__(self.size, self.next_id)

    def _closed(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, n in pieces:
            yield doc, start, ids, n, self.next_id, offset
            offset += len(ids)
        self.next_id += 1


def pack(docs: DataFrame, path: str, size: int = SIZE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` if
    asked for. A document is its token ids and ``end_id``. Each partition of the scan packs its own windows, so
    nothing is shuffled and one window a partition stays partial; sequence_id tells them apart.

    Special strings inside a text become their ids, as the library has it by default. Null and empty texts are
    the end id alone; null ids and repeated rows are packed like others; an empty table gives no rows;
    other columns are ignored. A task holds a few MB of texts, or one long text, and the open windows."""
    sent = docs.sparkSession.sparkContext.broadcast(Ids(path))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = sent.value, np.array([end_id], "<u4")
        packer = Packer(size, TaskContext.get().partitionId() << 33)
        for batch in batches:
            docs, texts, rows = batch.column(0).to_pylist(), batch.column(1), []
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for low, high in stretches(sizes):
                found, offsets = ids.encode(texts.slice(low, high - low))
                for doc, a, b in zip(docs[low:high], offsets, offsets[1:]):
                    rows += packer.add(doc, np.concatenate([found[a:b], end]))
                    if len(rows) >= ROWS:
                        yield _batch(rows, with_ids)
                        rows = []
            yield _batch(rows, with_ids)
        yield _batch(list(packer.finish()), with_ids)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(packed, SCHEMA + ", ids array<int>" * with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    long = lambda values: pa.array(values, pa.int64())
    columns = [long([r[0] for r in rows]), long([r[1] for r in rows]), long([len(r[2]) for r in rows]),
               long([zlib.crc32(r[2].tobytes()) for r in rows]), long([r[3] for r in rows]), long([r[4] for r in rows]), long([r[5] for r in rows])]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    if with_ids:
        columns.append(pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)
