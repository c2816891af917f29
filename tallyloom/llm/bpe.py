"""Count byte-pair tokens: a heap of adjacent pairs over a linked list of symbols."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallyloom.session import spread

# Fixed value: how byte-level tokenizer files of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words whose counts a task remembers at once, and the longest of them: some 100 MB at most.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 48


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in such files: itself where it prints, else the
    next free one from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in shown):
        names[chr(256 + i)] = b
    return names


def load(path: str) -> dict:
    """Of a tokenizer file: ``pairs`` (left symbol << 32 | right symbol to rank; the first 256 symbols are the
    bytes), ``merged`` (the symbol that a rank makes), ``tokens`` (bytes to id) and ``special`` (added strings to id)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    names = byte_names()
    to_bytes = lambda t: bytes(names[c] for c in t)
    symbol = {bytes([b]): b for b in range(256)}
    pairs, made = {}, []
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = map(to_bytes, merge if isinstance(merge, list) else merge.split(" "))
        pairs[symbol[left] << 32 | symbol[right]] = rank
        made.append(symbol.setdefault(left + right, len(symbol)))
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = {to_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return {"pairs": pairs, "merged": made, "tokens": tokens, "special": special}


def merged_count(word: bytes, pairs: dict[int, int], merged: list[int]) -> int:
    """Symbols left of a word: its bytes less the merges made, lowest rank first, leftmost first among equals."""
    n = left = len(word)
    symbols, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
    get = pairs.get
    ranks = [get(a << 32 | b, -1) for a, b in zip(word, word[1:])]  # of the pair that starts at each symbol now
    ranks.append(-1)
    heap = [r << 32 | i for i, r in enumerate(ranks) if r >= 0]
    heapify(heap)
    while heap:
        at = heappop(heap)
        i, rank = at & 0xFFFFFFFF, at >> 32
        if ranks[i] != rank:
            continue  # an older pair stood here
        left -= 1
        j = after[i]
        symbols[i] = a = merged[rank]
        ranks[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            ranks[i] = r = get(a << 32 | symbols[k], -1)
            if r >= 0:
                heappush(heap, r << 32 | i)
        else:
            ranks[i] = -1
        k = before[i]
        if k >= 0:
            ranks[k] = r = get(symbols[k] << 32 | a, -1)
            if r >= 0:
                heappush(heap, r << 32 | k)
    return left


class Counts(dict):
    """Tokens of a word, remembered for short ones; forgets all when it holds too many."""

    def __init__(self, pairs: dict[int, int], merged: list[int]):
        super().__init__()
        self.pairs, self.merged = pairs, merged

    def __missing__(self, word: str) -> int:
        n = merged_count(word.encode(), self.pairs, self.merged)
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


class Counter:
    def __init__(self, pairs: dict[int, int], merged: list[int], special: dict[str, int]):
        self.counts, self.words = Counts(pairs, merged), regex.compile(WORDS)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.marks = tuple(special)

    def __call__(self, text: str) -> int:
        parts = self.special.split(text) if any(m in text for m in self.marks) else [text]
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.words.findall(p))) for p in parts)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``path`` names the tokenizer file; the driver reads it and sends its merges (fifty thousand pairs, a size fixed
    by the file). Special strings inside a text count as one token each, as the library has it by default.
    Texts are counted whole, one at a time. Null and empty texts have no tokens; null ids and repeated
    rows are kept; an empty table gives no rows; other columns are ignored."""
    spec = load(path)
    sent = docs.sparkSession.sparkContext.broadcast((spec["pairs"], spec["merged"], spec["special"]))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(*sent.value)
        for batch in batches:
            numbers = [count(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(numbers, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    out = spread(rows).mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
