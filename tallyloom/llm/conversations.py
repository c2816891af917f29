"""Repair conversations at least cost, by Four-Russians block tables.

A conversation is a string of symbols, one a row: its role's initial and whether the row must go or is cut short. What the
cheapest repair of the rest costs from each of four states (nothing yet; after a system turn; after a user turn; after an
assistant turn) is a vector; less its least entry, only a handful of vectors occur. For each of them and each block of
``BLOCK`` symbols the vector on the block's other side is tabled, so a conversation is priced from its end to its start by one
lookup a block. Blocks are then taken from the front: each is expanded backward from the vector behind it to the
vectors between its rows, and traced forward along the edits that keep to the least cost, the ASCII-least of them first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import materialize

# Costs of the edits, and what an undeleted row that is cut short adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 4
# States; a repair may end in NOTHING or ANSWERED. Which role each may take next, as (initial, state afterwards).
NOTHING, SYSTEM, ASKED, ANSWERED = range(4)
NEXT = {NOTHING: ("u", ASKED), SYSTEM: ("u", ASKED), ASKED: ("a", ANSWERED), ANSWERED: ("u", ASKED)}
ROLE = {"u": "user", "a": "assistant"}
# Symbols: no row at all (pads the last block), a row that must go, and the initials sua and any other, whole and cut short.
PAD, GONE, WHOLE, SHORT = 0, 1, 2, 6
INITIALS = "sua"
SYMBOLS = 10
# The character of symbol 0 and another initial, where a conversation is written as a string.
FIRST = 40
FAR = 1 << 20
# Rows of a conversation whose symbols are gathered at once, before the pieces are joined.
CHUNK = 4096

WHITE = " \t\n\x0b\x0c\r"
PAIRS = [(INITIALS.index(a) + 1) * 4 + INITIALS.index(b) + 1 for a, b in ("su", "ua", "au")]
HEAD = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row: (edit, cost, state afterwards)."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED if symbol >= SHORT else 0
        initial = "sua?"[(symbol - WHOLE) % 4]
        wanted, after = NEXT[state]
        if initial == "s" and state == NOTHING:
            out.append(("K", extra, SYSTEM))
        out.append(("K", extra, after) if initial == wanted else ("R", REROLE + extra, after))
    return out


def _inserted(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs when turns may be inserted first; more than two in a row lead nowhere new."""
    for _ in range(2):
        costs = tuple(min(costs[s], INSERT + costs[NEXT[s][1]]) for s in range(4))
    return costs


def _before(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from in front of a row, given those from behind it."""
    if symbol == PAD:
        return costs
    return _inserted(tuple(min(c + costs[after] for _, c, after in _choices(symbol, s)) for s in range(4)))


END = _inserted((0, FAR, FAR, 0))


class Tables:
    """All vectors that occur (least entry 0), and for each and each block the vector in front of it and the
    cost to add. A block's number has its first symbol as the highest digit."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors, at = [END], {END: 0}
        step, add = [], []
        for v in self.vectors:  # grows while it is walked
            for symbol in range(SYMBOLS):
                costs = _before(symbol, v)
                low = min(costs)
                normal = tuple(c - low for c in costs)
                if normal not in at:
                    at[normal] = len(self.vectors)
                    self.vectors.append(normal)
                step.append(at[normal])
                add.append(low)
        self.step, self.add = (np.array(x, np.int32).reshape(-1, SYMBOLS) for x in (step, add))
        front, cost = np.arange(len(self.vectors), dtype=np.int32)[:, None], np.zeros((len(self.vectors), 1), np.int32)
        for _ in range(block):  # one more symbol in front
            front, cost = (np.stack([self.step[front, s] for s in range(SYMBOLS)], 1).reshape(len(front), -1),
                           np.stack([cost + self.add[front, s] for s in range(SYMBOLS)], 1).reshape(len(front), -1))
        # Plain lists are quicker to read one entry at a time.
        self.front, self.cost = front.tolist(), cost.tolist()
        self.traces: dict[tuple[int, int, int], tuple[str, int]] = {}

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The least cost, and the initials of the edits, the ASCII-least of the cheapest."""
        padded = np.frombuffer(symbols + bytes(-len(symbols) % self.block), np.uint8).reshape(-1, self.block)
        blocks = (padded @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))).tolist()
        vector, cost, behind = 0, 0, []
        for b in reversed(blocks):
            behind.append(vector)
            cost += self.cost[vector][b]
            vector = self.front[vector][b]
        cost += self.vectors[vector][NOTHING]
        state, out = NOTHING, []
        for b, v in zip(blocks, reversed(behind)):
            found = self.traces.get((b, v, state))
            if found is None:
                found = self.traces[b, v, state] = self._trace(b, v, state)
            out.append(found[0])
            state = found[1]
        while state not in (NOTHING, ANSWERED):
            out.append("I")
            state = NEXT[state][1]
        return cost, "".join(out)

    def _trace(self, block: int, vector: int, state: int) -> tuple[str, int]:
        """The edits inside a block, and the state behind it, given the vector there. Insertions behind the last row belong to
        the next block or the end."""
        rows = [block // SYMBOLS ** i % SYMBOLS for i in range(self.block - 1, -1, -1)]
        costs = [self.vectors[vector]]  # from in front of each row to the end, up to a constant
        for symbol in reversed(rows):
            costs.append(_before(symbol, costs[-1]))
        costs.reverse()
        out = []
        for symbol, here, then in zip(rows, costs, costs[1:]):
            while symbol != PAD:
                options = [(edit, c + then[after], after, True) for edit, c, after in _choices(symbol, state)]
                options.append(("I", INSERT + here[NEXT[state][1]], NEXT[state][1], False))
                edit, _, state, done = min(o for o in options if o[1] == here[state])
                out.append(edit)
                if done:
                    break
        return "".join(out), state


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage (conv_id, turn, role, text, copy): by a checksum of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its
    text, 2 removes the signs . ! ? from it, 3 repeats it, 4 makes it the user's. Nulls count as one blank, in the key too."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).when(kind == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _end_to_end(place: str, text: str) -> Column:
    """The strings of a group in the order of their places, as one."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda x: x[text]), "").alias(text)


def laid_out(rows: DataFrame) -> DataFrame:
    """Damaged rows with ``place``, which ascends by conversation, turn (nulls first), role and a hash of the text. They are
    range-partitioned in that order, so a long conversation is cut into ranges like many short ones."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.xxhash64("text").asc(), F.col("copy").asc()]
    return materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "turn", F.monotonically_increasing_id().alias("place"), "role", "text"), "turns")


def judged(laid: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, and ``signs``, a character for each row.

    Which of equal rows comes first is the least place per conversation and digest, summed up before the shuffle; it meets its
    row by place, which is unique. Signs are gathered from ``CHUNK`` rows at a time, then from those pieces; no group holds texts."""
    last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
    facts = materialize(laid.select(
        "conv_id", "turn", "place", F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit(INITIALS), F.substring("role", 1, 1))).alias("initial"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?", "")).alias("short"), F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest")), "facts")
    first = facts.where("not blank").groupBy("conv_id", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    found = facts.join(first, "place", "left").withColumn("duplicate", ~F.col("blank") & F.col("first").isNull())
    gone = F.col("blank") | F.col("duplicate")
    found = found.withColumn("truncated", F.col("short") & ~gone)
    # The initial, 0 for others, and the symbol, as one printable character.
    symbol = F.when(gone, GONE).otherwise(F.when(F.col("initial") > 0, F.col("initial") - 1).otherwise(3) + F.when(F.col("short"), SHORT).otherwise(WHOLE))
    signed = found.withColumn("signs", F.char(FIRST + symbol * 4 + F.col("initial")))
    chunks = signed.groupBy("conv_id", (F.col("place") / CHUNK).cast("long").alias("chunk")).agg(
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.min("turn").alias("low"), F.max("turn").alias("high"), _end_to_end("place", "signs"))
    whole = chunks.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.min("low").alias("low"), F.max("high").alias("high"), _end_to_end("chunk", "signs"))
    turns = facts.where("turn is not null").select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("c")).agg(F.count("turn").alias("turns"))
    return whole.join(turns, F.col("conv_id").eqNullSafe(F.col("c")), "left").withColumn(
        "gaps", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)))


def priced(found: DataFrame) -> DataFrame:
    """The judged conversations (``HEAD``), each with its least cost and the edits that reach it."""
    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables()
        for batch in batches:
            illegal, costs, audits = [], [], []
            for signs in batch.column("signs").to_pylist():
                code = np.frombuffer((signs or "").encode(), np.uint8) - FIRST
                initials = code % 4
                pair = initials[:-1] * 4 + initials[1:]
                illegal.append(int(np.count_nonzero(~np.isin(pair, PAIRS))))
                cost, audit = tables.repair((code // 4).tobytes())
                costs.append(cost)
                audits.append(audit)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated")], pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()),
                pa.array(audits, pa.string())], names=[c.split()[0] for c in HEAD.split(", ")])

    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated")]
    return found.select(F.col("conv_id").cast("long").alias("conv_id"), *zero, "signs").mapInArrow(price, HEAD)


class Repaired:
    """The rows of one conversation after their edits, handed over in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def inserted(self) -> Iterator[tuple[str, str]]:
        """The turns that come before the next row, or at the end."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            initial, self.state = NEXT[self.state]
            yield ROLE[initial], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        if edit == "K" and role[:1] == "s":
            self.state = SYSTEM
        else:
            initial, self.state = NEXT[self.state]
            role = ROLE[initial] if edit == "R" else role
        yield role, text


def repaired(laid: DataFrame, heads: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, seat (from 0), role, text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, turns in _conversations(batches):
            seat = 0
            for part in turns:
                if part:
                    yield pa.RecordBatch.from_pydict({"conv_id": pa.array([conv["conv_id"]] * len(part), pa.int64()), "seat": pa.array(range(seat, seat + len(part)), pa.int64()),
                                                      "role": [r for r, _ in part], "text": [t for _, t in part]})
                    seat += len(part)

    return _lined_up(laid, heads).mapInArrow(rows, "conv_id long, seat long, role string, text string")


def hashed(laid: DataFrame, heads: DataFrame) -> DataFrame:
    """The heads with ``repaired_sha256``, of their repaired rows as role:text, joined by line breaks."""
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, turns in _conversations(batches):
            digest, between = hashlib.sha256(), b""
            for part in turns:
                for role, text in part:
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
            out.append({**conv, "repaired_sha256": digest.hexdigest()})
            if len(out) == CHUNK:
                yield _heads(out)
                out = []
        yield _heads(out)

    return _lined_up(laid, heads).mapInArrow(digests, HEAD + ", repaired_sha256 string")


def _heads(rows: list[dict]) -> pa.RecordBatch:
    fields = [c.split() for c in (HEAD + ", repaired_sha256 string").split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.int64() if t == "long" else pa.string()) for n, t in fields], names=[n for n, _ in fields])


def _lined_up(laid: DataFrame, heads: DataFrame) -> DataFrame:
    """Each conversation's head, then its rows in order. A digest of one conversation is one sequence by nature, so its rows pass one
    task, which holds a batch of them and the edits."""
    head = heads.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                        F.struct(*[c for c in heads.columns if c != "conv_id"]).alias("head"))
    rows = laid.select(F.col("conv_id").cast("long").alias("conv_id"), "place", "role", "text")
    return head.unionByName(rows, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "place")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[list[tuple[str, str]]]]]:
    """(head, its repaired rows in parts) of one conversation after the other. The parts must be used up before the next one is asked for."""
    def lines():
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield from zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text", "head")))

    ahead = lines()
    line = next(ahead, None)
    while line is not None:
        conv = {"conv_id": line[0], **line[3]}

        def turns(edits=Repaired(conv["audit"])):
            nonlocal line
            while (line := next(ahead, None)) is not None and line[3] is None:
                yield list(edits.row(line[1], line[2]))
            yield list(edits.inserted())

        yield conv, turns()


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads, laid): a row per conversation with its faults, least cost and edits, and the damaged rows in their order. ``repaired`` and
    ``hashed`` apply the edits.

    A null conv_id is a conversation of its own. Null turns come first, null roles and texts are one blank (a blank text is a fault).
    Equal turns are ordered by role and a hash of the text. Long texts are only ever looked at by row; an empty table gives no rows; other
    columns are ignored. A conversation that damage leaves without rows has zeros and no edits."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    laid = laid_out(damaged(rows))
    found = judged(laid).withColumnRenamed("conv_id", "found")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left")
    return materialize(priced(every), "heads"), laid
