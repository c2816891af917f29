import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import ODD, documents, words
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SPEC = bpe.load(PATH)
COUNT = bpe.Counter(SPEC["pairs"], SPEC["merged"], SPEC["special"])


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abcehinorst é'<|>\n\t ", max_size=80), st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "\n"]), max_size=8).map("".join)))
def test_same_as_library(text):
    assert COUNT(text) == len(library(text))


def test_counts(spark):
    rows = ODD + [(20, "a<|endoftext|>  <|endoftext|>b"), (21, "tion" * 4000)]
    got = bpe.count_tokens(documents(spark, rows, clash=True), PATH).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(key, got)) == sorted(key((i, len((t or "").encode()), len(library(t)), len(library(t)) > 1024)) for i, t in rows)
    assert bpe.count_tokens(documents(spark, []), PATH).count() == 0


def test_forgetting(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    count = bpe.Counter(SPEC["pairs"], SPEC["merged"], SPEC["special"])
    assert count(words(200, 3)) == len(library(words(200, 3))) and len(count.counts) <= 3


def check(rows, pieces, size=packing.SIZE):
    """Each id in exactly one piece; windows gapless and within their size."""
    whole = {}
    for i, t in rows:
        whole.setdefault(i, []).append(np.array(library(t) + [0], "<u4"))
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == whole.keys()
    for i, docs in whole.items():
        assert sum(p.length for p in by_doc[i]) == sum(map(len, docs))
        for p in by_doc[i]:
            assert p.length > 0 and any(p.doc_tokens == len(d) and zlib.crc32(d[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for d in docs)
        if len(docs) == 1:
            at = 0
            for p in sorted(by_doc[i], key=lambda p: p.start):
                assert p.start == at
                at += p.length
    for ps in by_window.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return [sum(p.length for p in ps) for ps in by_window.values()]


def test_packing(spark):
    rows = [(i, words(20 + 13 * i % 700, i)) for i in range(150)]
    parts = 2
    filled = check(rows, packing.pack(documents(spark, rows).repartition(parts), PATH).collect())
    assert sum(f < packing.SIZE for f in filled) <= parts


def test_packing_odd_rows(spark):
    df = documents(spark, ODD + [(30, "x <|endoftext|>")], clash=True)
    got = packing.pack(df, PATH, with_ids=True).collect()
    check(ODD + [(30, "x <|endoftext|>")], got)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_sum_of_squares_choice():
    """Each choice is the level that makes the sum of squares least, and the state matches the windows."""
    packer = packing.Packer(32, 0)
    rng = np.random.default_rng(1)
    for n in rng.integers(1, 32, 500):
        before = [len(level) for level in packer.open]
        costs = {}
        for h in range(32 - n + 1):
            after = before.copy()
            if h and not before[h]:
                continue
            after[h] -= h > 0
            if h + n < 32:
                after[h + n] += 1
            costs[h] = sum(x * x for x in after[1:])
        least = min(costs.values())
        assert packer.best(int(n)) == max(h for h in costs if costs[h] == least)
        list(packer.add(0, np.zeros(n, "<u4")))
        assert packer.counts[1:32].tolist() == [len(level) for level in packer.open][1:]


@pytest.mark.parametrize("size", [8, 1024])
def test_long_texts_and_sizes(spark, size):
    rows = [(1, words(3000, 1)), (2, words(size, 2)), (3, "")]
    check(rows, packing.pack(documents(spark, rows).coalesce(1), PATH, size=size).collect(), size)


def test_long_runs(spark):
    rows = [(1, "abc"), (2, " " * 2_000_000), (3, "x" + "\n" * 1_000_000 + "y"), (4, "\u3000" * 500_000 + "end"), (5, "a " + " \t\n" * 300_000), (6, "a" * 1_000_000), (7, "lorem ipsum, " * 200_000)]
    check(rows, packing.pack(documents(spark, rows).repartition(2), PATH).collect())
    got = {r.doc_id: r.n_tokens for r in bpe.count_tokens(documents(spark, rows), PATH).collect()}
    assert got == {i: len(library(t)) for i, t in rows}


def test_windows_are_those_of_the_plain_rule(spark):
    """One partition against a list-based version that tries every level and takes the least sum of squares."""
    rows = [(i, words(1 + i * 37 % 400, i)) for i in range(300)]
    got = packing.pack(documents(spark, rows).coalesce(1), PATH, size=64).collect()
    counts, held, want, closed = {}, {}, {}, 0
    number = iter(range(10**9))
    for doc, text in rows:
        left, at = len(library(text)) + 1, 0
        while left >= 64:
            want[doc, at] = (64, next(number), 0)
            left, at = left - 64, at + 64
        if not left:
            continue
        best = min((sum(c * c for c in ({**counts, **change}).values()), -h) for h in range(64 - left, -1, -1) if not h or counts.get(h)
                   for change in [{k: counts.get(k, 0) + d for k, d in ((h, -1), (h + left, 1)) if 0 < k < 64}])
        h = -best[1]
        window = held[h].pop() if h else []
        counts[h] = counts.get(h, 0) - 1
        window.append((doc, at, left))
        if h + left == 64:
            n, offset = next(number), 0
            for d, a, length in window:
                want[d, a] = (length, n, offset)
                offset += length
        else:
            held.setdefault(h + left, []).append(window)
            counts[h + left] = counts.get(h + left, 0) + 1
        counts.pop(0, None)
    placed = {(r.doc_id, r.start): (r.length, r.sequence_id, r.offset) for r in got}
    done = {k: v for k, v in want.items()}
    assert len(done) > 250 and all(placed[k] == v for k, v in done.items())
