import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.text import cut_spans
from tallyloom.operators import chunks as ops
from tallyloom.operators.chunks import chunk_pages, length_histogram, source_count


def by_definition(text, size, overlap):
    """Every candidate cut is looked at, in no clever way."""
    spans, a = [], 0
    while a < len(text):
        b = min(a + size, len(text))
        if b < len(text):
            sentence = [p for p in range(a + 1, b - 1) if text[p:p + 2] == ". "]
            word = [p for p in range(a + 1, b) if text[p] == " "]
            b = (sentence or word or [b - 1])[-1] + 1
        spans.append((a, b))
        if b == len(text):
            break
        a = max(b - overlap, a + 1)
    return spans


@settings(max_examples=400, deadline=None)
@given(st.text("ab. ", max_size=80), st.integers(2, 20), st.data())
def test_spans(text, size, data):
    text = " ".join(text.split())
    overlap = data.draw(st.integers(0, size - 1))
    spans = cut_spans(text, size, overlap)
    assert spans == by_definition(text, size, overlap)
    covered = {i for a, b in spans for i in range(a, b)}
    assert covered == set(range(len(text)))
    for (a, b), (c, d) in zip(cut_spans(text, size, overlap, True), cut_spans(text, size, overlap, True)[1:]):
        assert d > b and c > a


def cut(spark, text, size=20, overlap=5, **kw):
    df = spark.createDataFrame([("f.txt", 3, text)], "source_file STRING, page_number INT, text STRING")
    return [r.content for r in chunk_pages(df, size, overlap, **kw).orderBy("chunk_index").collect()]


def test_edges(spark):
    assert cut(spark, "") == cut(spark, "  \n\t ") == cut(spark, None) == []
    assert cut(spark, " short  text\n") == ["short text"]
    assert cut(spark, "x" * 30) == ["x" * 20, "x" * 15]  # no blank in reach: a hard cut
    assert cut(spark, "One is here. Two is there now.")[0] == "One is here."
    assert cut(spark, "a. bcd efghijklmnopqrstuvwxyz")[0] == "a."
    assert cut(spark, "😀" * 30) == ["😀" * 20, "😀" * 15]


def test_keys(spark):
    df = spark.createDataFrame([("f.txt", 3, "x" * 30)], "source_file STRING, page_number INT, text STRING")
    rows = chunk_pages(df, 20, 5).collect()
    assert [(r.chunk_id, r.chunk_index) for r in rows] == [(hashlib.md5(f"f.txt:3:{i}".encode()).hexdigest(), i) for i in range(2)]


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        cut(spark, "x", 10, 10)


def test_a_long_text_leaves_in_several_batches(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(5000))
    whole = cut(spark, text)
    monkeypatch.setattr(ops, "BATCH_CHARS", 100)
    assert cut(spark, text) == whole and len(whole) > 1000


def test_histogram(spark):
    df = spark.createDataFrame([("f", "x" * n) for n in [1, 1, 5, 10, 21]], "source_file STRING, content STRING")
    assert [tuple(r) for r in length_histogram(df, 4).collect()] == [(0, 1, 5, 3), (1, 10, 10, 1), (3, 21, 21, 1)]
    assert [tuple(r) for r in length_histogram(df.where("length(content) = 1")).collect()] == [(0, 1, 1, 2)]
    assert tuple(source_count(df).first()) == (5, 1)


def test_few_pages_and_texts_are_held_at_a_time(spark, monkeypatch):
    from tallyloom.functions import models
    from tallyloom.functions.batches import few_rows

    assert [len(b) for b in few_rows([pa.array(range(5)), pa.array([], pa.int64())], 2)] == [2, 2, 1]
    pages = spark.createDataFrame([(f"f{i}", 1, f"Some words here, number {i}. " * (i % 7 * 20)) for i in range(300)], "source_file string, page_number int, text string").coalesce(1)
    whole = sorted(map(tuple, chunk_pages(pages).collect()))
    monkeypatch.setattr(ops, "HELD_PAGES", 1)
    assert sorted(map(tuple, chunk_pages(pages).collect())) == whole

    class Counting(models.HashingEncoder):
        def encode(self, texts):
            assert len(texts) <= 256, "too many texts at a time"
            return super().encode(texts)

    texts = spark.range(1000).coalesce(1).select(F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    got = [list(r.v) for r in texts.orderBy("text").select(models.embed(F.col("text"), Counting).alias("v")).collect()]
    want = models.HashingEncoder().encode([r.text for r in texts.orderBy("text").collect()])
    assert got == [[float(x) for x in row] for row in want]
