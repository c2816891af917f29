import pytest
from pyspark.sql import functions as F

from tallyloom.sources import pages


def test_pages_from_bytes(spark, tmp_path):
    (tmp_path / "b.PDF").write_bytes(b"one|two||four")
    (tmp_path / "a.pdf").write_bytes(b"only")
    (tmp_path / "c.txt").write_bytes(b"no")
    docs = pages.list_documents(spark, str(tmp_path), ".pdf")
    got = pages.extract_pages(docs, lambda content: [t or None for t in content.decode().split("|")])
    assert [tuple(r) for r in got.orderBy("source_file", "page_number").collect()] == [
        ("a.pdf", 1, "only"), ("b.PDF", 1, "one"), ("b.PDF", 2, "two"), ("b.PDF", 3, ""), ("b.PDF", 4, "four")]
    with pytest.raises(ValueError):
        pages.list_documents(spark, str(tmp_path), ".docx")


def test_text_and_html(spark):
    df = spark.createDataFrame([(1, "p1\fp2"), (2, None)], "id INT, t STRING")
    got = pages.text_pages(df, F.col("id").cast("string"), F.col("t")).orderBy("source_file", "page_number").collect()
    assert [tuple(r) for r in got] == [("1", 1, "p1"), ("1", 2, "p2"), ("2", 1, "")]
    html = "<html><title> A </title><SCRIPT>x<b>y</SCRIPT><!-- c --><p>1 &lt; 2 &amp;amp;</p></html>"
    df = spark.createDataFrame([("u", html), ("v", '<meta name="author" content="Ann">')], "u STRING, h STRING")
    assert " ".join(pages.html_pages(df, F.col("u"), F.col("h")).first().text.split()) == "A 1 < 2 &amp;"
    meta = {r.source_file: (r.title, r.author) for r in pages.document_metadata(df, F.col("u"), F.col("h")).collect()}
    assert meta == {"u": ("A", pages.NOT_SET), "v": (pages.NOT_SET, "Ann")}
