import math
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import models
from tallyloom.operators import chunks, keywords, rerank

TEXTS = ["Red apples and green pears.", "red red red", "the price of pears in Paris", "", None, "Äpfel und Birnen", "apples apples pears", "the the the the", "red apples"]
QUESTIONS = [(1, "red apples?"), (2, "Pears, pears!"), (3, "äpfel"), (4, "nothing known"), (5, ""), (6, None), (7, "the")]


def tables(spark):
    held = spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(TEXTS)], "chunk_id string, content string")
    return held, spark.createDataFrame(QUESTIONS, "query_id int, text string")


def plain(k):
    docs = [re.findall(r"\w+", (t or "").lower()) for t in TEXTS]
    mean = sum(map(len, docs)) / len(docs)
    out = set()
    for q, text in QUESTIONS:
        scores = {}
        for word in set(re.findall(r"\w+", (text or "").lower())):
            df = sum(word in d for d in docs)
            idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
            for i, d in enumerate(docs):
                if tf := d.count(word):
                    scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        best = sorted((-round(s, 9), f"c{i}") for i, s in scores.items())[:k]
        out |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("named", [0, 2000])
def test_keyword_hits(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(keywords, "NAMED", named)
    held, asked = tables(spark)
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    for k in (1, 3):
        assert {tuple(r) for r in keywords.keyword_hits(index, asked, k).collect()} == plain(k)


@pytest.mark.parametrize("sent", [1, 10**6])
def test_postings_are_kept_by_shard(spark, tmp_path, monkeypatch, sent):
    """A row for each word of a shard, not for each of its chunks; a search gives the best of each shard."""
    monkeypatch.setattr(keywords, "SHARD_CHUNKS", 2)
    monkeypatch.setattr(keywords, "SENT_WORDS", sent)
    held, asked = tables(spark)
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    assert index.postings.count() == index.postings.select("term", "shard").distinct().count() and index.shards.count() > 1
    for k in (1, 3):
        assert {tuple(r) for r in keywords.keyword_hits(index, asked, k).collect()} == plain(k)


def test_ids_that_repeat_or_lack(spark, tmp_path):
    """Rows of one id and length are one, those of other lengths add up, and rows without id are found as one."""
    held = spark.createDataFrame([("a", "red pears"), ("a", "red pears"), ("a", "red"), ("b", "red plums here"), (None, "red apples"), (None, "red apples")], "chunk_id string, content string")
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    total, df = index.totals.first(), {r.term: r.df for r in index.terms.collect()}
    assert total.chunks == 6 and total.length == 2.0 and df == {"red": 4, "pears": 1, "plums": 1, "here": 1, "apples": 1}
    score = lambda *parts: sum(math.log(1 + 2.5 / 4.5) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / 2)) for tf, n in parts)
    want = {None: score((2, 2)), "a": score((2, 2), (1, 1)), "b": score((1, 3))}
    got = {r.hit_id: r.score for r in keywords.keyword_hits(index, spark.createDataFrame([(1, "red")], "query_id int, text string"), 9).collect()}
    assert got == {name: pytest.approx(x, abs=1e-8) for name, x in want.items()}


def test_hybrid_hits_are_searched_once(spark, tmp_path):
    held, asked = tables(spark)
    held = held.withColumn("embedding", models.embed(F.col("content")))
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    hits = keywords.hybrid_hits(held, index, asked.withColumn("embedding", models.embed(F.col("text"))), 2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert hits.count() > 0 and "Exchange" not in plan and "Window" not in plan


def test_reads_the_folders_of_its_words(spark, tmp_path):
    held, asked = tables(spark)
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    plan = keywords.keyword_hits(index, asked.where("query_id = 3"))._jdf.queryExecution().toString()
    assert "folder" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in plan and "term" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_fused_ranks(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "query_id int, rank int, hit_id string")
    b = spark.createDataFrame([(1, 1, "y"), (1, 2, "w")], "query_id int, rank int, hit_id string")
    got = keywords.fused({"vector": a, "keyword": b}, 2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(1, 1, "y", round(1 / 62 + 1 / 61, 9), 2, 1), (1, 2, "x", round(1 / 61, 9), 1, None), (2, 1, "z", round(1 / 61, 9), 1, None)]


def test_documents_that_hold_a_passage(spark, tmp_path):
    docs = [("a", "It was the best  of\ntimes, they said"), ("b", "the best of tim"), ("c", "xxit was the best of timesxx"), ("d", None)]
    df = spark.createDataFrame(docs, "source_file string, text string")
    held = df.select(F.concat(F.lit("k"), "source_file").alias("chunk_id"), "source_file", F.col("text").alias("content"))
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    asked = spark.createDataFrame([(1, "it was the best of times"), (2, "was the best\tof times"), (3, "best"), (4, "no such words here")], "query_id int, text string")
    got = {tuple(r) for r in keywords.holding_documents(index, asked, held, df).collect()}
    assert got == {(1, "c"), (2, "a"), (2, "c"), (3, "a"), (3, "b"), (3, "c")}


def test_quality(spark):
    hits = spark.createDataFrame([(1, 1, "n", 0), (1, 2, "a", 2), (1, 3, "a", 1), (2, 1, "b", 1)], "query_id int, rank int, source_file string, grade int")
    relevant = spark.createDataFrame([(1, "a", [2, 1]), (1, "c", [1]), (2, "b", [1]), (3, "d", [2])], "query_id int, source_file string, grades array<int>")
    got = {r.query_id: r for r in keywords.ranking_quality(hits, relevant, 3).collect()}
    ideal = 3 / math.log2(2) + 1 / math.log2(3) + 1 / math.log2(4)
    assert (got[1].found, got[1].known, got[1].recall, got[1].reciprocal_rank) == (1, 2, 0.5, 0.5)
    assert got[1].ndcg == round((3 / math.log2(3) + 1 / math.log2(4)) / ideal, 6)
    assert (got[2].recall, got[2].ndcg) == (1.0, 1.0) and (got[3].recall, got[3].reciprocal_rank, got[3].ndcg) == (0.0, 0.0, 0.0)


def test_expanded_texts(spark):
    text = " ".join(f"Sentence number {i} is here." for i in range(60))
    page = spark.createDataFrame([("f", 1, text), ("g", 1, "short")], "source_file string, page_number int, text string")
    held = chunks.chunk_pages(page, 120, 30, with_span=True)
    assert held.drop("start", "stop").columns == chunks.chunk_pages(page, 120, 30).columns
    rows = {r.chunk_index: r for r in held.where("source_file = 'f'").collect()}
    assert all(text[r.start:r.stop] == r.content for r in rows.values())
    last = max(rows)
    hits = [(1, 1, rows[9]), (1, 2, rows[2]), (1, 3, rows[5]), (1, 4, rows[0]), (2, 1, rows[last])]
    hits = spark.createDataFrame([(q, r, c.chunk_id) for q, r, c in hits] + [(3, 1, held.where("source_file = 'g'").first().chunk_id)], "query_id int, rank int, chunk_id string")
    got = {(r.query_id, r.rank): r for r in rerank.expanded(hits, held).collect()}
    assert {k: (r.first_chunk, r.last_chunk) for k, r in got.items()} == {(1, 1): (8, 10), (1, 2): (0, 6), (2, 1): (last - 1, last), (3, 1): (0, 0)}
    for (q, _), r in got.items():
        assert r.content == (text[rows[r.first_chunk].start:rows[r.last_chunk].stop] if q < 3 else "short")


def test_reranked(spark):
    class Longest:
        def score(self, questions, texts):
            return [float(len(t or "")) for t in texts]

    held, asked = tables(spark)
    candidates = spark.createDataFrame([(1, r, f"c{i}") for r, i in enumerate([7, 8, 0, 3, 4], 1)], "query_id int, rank int, chunk_id string")
    got = [tuple(r) for r in rerank.reranked(candidates, held, asked, 3).orderBy("rank").collect()]
    assert got[0] == (1, 1, "c8", 1.0, 2) and got[1][2] == "c0" and got[1][3] == 1.0 and got[2][3] < 0.5
    assert [r.chunk_id for r in rerank.reranked(candidates, held, asked, 2, Longest).orderBy("rank").collect()] == ["c0", "c7"]


def test_minimum_score(spark, tmp_path):
    held, asked = tables(spark)
    held = held.where("content is not null").withColumn("embedding", models.embed(F.col("content")))
    index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    asked = asked.where("query_id = 2").withColumn("embedding", models.embed(F.col("text")))
    rows = keywords.hybrid_hits(held, index, asked, 9, min_score=0.5).collect()
    assert {r.hit_id for r in rows if r.vector_rank} == {"c6"} or all(r.vector_rank <= 2 for r in rows if r.vector_rank)
    assert {r.hit_id for r in rows if r.keyword_rank} == {"c0", "c2", "c6"}


def test_texts_and_postings_stay_where_they_are_read(spark, tmp_path):
    """Only rows whose id repeats are moved; lists of numbers are as wide as they need, and what is stored are their bytes."""
    asked, moved = tables(spark)[1], []
    held = spark.createDataFrame([(f"c{i:05}", f"w{i % 3} common {'often ' * (300 if i == 7 else 1)}") for i in range(3000)], "chunk_id string, content string").coalesce(1)
    frame, deal = type(held), type(held).repartition
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frame, "repartition", lambda df, *how: moved.append(df.columns) or deal(df, *how))
        index = keywords.write_keyword_index(held, str(tmp_path / "index"))
    assert moved == [["folder", "term", "df"]]
    assert index.shards.count() == 1 and dict(index.postings.dtypes)["places"] == "binary"
    size = {r.term: (r.n, len(r.places), len(r.tfs)) for r in index.postings.collect()}
    assert size["common"] == (3000, 3000, 3000) and size["w0"] == (1000, 1000, 1000) and size["often"] == (3000, 3000, 6000)
    assert {r.term: r.df for r in index.terms.collect()} == {"common": 3000, "often": 3000, "w0": 1000, "w1": 1000, "w2": 1000}
    got = keywords.keyword_hits(index, spark.createDataFrame([(1, "often w2 unknown")], "query_id int, text string"), 2).collect()
    assert [r.hit_id for r in got] == ["c00002", "c00005"]
    assert keywords.keyword_hits(index, asked, 2).count() == 0


def test_packed_numbers():
    lists = [[0], [255, 1], [256, 0, 3], [70_000, 1, 65_536], [65_535]]
    sizes = keywords.np.array([len(x) for x in lists])
    packed = keywords._packed(keywords.np.concatenate(lists), keywords.np.cumsum(sizes) - sizes)
    assert [len(x) for x in packed.to_pylist()] == [1, 2, 6, 12, 2]
    assert keywords._unpacked(packed, sizes).tolist() == sum(lists, [])
    assert keywords._places(packed.slice(1, 2), sizes[1:3]).tolist() == [255, 256, 256, 256, 259]


def test_some_ids_repeat(spark, tmp_path, monkeypatch):
    """Rows that repeat an id lie in other shards than the rest, and all are found."""
    monkeypatch.setattr(keywords, "SHARD_CHUNKS", 3)
    rows = [(f"c{i}", f"red {'plum ' * (i % 4)}") for i in range(20)] + [("c3", "red"), ("c4", "red plum"), (None, "red"), (None, "red fig")]
    index = keywords.write_keyword_index(spark.createDataFrame(rows, "chunk_id string, content string"), str(tmp_path / "index"))
    assert index.totals.first().chunks == 24 and {r.term: r.df for r in index.terms.collect()} == {"red": 24, "plum": 16, "fig": 1}
    got = keywords.keyword_hits(index, spark.createDataFrame([(1, "red")], "query_id int, text string"), 30).collect()
    assert len(got) == 21 and {r.hit_id for r in got[:3]} == {None, "c3", "c4"}
    shards = [(r.shard, r.hit_ids) for r in index.shards.collect()]
    assert {x for s, ids in shards if s < 0 for x in ids} == {None, "c3", "c4"} and len({s for s, _ in shards}) == len(shards)
