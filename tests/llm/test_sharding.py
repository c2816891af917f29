import zlib

from cases import ODD, documents, words
from tallyloom.llm import sharding


def check(rows, got, shards, slack=sharding.SLACK):
    assert len(got) == len(rows)
    sizes = [len((t or "").encode()) + 1 for _, t in rows]
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, n, zlib.crc32((t or "").encode())) for (i, t), n in zip(rows, sizes))
    for k in range(shards):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    total = sum(sizes)
    most = max(sizes, default=0) + 2 * slack * total / shards
    for k in range(shards):
        assert abs(sum(r.size for r in got if r.shard == k) - total / shards) <= most


def test_odd_rows_and_clashing_names(spark):
    got = sharding.assign_shards(documents(spark, ODD, clash=True), 4).collect()
    check(ODD, got, 4)


def test_no_rows(spark):
    assert sharding.assign_shards(documents(spark, [])).count() == 0


def test_hot_text_is_spread_and_small_groups_stay_whole(spark):
    rows = [(i, "the hot text " * 5) for i in range(700)] + [(1000 + i, words(12, i // 3)) for i in range(1500)]
    got = sharding.assign_shards(documents(spark, rows).repartition(7), 8).collect()
    check(rows, got, 8)
    text = dict(rows)
    homes = {}
    for r in got:
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    hot = homes.pop("the hot text " * 5)
    assert len(hot) > 1 and all(len(h) == 1 for h in homes.values())
    again = sharding.assign_shards(documents(spark, rows).repartition(3), 8).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_written_shards(spark, tmp_path):
    rows = [(i, words(20, i)) for i in range(60)] + [(None, None), (None, None)]
    placed = sharding.write_shards(documents(spark, rows), str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 62 and placed.count() == 62
    assert {(r.doc_id, r._shard) for r in back.where("doc_id is not null").collect()} == {(r.doc_id, r.shard) for r in placed.where("doc_id is not null").collect()}
