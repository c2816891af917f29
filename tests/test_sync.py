import pytest

from tallyloom.session import names_in
from tallyloom.streaming import sync
from tallyloom.streaming.sync import BATCH, compact, merge_batch, read_index, start_sync, vacuum

SCHEMA = "chunk_id STRING, content STRING, deleted BOOLEAN"


@pytest.fixture
def store(spark, tmp_path):
    class Store:
        index = str(tmp_path / "index")
        runs = 0

        def arrive(self, *rows):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "source"))

        def sync(self):
            query = start_sync(spark, str(tmp_path / "source"), SCHEMA, self.index, str(tmp_path / "checkpoint"))
            query.awaitTermination()
            return sum(p["numInputRows"] for p in query.recentProgress)

        def read(self):
            return {r.chunk_id: r.content for r in read_index(spark, self.index).collect()}

    (tmp_path / "source").mkdir()
    return Store()


def test_only_new_files_are_read_and_the_latest_row_counts(spark, store, tmp_path):
    store.arrive(("a", "one", False), ("b", "two", False))
    assert store.sync() > 0 and store.read() == {"a": "one", "b": "two"}
    assert store.sync() == 0
    store.arrive(("a", "one again", False), ("c", "three", False))
    assert store.sync() > 0 and store.read() == {"a": "one again", "b": "two", "c": "three"}
    store.arrive(("b", None, True))
    store.sync()
    assert store.read() == {"a": "one again", "c": "three"}
    assert all(len(r.embedding) == 384 for r in read_index(spark, store.index).collect())
    target = str(tmp_path / "compacted")
    compact(spark, store.index, target)
    assert {r.chunk_id for r in read_index(spark, target).collect()} == {"a", "c"}


def test_two_versions_in_one_file(spark, store):
    store.arrive(("a", "first", False), ("b", "two", False), ("a", "second", False), ("c", "x", False), ("c", None, True))
    assert store.sync() > 0 and store.read() == {"a": "second", "b": "two"}


def test_running_on_at_an_interval(spark, store, tmp_path):
    store.arrive(("a", "one", False))
    query = start_sync(spark, str(tmp_path / "source"), SCHEMA, store.index, str(tmp_path / "checkpoint"), every="1 second")
    query.processAllAvailable()
    store.arrive(("b", "two", False), ("b", "two", False))
    query.processAllAvailable()
    query.stop()
    assert store.read() == {"a": "one", "b": "two"} and read_index(spark, store.index).count() == 2


def rows(spark, *given):
    return spark.createDataFrame(given, SCHEMA)


def current(spark, index):
    return {r.chunk_id: r.content for r in read_index(spark, index).collect()}


def parts(spark, index):
    state = sync._state(spark, index, sync._commits(spark, index)[-1])
    return {(n, int(b)) for b, batches in state["parts"].items() for n in batches}


def test_a_replayed_batch_counts_once(spark, tmp_path, monkeypatch):
    index = str(tmp_path / "index")
    merge_batch(index, rows(spark, ("a", "one", False), ("b", "two", False)), 0)
    again = rows(spark, ("a", "one again", False), ("c", "three", False))

    def lost(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(sync, "put_text", lost)
        with pytest.raises(RuntimeError):
            merge_batch(index, again, 1)
    assert current(spark, index) == {"a": "one", "b": "two"}  # nobody sees half a batch
    for _ in range(2):  # replayed, then replayed once more after the commit
        merge_batch(index, again, 1)
        assert current(spark, index) == {"a": "one again", "b": "two", "c": "three"}
    assert read_index(spark, index).count() == 3


def test_numbers_of_another_sync_are_refused(spark, tmp_path):
    index = str(tmp_path / "index")
    merge_batch(index, rows(spark, ("a", "one", False)), 0, writer="first")
    with pytest.raises(ValueError, match="another sync"):
        merge_batch(index, rows(spark, ("b", "two", False)), 0, writer="second")
    with pytest.raises(ValueError, match="buckets"):
        merge_batch(index, rows(spark, ("b", "two", False)), 1, buckets=5, writer="first")


def test_reading_needs_no_shuffle_and_new_chunks_rewrite_nothing(spark, tmp_path):
    index = str(tmp_path / "index")
    merge_batch(index, rows(spark, *((f"k{i}", "old", False) for i in range(200))), 0)
    before = parts(spark, index)
    merge_batch(index, rows(spark, *((f"n{i}", "new", False) for i in range(200))), 1)
    assert before < parts(spark, index)
    merge_batch(index, rows(spark, ("k7", "newer", False)), 2)
    after = parts(spark, index)
    assert len(before - after) == 1 and len([n for n, _ in after if n == 2]) == 1  # one part of one bucket is written anew
    plan = read_index(spark, index)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and "Join" not in plan
    want = {**{f"k{i}": "old" for i in range(200)}, **{f"n{i}": "new" for i in range(200)}, "k7": "newer"}
    assert current(spark, index) == want
    assert vacuum(spark, index) == 1 and current(spark, index) == want and names_in(spark, f"{index}/_commits") == ["2.json"]


def test_many_batches_equal_a_plain_dictionary(spark, tmp_path, monkeypatch):
    import random

    monkeypatch.setattr(sync, "MOST_PARTS", 2)
    index, pick, want = str(tmp_path / "index"), random.Random(5), {}
    for number in range(6):
        given = [(f"k{k}", f"{number}", pick.random() < 0.3) for k in pick.sample(range(30), 8)]
        want.update({k: v for k, v, gone in given})
        for k, _, gone in given:
            if gone:
                del want[k]
        merge_batch(index, rows(spark, *given), number, buckets=3)
        assert current(spark, index) == want and read_index(spark, index).count() == len(want)
        assert all(len([1 for _, b in parts(spark, index) if b == bucket]) <= 3 for bucket in range(3))


def test_everything_deleted_and_chunks_without_id(spark, tmp_path):
    index = str(tmp_path / "index")
    merge_batch(index, rows(spark, ("a", "one", False)), 0)
    merge_batch(index, rows(spark, ("a", None, True)), 1)
    assert read_index(spark, index).columns == ["chunk_id", "content", "embedding"] and read_index(spark, index).count() == 0
    for number in (2, 3):
        merge_batch(index, rows(spark, (None, "no id", False)), number)
    assert read_index(spark, index).count() == 2


def test_buckets_by_document(spark, tmp_path):
    index, schema = str(tmp_path / "index"), "chunk_id STRING, doc STRING, content STRING, deleted BOOLEAN"
    first = [(f"{d}-{i}", d, "old", False) for d in "pqrst" for i in range(20)]
    merge_batch(index, spark.createDataFrame(first, schema), 0, bucket_by="doc")
    before = parts(spark, index)
    merge_batch(index, spark.createDataFrame([(f"p-{i}", "p", "new", False) for i in range(10)] + [("q-0", None, None, True)], schema), 1, bucket_by="doc")
    got = current(spark, index)
    assert len(got) == 99 and "q-0" not in got and sum(v == "new" for v in got.values()) == 10
    assert len(before - parts(spark, index)) <= 2
    compact(spark, index, str(tmp_path / "packed"), buckets=2)
    assert current(spark, str(tmp_path / "packed")) == got
    merge_batch(str(tmp_path / "packed"), spark.createDataFrame([("p-0", "p", "newest", False)], schema), 0, buckets=2)
    assert current(spark, str(tmp_path / "packed")) == {**got, "p-0": "newest"}


def test_kept_rows_stay_where_they_are_read(spark, tmp_path, monkeypatch):
    """The keys that go are sent a few buckets at a time; no vector is joined by a shuffle, and texts are dealt without theirs."""
    monkeypatch.setattr(sync, "SENT_KEYS", 5)
    index, written = str(tmp_path / "index"), []
    writer = type(rows(spark, ("a", "x", False)).write)
    monkeypatch.setattr(writer, "partitionBy", lambda self, *names, f=writer.partitionBy: written.append(self._df) or f(self, *names))
    merge_batch(index, rows(spark, *((f"k{i}", "old", False) for i in range(40))), 0, buckets=4)
    merge_batch(index, rows(spark, *((f"k{i}", "new", False) for i in range(0, 40, 2))), 1, buckets=4)
    assert current(spark, index) == {f"k{i}": "old" if i % 2 else "new" for i in range(40)} and read_index(spark, index).count() == 40
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in written]
    assert len(plans) > 3 and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
    for plan in plans:
        if "Exchange hashpartitioning(sync_bucket" in plan:
            assert plan.index("ArrowEvalPython") < plan.index("Exchange hashpartitioning(sync_bucket")
