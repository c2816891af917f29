"""Keep a table of embedded chunks in step with a growing chunk table.

The table is kept by key: a hash of the key says in which bucket a chunk lies, and a bucket is a few parts, each written by
one batch. A batch adds a part to the buckets it touches. Older parts that hold a chunk which comes again are written anew
without it, into the same new part; the others stay as they are. So every stored row is current, and reading neither
groups nor joins.

A file of ``_commits`` names the parts that count after a batch. It appears at once when all of them are written, so readers see a
batch whole or not at all, a batch that failed is written over when it is replayed, and one that was committed is not done twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.models import Encoder, HashingEncoder, embed
from tallyloom.operators.joins import sent_if_few
from tallyloom.session import materialize, names_in, put_text, remove

BATCH, BUCKET = "sync_batch", "sync_bucket"
DELETED = "deleted"
BUCKETS = 32
# A bucket of more parts than this is written anew as one.
MOST_PARTS = 8
# Keys that are sent at a time to the parts they are in.
SENT_KEYS = 500_000


def _commit(index: str, number: int) -> str:
    return f"{index}/_commits/{number}.json"


def _commits(spark: SparkSession, index: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in names_in(spark, f"{index}/_commits") if name.endswith(".json") and not name.startswith("."))


def _state(spark: SparkSession, index: str, number: int) -> dict:
    """What was written down when batch ``number`` was done: schema, bucketing, and the batches whose parts make up each bucket."""
    return json.loads(spark.read.text(_commit(index, number), wholetext=True).first()[0])


def _parts(spark: SparkSession, index: str, schema: T.StructType, parts: list[tuple[int, int]]) -> DataFrame:
    """The rows of (batch, bucket) parts, with both numbers."""
    numbered = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    if not parts:
        return spark.createDataFrame([], numbered)
    paths = [f"{index}/{BATCH}={batch}/{BUCKET}={bucket}" for batch, bucket in parts]
    return spark.read.schema(numbered).option("basePath", index).parquet(*paths)


def _in_bucket(by: str, buckets: int):
    return F.pmod(F.xxhash64(by), F.lit(buckets)).cast("int").alias(BUCKET)


def _few_keys(counts: dict[int, int]) -> list[list[int]]:
    """The buckets, in groups of about SENT_KEYS keys."""
    groups, held = [], 0
    for bucket, n in sorted(counts.items()):
        if not groups or held + n > SENT_KEYS:
            groups, held = [*groups, []], 0
        groups[-1].append(bucket)
        held += n
    return groups


def merge_batch(index: str, batch: DataFrame, number: int, make_encoder: Callable[[], Encoder] = HashingEncoder,
                buckets: int = BUCKETS, bucket_by: str = "chunk_id", writer: str = "") -> None:
    """Bring the table up to date with the rows of one batch (chunk_id, ..., content, and maybe ``deleted``, ``arrived``).

    A chunk that comes more than once counts as its row with the greatest ``arrived``. Rows without a chunk id replace nothing and
    are all kept. Batches are numbered upwards by one ``writer``; what it has committed is left alone, and a number that
    another one has committed is refused, since then numbers do not say what came later."""
    spark = batch.sparkSession
    done = _commits(spark, index)
    if number in done:
        if _state(spark, index, number)["writer"] != writer:
            raise ValueError(f"Batch {number} of {index} was written by another sync: go on from its checkpoint, or from a compacted copy.")
        return
    earlier = [n for n in done if n < number]
    state = _state(spark, index, earlier[-1]) if earlier else {"buckets": buckets, "by": bucket_by, "parts": {}}
    if (state["buckets"], state["by"]) != (buckets, bucket_by):
        raise ValueError(f"{index} has {state['buckets']} buckets by {state['by']}: compact it to change that.")
    parts = {int(bucket): batches for bucket, batches in state["parts"].items()}
    rows = batch if DELETED in batch.columns else batch.withColumn(DELETED, F.lit(False))
    if "arrived" in batch.columns:
        # Keys decide first, so texts are not sorted.
        repeated = batch.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"), F.max("arrived").alias("newest")).where("n > 1")
        repeated = materialize(repeated.select("chunk_id", "newest"), "repeated-chunks")
        rows = rows.join(repeated, "chunk_id", "left").where(F.col("newest").isNull() | (F.col("newest") == F.col("arrived"))).drop("newest", "arrived")
    live = rows.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED).select("*", _in_bucket(bucket_by, buckets))
    # Texts go to their buckets, and get their vectors there.
    fresh = live.hint("rebalance", BUCKET).withColumn("embedding", embed(F.col("content"), make_encoder))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fresh.schema if f.name != BUCKET])
    # A deleted row may lack the column that the bucket comes from, unless that is the key.
    touched = None if bucket_by != "chunk_id" else _in_bucket(bucket_by, buckets)
    keys = materialize(rows.where("chunk_id IS NOT NULL").select("chunk_id", *([touched] if touched is not None else [])), "arrived-chunks")
    hit = sorted(parts) if touched is None else [r[0] for r in keys.select(BUCKET).distinct().collect()]  # at most one row a bucket
    old = _parts(spark, index, schema, [(n, b) for b in hit for n in parts.get(b, ())])
    replaced = materialize(old.select("chunk_id", BATCH, BUCKET).join(keys.select("chunk_id").distinct(), "chunk_id", "left_semi"), "replaced-chunks")
    # At most MOST_PARTS rows a bucket.
    counted = {(r[0], r[1]): r[2] for r in replaced.groupBy(BATCH, BUCKET).agg(F.count(F.lit(1))).collect()}
    again = set(counted) | {(n, b) for b in hit if len(parts.get(b, ())) >= MOST_PARTS for n in parts[b]}
    target = f"{index}/{BATCH}={number}"
    fresh.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    # What is kept of older parts stays where it is read: the keys that go are sent there, those of a few buckets at a time.
    for some in _few_keys({b: sum(counted.get((n, c), 0) for n, c in again if c == b) for _, b in again}):
        gone = sent_if_few(replaced.where(F.col(BUCKET).isin(some)).select("chunk_id"))
        kept = _parts(spark, index, schema, sorted((n, b) for n, b in again if b in some)).join(gone, "chunk_id", "left_anti").drop(BATCH)
        kept.select(fresh.columns).write.mode("append").partitionBy(BUCKET).parquet(target)
    for n, b in again:
        parts[b].remove(n)
    for name in names_in(spark, target):
        if name.startswith(f"{BUCKET}="):
            parts.setdefault(int(name.split("=")[1]), []).append(number)
    put_text(spark, _commit(index, number), json.dumps({
        "schema": schema.jsonValue(), "writer": writer, "buckets": buckets, "by": bucket_by, "parts": {b: n for b, n in sorted(parts.items()) if n}}))


def start_sync(spark: SparkSession, source: str, schema, index: str, checkpoint: str,
               make_encoder: Callable[[], Encoder] = HashingEncoder, every: str | None = None,
               files_per_batch: int = 1000, buckets: int = BUCKETS, bucket_by: str = "chunk_id") -> StreamingQuery:
    """Embed what is new in ``source`` and stop, or with ``every`` keep running at that
    interval. The source holds chunk rows (chunk_id, ..., content); a row with ``deleted``
    true removes its chunk. The file that arrived last counts, by path among files of one moment, and in a file the later row.

    ``buckets`` grows with the table, to some GB each. ``bucket_by`` may name a column that each chunk has one value of, such as
    its document: then what a changed document replaces lies in one bucket."""
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source).select(
        "*", F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index").alias("arrived"))
    writer = changes.writeStream.foreachBatch(
        lambda batch, number: merge_batch(index, batch, number, make_encoder, buckets, bucket_by, checkpoint)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The current chunks with their vectors, as of the last batch committed: a plain scan of its parts."""
    state = _state(spark, index, _commits(spark, index)[-1])
    parts = [(n, int(b)) for b, batches in state["parts"].items() for n in batches]
    return _parts(spark, index, T.StructType.fromJson(state["schema"]), parts).drop(BATCH, BUCKET)


def vacuum(spark: SparkSession, index: str) -> int:
    """Delete the parts that no longer count, and all commits but the last. Readers that started earlier lose their files. Returns
    how many parts went. No sync may run meanwhile."""
    *earlier, last = _commits(spark, index)
    current = {(n, int(b)) for b, batches in _state(spark, index, last)["parts"].items() for n in batches}
    gone = 0
    for batch in (name for name in names_in(spark, index) if name.startswith(f"{BATCH}=")):
        for bucket in (name for name in names_in(spark, f"{index}/{batch}") if name.startswith(f"{BUCKET}=")):
            if (int(batch.split("=")[1]), int(bucket.split("=")[1])) not in current:
                remove(spark, f"{index}/{batch}/{bucket}")
                gone += 1
    for number in earlier:
        remove(spark, _commit(index, number))
    return gone


def compact(spark: SparkSession, index: str, target: str, buckets: int = BUCKETS, bucket_by: str = "chunk_id") -> None:
    """Write the current chunks to another folder, each bucket as one part. A sync that goes on
    there needs a fresh checkpoint, and may have other buckets."""
    rows = read_index(spark, index)
    folder = f"{target}/{BATCH}=-1"
    rows.select("*", _in_bucket(bucket_by, buckets)).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    parts = {int(name.split("=")[1]): [-1] for name in names_in(spark, folder) if name.startswith(f"{BUCKET}=")}
    put_text(spark, _commit(target, -1), json.dumps({
        "schema": rows.schema.jsonValue(), "writer": "", "buckets": buckets, "by": bucket_by, "parts": parts}))
