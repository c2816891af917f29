"""Near-duplicate texts by min-max hashing of word shingles, banding, and exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm import wordbytes
from tallyloom.llm.components import components
from tallyloom.session import materialize, spread

# Each permutation gives two values, so 60 of them make 120: 24 bands of 5. A pair at 0.85 shares no band in one
# case out of a million (0.556**24), one at 0.5 shares a band in about half of all cases.
PERMUTATIONS, BANDS = 60, 24
ROWS = 2 * PERMUTATIONS // BANDS
# Members of a bucket compared in one task, and how far the share of equal signature bytes may lie below the similarity
# asked for before a pair is not compared on its full sets: at least four standard deviations.
BLOCK, MARGIN = 256, 0.15

_random = np.random.default_rng(7)
_FACTORS = _random.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _random.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_BAND = _random.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)

SCHEMA = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, signature binary, bands array<long>"


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    s = wordbytes.Slice(texts, wordbytes.LOWER)
    rolling = wordbytes.windows(s.hashes())
    starts = np.arange(len(s.start))
    last = np.repeat(s.first[1:], s.n_words)
    whole = starts == np.repeat(s.first[:-1], s.n_words)  # a text of fewer words is one shingle
    held = (starts + width <= last) | whole
    starts = starts[held]
    hashes = rolling.of(starts, np.minimum(starts + width, last[held]))
    index = np.concatenate([[0], np.cumsum(held)])[s.first]
    return [np.unique(hashes[a:b]) for a, b in zip(index[:-1], index[1:])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum and the maximum under each permutation: a row for each set, none of them empty."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for p in range(PERMUTATIONS):
        x = flat * _FACTORS[p] + _SHIFTS[p]
        out[:, p] = np.minimum.reduceat(x, at)
        out[:, PERMUTATIONS + p] = np.maximum.reduceat(x, at)
    return out


def _signer(width: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = wordbytes.binary(batch.column(2))
            for low, high in wordbytes.slices(texts):
                sets = shingle_sets(texts[low:high], width)
                some = [i for i, x in enumerate(sets) if len(x)]
                digest, marks, bands = np.zeros((len(sets), 2), np.int64), [None] * len(sets), [None] * len(sets)
                if some:
                    values = signatures([sets[i] for i in some])
                    grouped = wordbytes.mixed(values.reshape(len(some), BANDS, ROWS)) * _BAND
                    keys = wordbytes.mixed(grouped.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    small = (wordbytes.mixed(values) >> np.uint64(56)).astype(np.uint8)
                    for k, i in enumerate(some):
                        # Two sums over differently mixed members tell sets apart.
                        digest[i, 0] = wordbytes.mixed(sets[i]).sum(dtype=np.uint64).view(np.int64)
                        digest[i, 1] = wordbytes.mixed(sets[i] * _FACTORS[0] + _SHIFTS[1]).sum(dtype=np.uint64).view(np.int64)
                        marks[i], bands[i] = small[k].tobytes(), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])
    return signed


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star_checker(width: int, percent: int):
    """Rows (leader, its text, cls, its text) to those that are linked. Rows of a leader come together."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=16)
        def of(text: bytes) -> np.ndarray:
            return shingle_sets([text], width)[0]

        for batch in batches:
            held = [_linked(of(x.as_py()), shingle_sets([y.as_py()], width)[0], percent) for x, y in zip(batch.column(1), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(pa.array(held, pa.bool_()))
    return checked


def _block_checker(width: int, percent: int):
    """Members of two blocks of a bucket to links that connect all that are linked: pairs likeliest first, a pair
    already connected is not compared."""
    def checked(table: pa.Table) -> pa.Table:
        cls, comp = table.column("cls").to_numpy(), table.column("comp").to_numpy()
        block, n = table.column("block").to_numpy(), table.column("n_shingles").to_numpy()
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(cls), -1)
        texts = table.column("text")
        root = {c: c for c in comp.tolist()}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        @lru_cache(maxsize=None)
        def of(i: int) -> np.ndarray:
            return shingle_sets([texts[i].as_py()], width)[0]

        left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        if table.column("j")[0].as_py() != table.column("i")[0].as_py() and len(set(block.tolist())) < 2:
            left = left[:0]  # the other block has no member
        pairs = []
        for i in left:
            others = right[(cls[right] > cls[i]) | (block[right] != block[i])]
            others = others[(comp[others] != comp[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
            alike = (marks[others] == marks[i]).mean(axis=1) if len(others) else np.zeros(0)
            likely = alike >= percent / 100 - MARGIN
            pairs += [(s, i, j) for s, j in zip(alike[likely].tolist(), others[likely].tolist())]
        found = []
        for _, i, j in sorted(pairs, key=lambda p: -p[0]):
            x, y = top(comp[i]), top(comp[j])
            if x != y and _linked(of(int(i)), of(j), percent):
                root[x] = y
                found.append((int(cls[i]), int(cls[j])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return checked


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set is its distinct shingles of ``width``
    words (all its words as one if it has fewer), and documents are linked where 100 * intersection >=
    percent * union. component_id is the smallest doc_id reachable over links; kept says it is the own.

    1. Documents of equal sets (128 bits) become one class before anything is compared.
    2. Classes meet where a band of their signatures is equal. Each bucket compares its members with the one that
       has most copies, as originals do, so a bucket of n costs n comparisons.
    3. What a bucket still holds apart is compared in blocks of bounded size, each sent whole to one task, which
       returns as many links as connect its members, not all pairs.
    Links are confirmed on the full sets.

    Null and empty texts have no set and are linked with nothing; a null id is never the smallest of several;
    repeated rows are equal rows of one class. An empty table gives no rows; other columns are ignored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signed = materialize(spread(rows).mapInArrow(_signer(width), SCHEMA), "signed")
    of_set = ["set_a", "set_b", "n_shingles"]
    some = signed.where("n_shingles > 0")
    classes = materialize(some.groupBy(of_set).agg(
        F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("text_hash", "doc_id")).alias("sample"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands")).withColumn("cls", F.monotonically_increasing_id()), "classes")

    members = classes.select(F.explode("bands").alias("band"), "cls", "n_shingles", "copies")
    buckets = (members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("copies", "cls", "n_shingles")).alias("leader"),
                                           F.bit_xor(F.xxhash64("cls")).alias("who"), F.sum("cls").alias("sum"))
               .where("size > 1").groupBy("size", "leader", "who", "sum").agg(F.min("band").alias("band")))  # buckets of the same members once
    shared = materialize(members.join(buckets.select("band", "size", "leader"), "band").select("band", "size", "leader", "cls", "n_shingles"), "shared")
    close = 100 * F.least("n_shingles", "leader.n_shingles") >= percent * F.greatest("n_shingles", "leader.n_shingles")
    stars = materialize(shared.where((F.col("cls") != F.col("leader.cls")) & close).select(F.col("leader.cls").alias("leader"), "cls").distinct(), "stars")

    wanted = (shared.select("cls").distinct().join(classes, "cls")
              .select("cls", F.col("sample.doc_id").alias("_id"), F.col("sample.text_hash").alias("text_hash"), "signature"))
    texts = materialize(rows.join(wanted, (rows.text_hash == wanted.text_hash) & rows.doc_id.eqNullSafe(wanted._id))
                        .groupBy("cls").agg(F.first("text").cast("binary").alias("text"), F.first("signature").alias("signature")), "texts")
    pairs = (stars.join(texts.select("cls", "text"), "cls").join(texts.select(F.col("cls").alias("leader"), F.col("text").alias("led")), "leader")
             .select("leader", "led", "cls", "text"))
    links = materialize(pairs.mapInArrow(_star_checker(width, percent), "a long, b long"), "links")

    found = components(links)
    apart = _apart(shared, found)
    more = apart.join(texts, "cls").groupBy("band", "i", "j").applyInArrow(_block_checker(width, percent), "a long, b long")
    more = materialize(more, "links")
    if not more.isEmpty():
        found = components(links.union(more))

    grouped = classes.select("cls", *of_set, "least_id", "copies").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    smallest = grouped.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("least_id").alias("smallest"))
    moved = (grouped.where((F.col("copies") > 1) | F.col("component").isNotNull()).join(smallest, "component", "left")
             .select(*of_set, F.coalesce("smallest", "least_id").alias("smallest")).withColumn("moved", F.lit(True)))
    component = F.when(F.col("moved"), F.col("smallest")).otherwise(F.col("doc_id"))
    return (signed.join(moved, of_set, "left").withColumn("component_id", component)
            .select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _apart(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, dealt into blocks, once for each pair of blocks. The leader has
    met all others before. Members already connected with it need no comparison with each other, only with the rest."""
    placed = shared.select("band", F.col("leader.cls").alias("leader"), "cls", "n_shingles").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    placed = placed.withColumn("comp", F.coalesce("component", "cls")).drop("component")
    leads = F.col("cls") == F.col("leader")
    other = F.when(~leads, F.col("comp"))
    main = placed.groupBy("band").agg(F.max(F.when(leads, F.col("comp"))).alias("main"), F.min(other).alias("low"), F.max(other).alias("high"))
    split = placed.where(~leads).join(main.where("low < high").select("band", "main"), "band").withColumn("rest", F.col("comp") != F.col("main"))
    sizes = split.groupBy("band").agg(F.ceil(F.count_if("rest") / BLOCK).cast("int").alias("rests"), F.ceil(F.count_if(~F.col("rest")) / BLOCK).cast("int").alias("mains"))
    own = lambda n: F.pmod(F.xxhash64("cls"), F.greatest(n, F.lit(1))).cast("int")
    block = F.when(F.col("rest"), own(F.col("rests"))).otherwise(F.col("rests") + own(F.col("mains")))
    met = F.sequence(F.lit(0), F.when(F.col("rest"), F.col("rests") + F.col("mains") - 1).otherwise(F.col("rests") - 1))
    return (split.join(sizes, "band").withColumn("block", block).withColumn("other", F.explode(met))
            .select("band", "cls", "n_shingles", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
