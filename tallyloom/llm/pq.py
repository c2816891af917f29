"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table distances, exact cosines."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.components import components
from tallyloom.session import materialize

# The index is fitted on about SAMPLE distinct vectors, chosen by a hash; all vectors are indexed. Both bounds are
# arguments: a table of billions needs more lists, and so a larger sample.
SAMPLE, MAX_LISTS, SUBSPACES, CODES = 16_384, 1024, 8, 256
# Distances that a step of the index holds at once.
HELD = 4_000_000
# Rows of the largest label in a list, and rows of a list compared at once.
LIST_ROWS, BLOCK = 512, 1024


@dataclass
class Index:
    """For vectors of one dimension: coarse centroids, and for each subspace (a slice of the dimensions) its codewords."""
    centroids: np.ndarray
    books: list[np.ndarray]
    cuts: list[int]

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def encode(self, u: np.ndarray, reach: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Home list, lists to probe, codes, and the length of what the codes leave out, for unit rows.

        A neighbour lies at most ``reach`` away. If it is in another list, the plane between the two centroids lies between the
        two vectors, and their distances to it add up to ``reach`` at most. Pairs are looked for from both sides, so a list is
        probed when its plane is within half of that: one of the two always finds the other."""
        far = squared(u, self.centroids)
        home = np.argmin(far, axis=1)
        apart = np.sqrt(squared(self.centroids, self.centroids))[home]
        plane = (far - far[np.arange(len(u)), home][:, None]) / np.maximum(2 * apart, 1e-12)
        near = plane <= reach * 0.5 + 1e-9
        near[np.arange(len(u)), home] = True
        rest = u - self.centroids[home]
        codes = np.stack([nearest(p, b) for p, b in zip(self.parts(rest), self.books)], axis=1).astype(np.uint8)
        left = sum((((p - b[codes[:, m]]) ** 2).sum(axis=1) for m, (p, b) in enumerate(zip(self.parts(rest), self.books))), np.zeros(len(u)))
        return home, [np.flatnonzero(r) for r in near], codes, np.sqrt(left)

    def table_distances(self, u: np.ndarray, centroid: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from unit rows to coded vectors of a list: a table of distances to the codewords for each
        row and subspace, summed by code."""
        rest = u - self.centroids[centroid]
        return sum((squared(p, b)[:, codes[:, m]] for m, (p, b) in enumerate(zip(self.parts(rest), self.books))), np.zeros((len(u), len(codes))))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T), 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest number first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    step = max(1, HELD // len(c))
    return np.concatenate([np.argmin(squared(x[i:i + step], c), axis=1) for i in range(0, len(x), step)])


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(3).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return c


def fit(sample: np.ndarray, lists: int) -> Index:
    """An index from unit rows."""
    centroids = kmeans(sample, min(lists, len(sample)))
    rest = sample - centroids[nearest(sample, centroids)]
    cuts = [round(i * sample.shape[1] / min(SUBSPACES, sample.shape[1])) for i in range(min(SUBSPACES, sample.shape[1]) + 1)]
    books = [kmeans(rest[:, a:b], min(CODES, len(rest))) for a, b in zip(cuts[:-1], cuts[1:])]
    return Index(centroids, books, cuts)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def usable(v: Column) -> Column:
    """Whether a vector can be compared: there, all numbers finite, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _model(classes: DataFrame, sampled: int, max_lists: int) -> dict[int, tuple]:
    """An index for each dimension of the sample, as plain arrays."""
    total, largest = classes.count(), classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    lists = min(max_lists, max(1, math.ceil(largest / LIST_ROWS)))
    share = F.pmod(F.xxhash64("key_b"), F.lit(1 << 40)) < min(1.0, sampled / max(1, total)) * (1 << 40)
    sample = classes.where(share).orderBy("key_a", "key_b").select("dim", "v").toArrow()
    out = {}
    for dim in sorted(set(sample.column("dim").to_pylist())):
        rows = sample.filter(pc.equal(sample.column("dim"), dim)).column("v")
        index = fit(unit(_matrix(rows, dim)), lists)
        out[dim] = (index.centroids, index.books, index.cuts)
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", sampled: int = SAMPLE, max_lists: int = MAX_LISTS) -> DataFrame:
    """One row per vector: vec_id, label, n_links, component_id, kept. Vectors of equal label (not null) and equal length are
    linked where their cosine in double precision is at least ``least``.

    1. Equal vectors become one class with a count, so copies are never compared.
    2. Each class is coded in its list and sent to the lists it must probe.
    3. A list is compared in blocks of bounded rows. Table distances leave out pairs that cannot be near: the distance to
       the code differs from the true one by at most what the code leaves out, so no pair in a probed list is
       lost. The rest get exact cosines.
    4. A task returns a count for each of its vectors and a spanning forest, never its pairs.
    A pair found from both sides counts once. What can be missed is a neighbour outside the probed lists.

    Vectors that are null, zero, hold nulls or non-finite numbers, or have no label link with nothing. A null id is never
    the smallest of several; rows equal in all but the id are copies, linked with each other, repeated ids
    included. An empty table gives no rows; other columns are ignored."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    # A key of 128 bits stands for a vector.
    rows = rows.withColumns({"ok": usable(F.col("v")) & F.col("label").isNotNull(), "key_a": F.xxhash64("v"), "key_b": F.xxhash64(F.lit(1), "v")})
    key = ["label", "key_a", "key_b"]
    classes = rows.where("ok").groupBy(*key).agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    classes = materialize(classes.withColumn("dim", F.size("v")).withColumn("cls", F.monotonically_increasing_id()), "classes")
    model = classes.sparkSession.sparkContext.broadcast(_model(classes, sampled, max_lists))
    found = materialize(_compared(_coded(classes, model, least), model, least), "partial")

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comps = components(found.where("cls != peer").select(F.col("cls").alias("a"), F.col("peer").alias("b")))
    grouped = classes.select(*key, "cls", "least_id", "copies").join(links, "cls", "left").join(comps.withColumnRenamed("node", "cls"), "cls", "left")
    smallest = grouped.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("least_id").alias("smallest"))
    moved = (grouped.where((F.col("copies") > 1) | F.col("component").isNotNull()).join(smallest, "component", "left")
             .select(*key, F.coalesce("smallest", "least_id").alias("smallest"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    moved = moved.withColumn("ok", F.lit(True))
    component = F.when(F.col("links").isNotNull(), F.col("smallest")).otherwise(F.col("vec_id"))
    return (rows.join(moved, ["ok", *key], "left").withColumn("component_id", component)
            .select("vec_id", "label", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _coded(classes: DataFrame, model, least: float) -> DataFrame:
    """classes with home, probes, codes and rest. A length the sample does not hold has one list and no codes."""
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    extra = "home int, probes array<int>, codes binary, rest double"
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    names = [f.name for f in classes.schema] + [c.split()[0] for c in extra.split(", ")]

    def coded(batches):
        step = max(1, HELD // max([1, *(len(m[0]) for m in model.value.values())]))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            dims = np.array(batch.column("dim"))
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if int(dim) in model.value:
                    home, probes, codes, rest = Index(*model.value[int(dim)]).encode(unit(_matrix(part.column("v"), int(dim))), reach)
                    codes = [c.tobytes() for c in codes]
                else:
                    n = part.num_rows
                    home, probes, codes, rest = np.zeros(n, int), [[0]] * n, [b""] * n, np.full(n, 2.0)
                more = [pa.array(home, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array(codes, pa.binary()), pa.array(rest, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=names)

    return classes.mapInArrow(coded, f"{fields}, {extra}")


def _compared(coded: DataFrame, model, least: float) -> DataFrame:
    """(cls, peer, links): partial counts, and edges that span what is linked."""
    coded = materialize(coded, "coded")
    at = ["label", "dim", "list"]
    probes = F.transform("probes", lambda p: F.struct(p.alias("list"), F.lit(False).alias("base")))
    entry = F.explode(F.concat(probes, F.array(F.struct(F.col("home").alias("list"), F.lit(True).alias("base"))))).alias("e")
    entries = coded.select("label", "dim", entry)
    sizes = entries.groupBy("label", "dim", F.col("e.list").alias("list")).agg(F.count_if("e.base").alias("bases"), F.count_if(~F.col("e.base")).alias("asked"))
    sizes = sizes.where("bases > 0")  # an empty list has nothing to find
    full = coded.select("label", "dim", "cls", "copies", "v", "home", "probes", "codes", "rest", entry).select("*", "e.list", "e.base")
    own, other = F.ceil(F.col("bases") / BLOCK).cast("int"), F.ceil(F.col("asked") / BLOCK).cast("int")
    block = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    spans = lambda n: F.sequence(F.lit(0), n - 1)
    dealt = (full.join(sizes, at)
             .withColumn("i", F.explode(F.when(F.col("base"), spans(other)).otherwise(F.array(block(other)))))
             .withColumn("j", F.explode(F.when(F.col("base"), F.array(block(own))).otherwise(spans(own))))
             .select(*at, "i", "j", "base", "cls", "copies", "v", "home", F.when(F.col("base"), F.col("probes")).alias("probes"),
                     F.when(F.col("base"), F.col("codes")).alias("codes"), "rest"))
    reach = math.sqrt(max(0.0, 2 - 2 * least))

    def compared(table: pa.Table) -> pa.Table:
        base = np.array(table.column("base"))
        dim, here = table.column("dim")[0].as_py(), table.column("list")[0].as_py()
        asked, held = table.filter(pa.array(~base)), table.filter(pa.array(base))
        empty = pa.table({"cls": pa.array([], pa.int64()), "peer": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not asked.num_rows or not held.num_rows:
            return empty
        x, y = (unit(_matrix(t.column("v"), dim)) for t in (asked, held))
        q, b = (t.column("cls").to_numpy() for t in (asked, held))
        nq, nb = (t.column("copies").to_numpy() for t in (asked, held))
        home, rest = asked.column("home").to_numpy(), held.column("rest").to_numpy()
        known = dim in model.value
        if known:
            index = Index(*model.value[dim])
            codes = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(len(b), -1)
        # A row of another list also meets this base in its own list when the base probes that: the list of the
        # smaller number counts the pair.
        probed = {h: np.array([h in p for p in held.column("probes").to_pylist()]) for h in set(home.tolist()) if h < here}
        ids = np.unique(np.concatenate([q, b]))
        iq, ib = np.searchsorted(ids, q), np.searchsorted(ids, b)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for low in range(0, len(q), 256):
            part = slice(low, low + 256)
            near = index.table_distances(x[part], here, codes) <= (reach + rest + 1e-6) ** 2 if known else np.ones((len(x[part]), len(b)), bool)
            inner = home[part] == here
            near[inner] &= q[part][inner][:, None] < b
            for k in np.flatnonzero(~inner):
                if home[low + k] < here:
                    near[k] &= ~probed[home[low + k]]
            some_q, some_b = near.any(axis=1), near.any(axis=0)
            if not some_q.any():
                continue
            r, c = np.flatnonzero(some_q) + low, np.flatnonzero(some_b)
            linked = near[some_q][:, some_b] & (x[r] @ y[c].T >= least)
            np.add.at(links, iq[r], linked @ nb[c])
            np.add.at(links, ib[c], nq[r] @ linked)
            for row, z in zip(r, linked):
                if z.any():
                    together = np.append(ib[c[z]], iq[row])
                    tops = np.unique(root[together])
                    if len(tops) > 1:
                        root[np.isin(root, tops)] = tops[0]
        some = (links > 0) | (root != np.arange(len(ids)))
        return pa.table({"cls": ids[some], "peer": ids[root[some]], "links": links[some]})

    return dealt.groupBy(*at, "i", "j").applyInArrow(compared, "cls long, peer long, links long")
