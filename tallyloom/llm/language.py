"""Language by the nearest of several centroids per language, over normalised TF-IDF vectors of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.wordbytes import slices
from tallyloom.session import spread

# Hash buckets for n-grams (a power of two), and the lengths of n-grams in bytes.
BITS, LENGTHS = 13, (2, 3)
BUCKETS = 1 << BITS
# Texts turned into vectors at once.
ROWS = 128
# Of the labelled rows sampled, one in so many is kept from the centroids to see how far clean text lies from them.
APART = 4
# A class of length speaks for itself with this many of them.
ENOUGH = 8
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


# What fitting a language returns: a row for each centroid; class and cosine of the rows kept apart are in the first one.
FITTED = {"lang": pa.string(), "centroid": pa.list_(pa.float32()), "kinds": pa.list_(pa.int32()), "near": pa.list_(pa.float64())}


@dataclass
class Model:
    """``idf`` (one number a bucket); a row of ``centroids`` (unit length) and its language; and by class of length the cosine that
    99% of clean text exceeds. Its size follows from the buckets, the clusters and the number of languages."""
    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    floors: np.ndarray = field(default_factory=lambda: np.zeros(BITS + 2))


def counts(texts: list[str]) -> np.ndarray:
    """How often each text holds the n-grams of each bucket. Text is lower-cased, and whatever is no letter
    (ASCII letters, and bytes of other characters) counts as a gap."""
    joined = " ".join(t.lower() for t in texts).encode("utf-8", "replace")
    lengths = np.fromiter((len(t.lower().encode("utf-8", "replace")) for t in texts), np.int64, len(texts))
    data = np.frombuffer(b" " + joined + b"  ", np.uint8)
    data = np.where(_LETTER[data], data, 32).astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths + 1) * BUCKETS  # a text and the gap after it
    out = np.zeros(len(texts) * BUCKETS, np.int64)
    for n in LENGTHS:
        gram = data[:len(row)].copy()
        for k in range(1, n):
            gram = (gram << np.uint32(8)) | data[k:len(row) + k]
        held = (data[1:len(row) + 1] != 32) if n == 3 else (data[:len(row)] != 32) & (data[1:len(row) + 1] != 32)
        bucket = ((gram + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        out += np.bincount(row[held] + bucket[held], minlength=len(out))
    return out.reshape(len(texts), BUCKETS)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length from counts, or zero for a text without n-grams."""
    v = np.log1p(found) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def length_class(found: np.ndarray) -> np.ndarray:
    """Rows of counts by their number of different n-grams: 0, 1, 2 to 3, 4 to 7 and so on. Repeating a text leaves its class."""
    return np.frexp((found > 0).sum(axis=1))[1]


def floors_of(kinds: np.ndarray, near: np.ndarray) -> np.ndarray:
    """By class of length, the cosine that 99% of clean texts of that class exceed. A class with few of them takes those
    of shorter classes too, whose cosines are lower. Where these are few as well, half the cosine of the first class that has
    enough; 0 if none has."""
    out = np.zeros(BITS + 2)
    for k in range(len(out)):
        own = near[kinds == k]
        some = own if len(own) >= ENOUGH else near[kinds <= k]
        out[k] = np.quantile(some, 0.01) if len(some) >= ENOUGH else -1.0
    known = out[out >= 0]
    return np.where(out >= 0, out, known[0] / 2 if len(known) else 0.0)


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the rows farthest apart: unit centroids and each row's centroid."""
    centre = x.mean(axis=0)
    chosen = [x[int(np.argmax(x @ centre))]]
    for _ in range(1, min(k, len(x))):
        chosen.append(x[int(np.argmin(np.max(x @ np.array(chosen).T, axis=1)))])
    c = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, np.argmax(x @ c.T, axis=1)


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    texts = [t.as_py() or "" for t in batch.column(column)]
    for low, high in slices(texts):
        for at in range(low, high, ROWS):
            end = min(high, at + ROWS)
            yield at, end, texts[at:end]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, _, texts in _chunks(batch, 0):
            df += (counts(texts) > 0).sum(axis=0)
            n += len(texts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[n], df]))], names=["bucket", "n"])


def train(rows: DataFrame, per_lang: int = 600, clusters: int = 3) -> Model:
    """Fit on ``rows`` (id, text, lang). Document frequencies come from all of them. Of a language, about ``per_lang`` rows and a third
    as many are sampled by a hash of the id and fitted in one task: those make the centroids, these, which the centroids have
    not seen, the floors. The driver gets one number a bucket, ``clusters`` centroids a language and one cosine a row kept apart.

    Rows without text or language teach nothing; without any rows the model has no centroid."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    totals = spread(rows.select("text")).mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros(BUCKETS + 1)
    for bucket, n in totals.collect():
        df[bucket + 1] = n
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1
    shares = {r.lang: min(1.0, per_lang * APART / (APART - 1) / r.n) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shares:
        return Model(idf, np.zeros((0, BUCKETS), np.float32), [])
    share = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("lang"))
    drawn = F.pmod(F.xxhash64(F.col("id")), F.lit(1_000_000))
    sample = rows.where(drawn < share * 1_000_000).withColumn("apart", drawn % APART == 0)

    def fit(table: pa.Table) -> pa.Table:
        texts, apart = [t.as_py() for t in table.column("text")], np.array(table.column("apart").to_pylist(), bool)
        found = [(vectors(c, idf).astype(np.float32), length_class(c)) for c in (counts(texts[i:i + ROWS]) for i in range(0, len(texts), ROWS))]
        x, kinds = np.concatenate([v for v, _ in found]), np.concatenate([k for _, k in found])
        some = x.any(axis=1)
        x, kinds, apart = x[some], kinds[some], apart[some]
        if apart.all():
            apart = ~apart  # too few rows to keep any apart
        if not len(x):
            return pa.table({name: pa.array([], kind) for name, kind in FITTED.items()})
        c, _ = clustered(x[~apart], clusters)
        near = (x[apart] @ c.T).max(axis=1)
        none = [[]] * (len(c) - 1)
        return pa.table([pa.array([table.column("lang")[0].as_py()] * len(c), pa.string()), pa.array(c.astype(np.float32).tolist(), pa.list_(pa.float32())),
                         pa.array([kinds[apart].tolist(), *none], pa.list_(pa.int32())), pa.array([near.astype(float).tolist(), *none], pa.list_(pa.float64()))], names=list(FITTED))

    found = sample.select("text", "lang", "apart").groupBy("lang").applyInArrow(fit, "lang string, centroid array<float>, kinds array<int>, near array<double>").collect()
    found = sorted(found, key=lambda r: (r.lang, r.centroid))
    kinds, near = (np.array([n for r in found for n in r[name]]) for name in ("kinds", "near"))
    return Model(idf, np.array([r.centroid for r in found], np.float32).reshape(len(found), BUCKETS), [r.lang for r in found], floors_of(kinds, near))


def predict(docs: DataFrame, model: Model, text_col: str = "text", tolerance: float = 0.4, least: int = 120) -> DataFrame:
    """``row`` (all columns given, as a struct), ``lang_pred``, ``score`` (cosine with the nearest centroid, 0 to 1)
    and ``rejected``: whether the text is too far from it. Too far means a cosine under ``tolerance`` times
    the floor of its class of length, which 99% of the clean texts kept apart exceed; so a text must be far outside what
    was learnt, as one in another script, random letters or base64 are. Texts of fewer than ``least`` n-grams say too little to be rejected.

    ``und`` with score 0, and rejected, where the text is null or has no letter, or nothing was learnt. Texts are
    read whole. Repeated rows get equal answers; an empty table gives no rows; names cannot clash."""
    sent = docs.sparkSession.sparkContext.broadcast((model.idf, model.centroids, model.langs, model.floors))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, centroids, names, floors = sent.value
        for batch in batches:
            for low, high, texts in _chunks(batch, 1):
                if names:
                    found = counts(texts)
                    cosines = vectors(found, idf).astype(np.float32) @ centroids.T
                    best = np.argmax(cosines, axis=1)
                    score = np.clip(cosines[np.arange(len(texts)), best].astype(float), 0, 1)
                    langs, far = [names[j] for j in best], (score < tolerance * floors[length_class(found)]) & (found.sum(axis=1) >= least)
                else:
                    langs, score, far = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(langs, pa.string()), pa.array(score), pa.array(far)],
                                                 names=["row", "_lang", "_score", "_far"])

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = spread(docs.select(row)).select("row", F.col(f"row.`{text_col}`").alias("text"))
    out = rows.mapInArrow(predicted, f"row {rows.schema['row'].dataType.simpleString()}, _lang string, _score double, _far boolean")
    readable = F.coalesce(F.col(f"row.`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    return out.select("row", F.when(readable, F.col("_lang")).otherwise("und").alias("lang_pred"),
                      F.when(readable, F.col("_score")).otherwise(0.0).alias("score"), (~readable | F.col("_far")).alias("rejected"))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept from training: fold 0 of the CRC of its id as text. A null id is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit: int) -> DataFrame:
    """Train on the labelled documents that are not held out, predict for all: ``predict``'s columns and ``held_out``."""
    known = docs.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return predict(docs, train(known, **fit), text_col).withColumn("held_out", held_out(F.col(f"row.`{id_col}`")))
