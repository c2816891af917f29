import math
import zlib
from collections import Counter

import numpy as np
from cases import DOCS, ODD, documents
from pyspark.sql import functions as F
from tallyloom.llm import language

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language.identify(docs).where("row.lang is not null and row.n_chars > 100")
    right = got.groupBy("held_out").agg(F.avg((F.col("lang_pred") == F.col("row.lang")).cast("double")).alias("a"), F.count(F.lit(1)).alias("n")).collect()
    assert {r.held_out for r in right} == {True, False} and all(r.a > 0.98 and r.n > 100 for r in right)
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_predictions_use_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    plain = language.predict(docs.select("text"), model).select("row.text", "lang_pred", F.round("score", 5))
    other = language.predict(docs.select("text", F.lit("xx").alias("lang"), F.lit(1).alias("doc_id")).repartition(3), model).select("row.text", "lang_pred", F.round("score", 5))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, other.collect()))


def test_rejection(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    rows = [(1, "съешь же ещё этих мягких французских булок да выпей чаю " * 4), (2, "いろはにほへとちりぬるを" * 10), (3, "123 456 --- !!!"), (4, None), (5, ""), (6, "De.")]
    got = {r.row.doc_id: r for r in language.predict(documents(spark, rows), model).collect()}
    assert all(got[i].rejected for i in (1, 2, 3, 4, 5)) and not got[6].rejected
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and got[1].lang_pred in ("de", "en", "es", "fr")
    clean = language.predict(docs.where("n_chars > 200"), model)
    assert clean.where("rejected").count() <= 0.002 * clean.count()


def test_odd_rows_and_clashing_names(spark):
    df = documents(spark, ODD, clash=True)
    got = language.identify(df)
    assert got.count() == len(ODD) and got.select("row.*").columns == df.columns
    assert language.identify(documents(spark, [])).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None, None, 9)], DOCS)
    row = language.identify(unlabelled).first()
    assert row.lang_pred == "und" and row.score == 0 and row.rejected


def test_null_id_is_held_out(spark):
    got = spark.createDataFrame([(None,), (0,), (1,), (2,)], "id long").select(language.held_out(F.col("id"))).collect()
    assert [r[0] for r in got] == [True] + [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(3)]


def plain_grams(text):
    """Counts of the n-grams of one text: letters are a-z and the bytes of other characters, all else is a gap."""
    data = [32, *(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode()), 32]
    found = Counter()
    for i in range(1, len(data) - 1):
        if data[i] != 32:
            found[bytes(data[i - 1:i + 2])] += 1
            if data[i + 1] != 32:
                found[bytes(data[i:i + 2])] += 1
    buckets = Counter()
    for gram, n in found.items():
        buckets[(int.from_bytes(gram, "big") + len(gram)) * 0x9E3779B1 % 2**32 >> 19] += n
    return buckets


def plain_vector(text, idf):
    v = {b: math.log1p(n) * idf[b] for b, n in plain_grams(text).items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {b: x / norm for b, x in v.items()}


def plain_cosine(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def plain_sum(vectors):
    total = Counter()
    for v in vectors:
        total.update(v)
    return total


def plain_centroids(x, k):
    """Spherical k-means from the row most like all, then each time the row least like those chosen."""
    chosen = [max(x, key=lambda v, mean=plain_sum(x): plain_cosine(v, mean))]
    while len(chosen) < min(k, len(x)):
        chosen.append(min(x, key=lambda v: max(plain_cosine(v, c) for c in chosen)))
    for _ in range(12):
        groups = [[] for _ in chosen]
        for v in x:
            groups[max(range(len(chosen)), key=lambda j: plain_cosine(v, chosen[j]))].append(v)
        for j, group in enumerate(groups):
            total = plain_sum(group) if group else chosen[j]
            norm = math.sqrt(sum(n * n for n in total.values()))
            chosen[j] = {b: n / norm for b, n in total.items()}
    return chosen


def test_query_against_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    docs = frame.withColumn("kept_apart", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) % 4 == 0).collect()
    held_out = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 0 for d in docs}
    known = [d for d in docs if not held_out[d.doc_id] and d.text is not None and d.lang is not None]
    seen = Counter(b for d in known for b in plain_grams(d.text))
    idf = [math.log((1 + len(known)) / (1 + seen[b])) + 1 for b in range(language.BUCKETS)]
    learnt, apart = {}, {}
    for d in known:
        if plain_grams(d.text):
            (apart if d.kept_apart else learnt).setdefault(d.lang, []).append(d.text)
    centroids = [(lang, c) for lang, x in sorted(learnt.items()) for c in plain_centroids([plain_vector(t, idf) for t in x], 3)]
    clean = [(len(plain_grams(t)).bit_length(), max(plain_cosine(plain_vector(t, idf), c) for other, c in centroids if other == lang)) for lang, x in apart.items() for t in x]

    shortest = min(k for k in range(20) if sum(other <= k for other, _ in clean) >= 8)

    def floor(kind):
        own = [n for k, n in clean if k == kind]
        own = own if len(own) >= 8 else [n for k, n in clean if k <= kind]
        return np.quantile(own, 0.01) if len(own) >= 8 else floor(shortest) / 2

    got = {r.doc_id: r for r in language.identify(frame).select("row.doc_id", "lang_pred", "score", "rejected", "held_out").collect()}
    assert len(got) == len(docs) and len(centroids) == 12 and len(clean) > 20
    for d in docs:
        row, grams = got[d.doc_id], plain_grams(d.text or "")
        assert row.held_out == held_out[d.doc_id]
        if not any(ch.isalpha() for ch in d.text or ""):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        score, lang = max((plain_cosine(plain_vector(d.text, idf) if grams else {}, c), lang) for lang, c in centroids)
        assert abs(row.score - score) < 1e-3 and row.lang_pred == lang
        limit = 0.4 * floor(len(grams).bit_length())
        assert abs(score - limit) < 1e-3 or row.rejected == (score < limit and sum(grams.values()) >= 120)


def test_junk_is_rejected_and_clean_text_kept(spark):
    import base64
    import random

    pick = random.Random(3)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs.where(~language.held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), "text", "lang"))
    letters = lambda n: " ".join("".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.randint(2, 9))) for _ in range(n))
    junk = [letters(n) for n in (30, 300, 1000, 5000) for _ in range(10)] + [base64.b64encode(pick.randbytes(n)).decode() for n in (200, 2000, 20000) for _ in range(10)]
    got = language.predict(documents(spark, list(enumerate(junk))), model)
    assert got.count() == got.where("rejected").count() == len(junk)
    clean = language.predict(docs.where("lang is not null and text rlike '[a-z]'"), model)
    assert clean.where("rejected").count() <= 0.001 * clean.count()


def test_few_rows_teach_their_language_too(spark):
    few = spark.createDataFrame([(i, "the cat sat on the mat", "en") for i in range(1)] + [(i, "der Hund lag auf dem Tisch", "de") for i in (7, 8)], "id long, text string, lang string")
    model = language.train(few)
    assert set(model.langs) == {"de", "en"} and not model.floors.any()
