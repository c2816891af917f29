import hashlib
import re

from cases import ODD, documents, words
from pyspark.sql import functions as F
from tallyloom.llm import mixing


def brute(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for *_, s in rows)
    total = {n: sum(z for z, (*_, s) in zip(size, rows) if s == n) for n in names}
    weight = {n: float(weights[i % len(weights)]) for i, n in enumerate(names)}
    held = {}
    while True:  # what is over its limit stops there, the rest is shared anew
        free = [n for n in names if n not in held]
        level = (share * sum(total.values()) - sum(held.values())) / sum(weight[n] for n in free) if free else 0
        over = [n for n in free if weight[n] * level >= most * total[n]]
        if not over:
            break
        held |= {n: most * total[n] for n in over}
    target = {n: held.get(n, weight[n] * level) for n in names}
    key = lambda i: int(hashlib.md5(f"{'' if i is None else i}:mix".encode()).hexdigest()[:15], 16)
    out = []
    for n in names:
        own = sorted(((key(i), -1 if i is None else i, z) for z, (i, _, s) in zip(size, rows) if s == n))
        epochs = int(target[n] // total[n]) if total[n] else 0
        left = int(target[n] - epochs * total[n])
        for _, i, z in own:
            part = min(z, max(0, left))
            left -= part
            out.append((i, z, total[n], round(target[n], 6), epochs * z + part))
    return sorted(out)


def taken(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def test_against_brute_force(spark):
    rows = [(i, words(5 + i % 50, i), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(400)] + [(1000 + i, words(3, i), None) for i in range(9)]
    want = brute(rows)
    assert taken(mixing.mix(documents(spark, rows).repartition(5))) == want
    assert taken(mixing.mix(documents(spark, rows[::-1]).repartition(2))) == want  # reruns agree
    for n in {r[2] for r in rows}:
        ids = {i for i, _, s in rows if s == n}
        own = [r for r in want if r[0] in ids]
        assert abs(sum(r[4] for r in own) - own[0][3]) < 1 and all(r[4] <= 2 * r[1] for r in own)


def test_odd_rows_and_clashing_names(spark):
    rows = [(i, t, s) for (i, t), s in zip(ODD, ["b", "b", None, "a", "a", "Ω", "", "z", "a", "b", "b", None])]
    assert taken(mixing.mix(documents(spark, rows, clash=True))) == brute(rows)


def test_no_rows_and_no_words(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]


def test_texts_given(spark):
    df = spark.createDataFrame([(" a b\n c ", 3, 7), ("a b", 2, 1), ("a b", 2, 0), ("", 0, 0), (None, 0, 0), ("x  y z", 3, 6)], "t STRING, size LONG, taken LONG")
    got = [r[0] for r in df.select(mixing.repeated(F.col("t"), F.col("size"), F.col("taken"))).collect()]
    assert got[0] == [" a b\n c ", " a b\n c ", " a"] and got[1] == ["a"] and got[5] == ["x  y z", "x  y z"]
    assert all(not g for g in got[2:5])
