import random
import re

import numpy as np
import pytest
from cases import ODD, documents, words
from tallyloom.llm import minhash
from tallyloom.llm.components import components


def brute(rows, width, percent):
    """{(id, text): (set size, component)} by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = sorted(set(rows), key=repr)
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * min(len(sets[i]), len(sets[j])) >= percent * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    root[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    least = {k: min((x for x in g if x is not None), default=None) for k, g in groups.items()}
    return sorted((repr(rows[i][0]), len(sets[i]), repr(least[top(i)]), rows[i][0] == least[top(i)]) for i in range(len(rows)))


def found(df):
    return sorted({(repr(r.doc_id), r.text_hash, r.n_shingles, repr(r.component_id), r.kept) for r in df.collect()})


def same(spark, rows, width=3, percent=85, clash=False):
    df = minhash.near_duplicates(documents(spark, rows, clash).repartition(4), width, percent)
    got = found(df)
    assert sorted((a, n, c, k) for a, _, n, c, k in got) == brute(rows, width, percent)
    return df


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_copies(spark, width, percent):
    rows, n = [], 0
    for g in range(30):
        base = words(150 + g, g)
        for k in range(6):
            rows.append((1000 - n, edited(base, k, 100 * g + k).upper() if k % 2 else edited(base, k, 100 * g + k)))
            n += 1
    rows += [(2000 + i, words(120, 900 + i)) for i in range(60)]
    same(spark, rows, width, percent)


def test_large_group_over_blocks(spark, monkeypatch):
    """Copies, near copies linked only through each other, and near misses, in buckets of several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    base = words(200, 1)
    rows = [(i, base) for i in range(50, 80)] + [(100 + i, edited(base, 1 + i % 9, i)) for i in range(120)]
    chain = words(300, 77)
    for i in range(25):
        chain = edited(chain, 4, 500 + i)
        rows.append((400 - i, chain))
    same(spark, rows)


def test_odd_rows_and_clashing_names(spark):
    rows = ODD + [(40, "One two"), (39, "one  TWO"), (41, "two one"), (42, "a b c"), (43, "a b c"), (None, "a b c")]
    df = same(spark, rows, clash=True)
    assert df.count() == len(rows)
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_signatures_estimate():
    """Equal values in min-max signatures estimate the Jaccard similarity, with no bias and small variance."""
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(150):
        shared, own = rng.integers(0, 2**64, 850, dtype=np.uint64), rng.integers(0, 2**64, 150, dtype=np.uint64)
        a, b = minhash.signatures([np.concatenate([shared, own[:75]]), np.concatenate([shared, own[75:]])])
        errors.append((a == b).mean() - 0.85)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 200)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(7, 7), (3, 2)]
    rng.shuffle(edges)
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((n, top(n)) for n in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
