import numpy as np
import pytest

from tallyloom.llm import pq

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ["v", "ok", "dim", "list", "e", "i", "j", "base", "links", "key_a", "component"] if clash else []:
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def brute(rows, least=0.98):
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = []
    for _, e, label in rows:
        v = np.array([np.nan if x is None else x for x in e], np.float32).astype(float) if e else None
        good = label is not None and v is not None and np.isfinite(v).all() and v.any()
        unit.append(v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) if good else None)
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                n[i], n[j] = n[i] + 1, n[j] + 1
                root[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        least_id = min((x for x in groups[top(i)] if x is not None), default=None)
        out.append((repr(r[0]), n[i], repr(least_id), r[0] == least_id))
    return sorted(out)


def found(df):
    return sorted((repr(r.vec_id), r.n_links, repr(r.component_id), r.kept) for r in df.collect())


def near(rng, centres, n, noise, dim):
    return [(centres[rng.integers(len(centres))] + rng.normal(size=dim) * noise).astype(np.float32).tolist() for _ in range(n)]


@pytest.mark.parametrize(("dim", "block", "list_rows"), [(16, 1024, 40), (64, 64, 20), (3, 32, 10)])
def test_against_brute_force(spark, monkeypatch, dim, block, list_rows):
    """Several lists and blocks, a hot label, large groups of near copies. No link may be false; nearly all are found."""
    monkeypatch.setattr(pq, "BLOCK", block)
    monkeypatch.setattr(pq, "LIST_ROWS", list_rows)
    monkeypatch.setattr(pq, "HELD", 3000)
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(25, dim))
    vectors = near(rng, centres, 500, 0.12, dim) + near(rng, centres[:1], 150, 0.1, dim) + rng.normal(size=(150, dim)).astype(np.float32).tolist()
    rows = [(5000 - i, v, 1 if i % 3 == 0 else i % 7) for i, v in enumerate(vectors)]
    want, got = brute(rows), found(pq.near_duplicates(frame(spark, rows).repartition(6)))
    links, right = sum(r[1] for r in want), sum(r[1] for r in got)
    assert links > 500 and 0.99 * links <= right <= links
    assert sum(a != b for a, b in zip(want, got)) <= 0.01 * len(rows)


def test_odd_rows_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.01]
    rows = [(1, a, 1), (2, a, 1), (3, b, 1), (3, b, 1), (4, a, None), (5, None, 1), (6, [0.0] * 4, 1), (7, [nan, 1.0, 1.0, 1.0], 1), (8, [inf, 1.0, 1.0, 1.0], 1),
            (9, [1.0, None, 1.0, 1.0], 1), (None, a, 1), (10, a, 2), (None, [9.0, -1.0, 0.0, 0.0], 3), (11, [], 1), (12, [1.0, 2.0, 3.0], 1), (13, [2.0, 4.0, 6.0], 1),
            (14, [1e-38, 2e-38, 3e-38, 4e-38], 1), (15, [1e38, 2e38, 3e38, 3.4e38], 1), (0, [-1.0, -2.0, -3.0, -4.0], 1), (16, [-0.0, 1.0, 0.0, 0.0], 4), (17, [0.0, 1.0, 0.0, 0.0], 4)]
    assert found(pq.near_duplicates(frame(spark, rows, clash=True))) == brute(rows)
    assert pq.near_duplicates(frame(spark, [])).count() == 0
    only_bad = [(1, None, None), (2, [0.0], 1)]
    assert found(pq.near_duplicates(frame(spark, only_bad))) == brute(only_bad)


def test_table_distances_bound():
    """The distance to a code differs from the true one by at most what the code leaves out."""
    rng = np.random.default_rng(4)
    x = pq.unit(rng.normal(size=(400, 20)))
    index = pq.fit(x, 6)
    home, probes, codes, rest = index.encode(x, 0.2)
    for k in range(6):
        own = np.flatnonzero(home == k)
        table = np.sqrt(index.table_distances(x, k, codes[own]))
        true = np.sqrt(pq.squared(x, x[own]))
        assert (np.abs(table - true) <= rest[own] + 1e-6).all()
    assert all(h in p for h, p in zip(home, probes))


def test_lists_lose_no_pair_that_crosses_a_border(monkeypatch):
    """Copies moved straight at the border of another list, in many dimensions: one side of each pair probes the other's list."""
    r = np.random.default_rng(3)
    for dim in (64, 384, 1024):
        centres = r.normal(size=(8, dim))
        centres /= np.linalg.norm(centres, axis=1, keepdims=True)
        index = pq.Index.__new__(pq.Index)
        index.centroids, index.cuts = centres, [0, dim]
        index.books = [np.zeros((1, dim))]
        reach = np.sqrt(2 - 2 * 0.98)
        lost = crossed = 0
        for _ in range(400):
            a, b = r.choice(8, 2, replace=False)
            t = 0.5 + r.uniform(-0.12, 0.12)
            x = (1 - t) * centres[a] + t * centres[b] + r.normal(size=dim) * 0.01 / np.sqrt(dim)
            x /= np.linalg.norm(x)
            y = x + (centres[b] - centres[a]) * r.uniform(0.02, 0.19)
            y /= np.linalg.norm(y)
            if x @ y < 0.98:
                continue
            home, probes, _, _ = index.encode(np.stack([x, y]), reach)
            crossed += home[0] != home[1]
            lost += home[1] not in probes[0] and home[0] not in probes[1]
        assert crossed > 50 and not lost
