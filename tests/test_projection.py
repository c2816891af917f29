import numpy as np
import pytest

from tallyloom.operators.projection import cluster, fit_plane, project


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    return np.concatenate([rng.normal(loc=c, scale=0.2, size=(50, 6)) for c in (0, 3, 9)])


def frame(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "vec_id INT, embedding ARRAY<FLOAT>")


def test_plane(spark, data):
    df = frame(spark, data)
    model = fit_plane(df)
    got = np.array([(r.x, r.y) for r in project(model, df).orderBy("vec_id").collect()])
    centred = data - data.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(centred @ axes[:2].T), atol=1e-4)
    assert np.allclose(got.mean(axis=0), 0, atol=1e-6) and abs(got[:, 0] @ got[:, 1]) < 1e-3
    one = project(model, frame(spark, data[7:8])).first()
    assert np.allclose((one.x, one.y), got[7])


def test_clusters(spark, data):
    labels = [r.cluster for r in cluster(frame(spark, data), 3).orderBy("vec_id").collect()]
    assert [len(set(labels[i:i + 50])) for i in (0, 50, 100)] == [1, 1, 1] and len(set(labels)) == 3
    assert len({r.cluster for r in cluster(frame(spark, data[:4]), 99, starts=2).collect()}) <= 4
    assert len({r.cluster for r in cluster(frame(spark, data), 1, starts=2).collect()}) == 2
