import math

import numpy as np
import pytest

import __spark_entry__ as registry
from galepost.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, id string, n string, dim int"


def table(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    rows = [
        (i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", "y", 1)
        for i, v in zip(ids, vectors, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def exact(vectors):
    """Whole entries, their exact covariance and deviations, by Python integers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(d)]
    centred = [[n * r[i] - total[i] for i in range(d)] for r in x]
    cov = np.array(
        [[sum(r[i] * r[j] for r in centred) / n**3 for j in range(d)] for i in range(d)]
    )
    return x, cov, [sum(v * v for v in r) for r in centred], np.array(centred, float) / n


def check(rows, vectors, components=32):
    _, cov, deviations, centred = exact(vectors)
    n, d = centred.shape
    values, _ = np.linalg.eigh(cov)
    values = values[::-1]
    k = min(components, int((values > values[0] * d * 2.0**-50).sum()))
    assert len(rows) == n * k
    white = np.zeros((n, k))
    for r in rows:
        assert r.n == n and r.deviation == deviations[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
        white[r.vec_id, r.component - 1] = r.whitened
    # Components are eigenvectors: what the rows' whitened values give back.
    vectors = centred.T @ white / n / np.sqrt(values[:k])
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    assert np.allclose(cov @ vectors, vectors * values[:k], atol=1e-9 * values[0])


@pytest.mark.parametrize("size", [1, 1000, 3e7])
def test_equals_exact_arithmetic(spark, size):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(7, 7)) * size
    vectors = rng.normal(size=(60, 7)) @ mix + 5
    rows = wh.whiten(table(spark, vectors), components=5).collect()
    if size > 1e6:
        assert all(r.deviation is None for r in rows)
        assert rows[0].identity_error < 1e-9
    else:
        check(rows, vectors, 5)


def test_products_are_exact():
    rng = np.random.default_rng(6)
    for top in (5, 1 << 20, 1 << 40):
        y = rng.integers(-top, top, size=(500, 4))
        high, low = wh._products(y)
        for i in range(4):
            for j in range(4):
                want = sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True))
                assert (int(high[i, j]) << wh.LIMB) + int(low[i, j]) == want


@pytest.mark.parametrize("gap", [0.0, 1e-14, 1e-9, 1e-5])
def test_clustered_eigenvalues(gap):
    """Vectors of eigenvalues far closer than float32 can tell apart."""
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0].astype(wh.WIDE)
    for _ in range(3):  # orthogonal in the wide type
        q = q + q @ (np.eye(40) - q.T @ q) / 2
    values = np.sort(np.concatenate([3 + gap * np.arange(6), 1 + gap * np.arange(4), np.linspace(4, 9, 30)]))[::-1]
    a = (q * values.astype(wh.WIDE)) @ q.T
    a = (a + a.T) / 2
    found, vectors = wh.refine_eigenvectors(a, np.linalg.eigh(a.astype(np.float32))[1])
    assert np.abs(found.astype(float) - values).max() < 1e-15 * 40
    assert np.abs((vectors.T @ vectors).astype(float) - np.eye(40)).max() < 1e-16
    assert np.abs((a @ vectors - vectors * found).astype(float)).max() < 1e-16
    if gap >= 1e-9:  # each vector is determined
        order = np.argsort(-values, kind="stable")
        close = np.abs((q[:, order].T @ vectors).astype(float))
        assert np.abs(np.diag(close) - 1).max() < 1e-12


def test_edge_rows(spark):
    rng = np.random.default_rng(8)
    good = [list(rng.normal(size=4)) for _ in range(9)]
    good[3] = good[2]
    bad = [None, [], [1, 2], [1, None, 2, 3], [1, float("nan"), 0, 0], [float("inf")] * 4, [1e30] * 4]
    rows = wh.whiten(table(spark, good + bad)).collect()
    check(rows, good)
    assert wh.whiten(table(spark, bad[:2])).count() == 0
    assert wh.whiten(table(spark, good).limit(0)).count() == 0
    assert wh.whiten(table(spark, [good[0]] * 3)).count() == 0
    # Null and repeated ids are rows of their own.
    assert wh.whiten(table(spark, good, [None, 1, 1, *range(6)])).count() == 36
    # A constant dimension, and one that another decides, leave fewer components.
    flat = [[a, b, 3.0, a] for a, b, *_ in good]
    check(wh.whiten(table(spark, flat)).collect(), flat)


def test_query(spark):
    rows = registry.queries()["op11_embedding_whitening"](spark, registry.SMOKE_DIR).collect()
    vectors = spark.read.parquet(f"{registry.SMOKE_DIR}/embeddings.parquet").orderBy("vec_id")
    vectors = [r.embedding for r in vectors.collect()]
    assert len(rows) == 32 * len(vectors)
    assert {r.n for r in rows} == {len(vectors)}
    assert rows[0].identity_error < 1e-9
