"""Whitening against plain integer arithmetic and numpy, and odd rows."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechlake.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, v string, n string, high string"


def plain(rows):
    """vec_id to (deviation, whitened), and the shares, by the definition."""
    held = [(i, [int(np.floor(np.float64(c) * 1024)) + 100000 for c in v]) for i, v in rows]
    x = np.array([v for _, v in held], object)
    n, s = len(x), x.sum(0)
    q = n * x - s
    cov = np.array([[int((q[:, i] * q[:, j]).sum()) / n**3 for j in range(x.shape[1])] for i in range(x.shape[1])])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return [(i, int((r * r).sum()), np.array(r / n, float) @ u[:, :8] / np.sqrt(e[:8])) for (i, _), r in zip(held, q)], e[:8] / np.trace(cov)


def made(rng, n, d):
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(0, 0.2, (n, d)) * np.linspace(0.3, 2, d))]


@pytest.mark.parametrize("scale", [600, 2**23, 2**30, 2**61])
def test_products_of_bit_planes_are_exact(scale):
    rng = np.random.default_rng(1)
    z = rng.integers(-scale, scale + 1, (333, 5))
    z[:, 3] = 7
    sums, products = whitening.scatter(z)
    whole = z.astype(object)
    assert list(sums) == list(whole.sum(0))
    want = whole.T @ whole
    assert all(products[i, j] == want[i, j] for i in range(5) for j in range(i, 5))
    assert all(sum(limb << whitening.LIMB * k for k, limb in enumerate(whitening._limbs(v))) == v for v in [*sums, -1, 0, 1 << 130, -(1 << 130)])


def test_whitening_matches_plain_arithmetic(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PLANE_BYTES", 1 << 10)
    rows = made(np.random.default_rng(2), 700, 12)
    odd = [(900, None), (901, [0.1] * 11 + [None]), (902, [0.1] * 11 + [float("nan")]), (903, [float("inf")] + [0.0] * 11), (904, [])]
    df = spark.createDataFrame([(i, v, 1, "clash", "clash", "clash") for i, v in [*rows, rows[0], *odd]], SCHEMA).repartition(5)
    models = whitening.fit(df)
    got = whitening.whiten(df, models)
    assert got.columns == [*df.columns, "whitening"]
    found = got.where(F.size("embedding") > 0).select("vec_id", "whitening.*").collect()
    want, shares = plain([*rows, rows[0]])
    by = {i: (dev, w) for i, dev, w in want}
    assert len(found) == len(want)
    signs = np.sign([found[0].whitened[k] / by[found[0].vec_id][1][k] for k in range(8)])
    for r in found:
        dev, w = by[r.vec_id]
        assert r.n == len(want) and r.deviation == Decimal(dev)
        assert np.allclose(np.array(r.whitened) * signs, w, atol=1e-8)
        assert np.allclose(r.explained, shares, rtol=1e-9) and r.identity_error < 1e-9
    w = np.array([r.whitened for r in found])
    assert np.abs(w.T @ w / len(w) - np.eye(8)).max() < 1e-9 and np.abs(w.mean(0)).max() < 1e-9
    assert got.where(F.size("embedding") == 0).select("whitening.whitened").collect()[0].whitened == []


def test_few_equal_and_huge_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0]), (4, [3e38, 1.0, 0.0, 0.0]), (5, [-3e38, 1.0, 0.0, 0.5])],
                               "vec_id long, embedding array<float>")
    rows = {r.vec_id: r for r in whitening.whiten(df, whitening.fit(df)).select("vec_id", "whitening.*").collect()}
    assert all(rows[i].whitened == [None] * d and rows[i].explained == [None] * d and rows[i].deviation == 0 and rows[i].identity_error is None
               for i, d in ((1, 2), (2, 2), (3, 3)))
    assert rows[1].n == 2 and rows[3].n == 1 and rows[4].n == 2
    assert abs(rows[4].whitened[0]) == pytest.approx(1) and rows[4].whitened[1:] == [None] * 3
    assert rows[4].deviation == rows[5].deviation is not None or rows[4].deviation is None
    empty = df.limit(0)
    assert whitening.fit(empty) == {} and whitening.whiten(empty, {}).count() == 0


def test_query(spark, tmp_path):
    rows = made(np.random.default_rng(3), 50, 9)
    spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op11_whitening(spark, str(tmp_path)).collect()
    want, shares = plain(rows)
    by = {i: dev for i, dev, _ in want}
    assert len(found) == 8 * 50 and {r.component for r in found} == set(range(1, 9))
    assert all(r.n == 50 and r.deviation == by[r.vec_id] == r.deviation_exact and r.explained == pytest.approx(shares[r.component - 1]) for r in found)
