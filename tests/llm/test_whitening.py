"""Whitening against a plain numpy version with Python integers."""

import math

import numpy as np
import pytest
from gridloom.errors import GridloomError
from gridloom.llm import op13_whitening as white
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_version(vectors, k=32):
    """n, sums, eigenvalues and components of the covariance formed outright."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    xc = np.array((n * x - sums) / n, float)
    values, turn = np.linalg.eigh(xc.T @ xc / n)
    order = np.argsort(values)[::-1][:k]
    return x, n, sums, xc, values[order], turn[:, order], values.sum()


def held_against(found, vectors, ids, k=32):
    x, n, sums, xc, values, turn, trace = plain_version(vectors, k)
    wide = {i: g.set_index("component") for i, g in found.groupby("vec_id")}
    assert set(wide) == set(ids) and set(found.n) == {n} and (found.identity_error < 1e-9).all() and found.identity_error.nunique() == 1
    w = np.array([wide[i].whitened.to_numpy() for i in ids])
    want = xc @ turn / np.sqrt(values)
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w - want * signs).max() < 1e-6
    assert [int(wide[i].deviation.iloc[0]) for i in ids] == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert np.allclose(wide[ids[0]].explained.to_numpy(), values / trace, rtol=1e-9)


def vectors_of(n, d, seed, decay=0.9):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * decay ** np.arange(d) + rng.standard_normal(d)).astype(np.float32)


@pytest.mark.parametrize(("n", "d", "k", "oversample"), [(300, 12, 32, 32), (400, 64, 32, 32), (400, 90, 8, 6)])
def test_equals_the_covariance_formed_outright(spark, n, d, k, oversample):
    v = vectors_of(n, d, d)
    table = spark.createDataFrame([(i, row.tolist(), 0) for i, row in enumerate(v)], SCHEMA).repartition(3)
    found = white.whiten(table, k, oversample).toPandas()
    assert len(found) == n * min(k, d) and found.component.max() == min(k, d)
    held_against(found, v, list(range(n)), min(k, d))


def test_several_passes_end_in_certified_components(spark):
    v = vectors_of(300, 90, 1, 0.8)
    table = white.usable(spark.createDataFrame([(i, row.tolist(), 0) for i, row in enumerate(v)], SCHEMA))
    fitted = white.fit(table, 5, 3)
    assert fitted.passes > 2 and fitted.residual <= white.TOLERANCE
    assert np.abs(fitted.components.T @ fitted.components - np.eye(5)).max() < 1e-12
    with pytest.raises(GridloomError, match="not certified"):
        white.fit(table, 5, 3, max_passes=2)


def test_odd_rows(spark):
    v = vectors_of(40, 5, 2)
    good = [(i, row.tolist(), 0) for i, row in enumerate(v)] + [(100, v[0].tolist(), 1)] * 3
    odd = [(200, None, 0), (201, [1.0, None, 0.0, 0.0, 0.0], 0), (202, [1.0, float("nan"), 0.0, 0.0, 0.0], 0), (203, [1.0, 0.0, float("-inf"), 0.0, 0.0], 0), (204, [], 0), (205, [1.0], 0)]
    table = spark.createDataFrame(good + odd, SCHEMA).repartition(3)
    for name in ("x", "n", "component", "whitened", "deviation", "task", "block", "explained"):
        table = table.withColumn(name, F.lit("c"))
    found = white.whiten(table).toPandas()
    assert len(found) == 43 * 5 and set(found.vec_id) == {*range(40), 100}
    copies = found[found.vec_id == 100].groupby("component").whitened
    assert (copies.count() == 3).all() and (copies.nunique() == 1).all()
    _, n, _, xc, values, turn, _ = plain_version([r[1] for r in good])
    w = np.array([found[found.vec_id == i].sort_values("component").whitened.to_numpy() for i in range(40)])
    assert n == 43 and np.abs(np.abs(w) - np.abs(xc[:40] @ turn / np.sqrt(values))).max() < 1e-6


def test_tables_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(5)], SCHEMA)
    assert white.whiten(same).count() == 0 and white.whiten(same, 1, 1).count() == 0
    assert white.whiten(same.limit(0)).columns == white.whiten(same).columns
    half = spark.createDataFrame([(i, [float(i), 2.0, -float(i)], 0) for i in range(5)], SCHEMA)
    assert {r["component"] for r in white.whiten(half).collect()} == {1}
    null = spark.createDataFrame([(None, [float(i), 1.0], 0) for i in range(4)], SCHEMA)
    assert [r["vec_id"] for r in white.whiten(null).collect()] == [None] * 4


def test_large_values(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0], 0), (2, [0.0, 0.0], 0)], SCHEMA)
    with pytest.raises(GridloomError, match="out of range"):
        white.whiten(table)
    off = np.array([[3, 4], [1 << 31, 1 << 31], [(1 << 31) + 1, 1 << 32], [1 << 40, 0]], np.int64)
    assert white.deviations(off).to_pylist() == [25, None, None, None]
    assert white.deviations(off[:1]).to_pylist() == [25]
    assert white.deviations(np.array([[(1 << 31) - 1, 1 << 31]], np.int64)).to_pylist() == [((1 << 31) - 1) ** 2 + (1 << 62)]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    found = white.op13_whitening(spark, sf).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    held_against(found, [v for _, v in rows], [i for i, _ in rows])
