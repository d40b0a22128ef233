"""Jacobi-Davidson against dense eigenvalues, whitening against numpy."""

import numpy as np
import pytest

from urbanflow.llm import queries, whitening


@pytest.mark.parametrize("d, kind", [(1, "flat"), (20, "flat"), (64, "decay"), (300, "flat"), (200, "ties"), (500, "decay"), (300, "low rank")])
def test_eigenpairs(d, kind):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"flat": 1 + rng.random(d) / 2, "decay": 0.9 ** np.arange(d), "ties": np.repeat([3.0, 2, 1, 0.5], -(-d // 4))[:d], "low rank": np.r_[np.ones(10), np.zeros(max(0, d - 10))][:d]}[kind]
    full = (turn * values) @ turn.T
    found, vectors, residual = whitening.jacobi_davidson(lambda b: full @ b, d, 32)
    want = np.sort(values)[::-1][:32]
    assert np.abs(found - want).max() < 1e-12 * want[0] and residual < 1e-11 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-13


def dense(x, k=32):
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(axis=1), values / (y**2).sum() * n, (y @ vectors) / np.sqrt(values)


def compare(rows, ids, x, k):
    deviation, explained, z = dense(x, k)
    assert len(rows) == len(x) * k and set(rows.n) == {len(x)} and rows.identity_error.nunique() == 1 and rows.identity_error.max() < 1e-9
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.allclose(np.abs(wide), np.abs(z), atol=1e-6) and np.allclose((wide * z).sum(axis=0) / len(x), np.sign((wide * z).sum(axis=0)), atol=1e-9)
    one = rows[rows.component == 1].set_index("vec_id").loc[ids]
    assert one.deviation.tolist() == deviation.tolist()
    assert np.allclose(rows.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-9)


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.001"
    raw = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(np.array(raw.embedding.tolist(), np.float64) * 64).astype(np.int64) + 1_000_000
    compare(queries.op12_whitening(spark, sf).toPandas(), raw.vec_id.tolist(), x, min(32, x.shape[1]))


SCHEMA = "vec_id bigint, embedding array<double>, x string, n string"


def test_unusable_vectors_repeats_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(5).tolist(), "x", "n") for i in range(40)]
    odd = [(90, None, "", ""), (91, [], "", ""), (92, [1.0, None, 1.0, 1.0, 1.0], "", ""), (93, [float("nan")] * 5, "", ""), (94, [1.0, float("-inf"), 0.0, 0.0, 0.0], "", ""), (None, good[0][1], "", "")]
    df = spark.createDataFrame([*good, *odd, good[3], good[3]], SCHEMA).repartition(3)
    rows = whitening.whiten(whitening.quantised(df, "embedding", 64, 1000), "vec_id").toPandas()
    x = np.floor(64 * np.array([g[1] for g in [*good, good[0], good[3], good[3]]])).astype(np.int64) + 1000
    assert set(rows.n) == {43} and len(rows) == 43 * 5 and rows.vec_id.isna().sum() == 5 and (rows.vec_id == 3).sum() == 15
    deviation, _, z = dense(x, 5)
    assert sorted(rows[rows.component == 2].deviation) == sorted(deviation)
    assert np.allclose(sorted(rows.whitened.abs()), sorted(np.abs(z).ravel()), atol=1e-9)


def test_no_variance_no_rows(spark):
    for rows in ([], [(1, [0.5, 0.25], "", "")], [(i, [0.5, 0.25], "", "") for i in range(9)], [(1, None, "", "")]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert whitening.whiten(whitening.quantised(df, "embedding", 64, 0), "vec_id").count() == 0
    # Equal entries in all rows but one dimension: one component.
    df = spark.createDataFrame([(i, [float(i % 3), 7.0, 7.0], "", "") for i in range(9)], SCHEMA)
    rows = whitening.whiten(whitening.quantised(df, "embedding", 64, 0), "vec_id").toPandas()
    assert set(rows.component) == {1} and np.allclose(rows.explained, 1) and abs((rows.whitened**2).mean() - 1) < 1e-12


def test_ragged_vectors_are_an_error(spark):
    df = spark.createDataFrame([(1, [0.5], "", ""), (2, [0.5, 1.0], "", "")], SCHEMA)
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(whitening.quantised(df, "embedding", 64, 0), "vec_id")


def test_whole_numbers_near_their_bound(spark):
    """Differences are exact however far the vectors lie from zero, and deviations beyond 64 bits on the way are too."""
    base = 1 << 50
    x = np.array([[base + 3 * i, base - i * i] for i in range(20)], np.int64)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id bigint, x array<bigint>")
    got = whitening.whiten(df, "vec_id").toPandas()
    sums = x.astype(object).sum(axis=0)
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == [int(sum(v * v for v in 20 * r - sums)) for r in x.astype(object)]
    assert np.allclose(got.groupby("component").whitened.var(ddof=0), 1, atol=1e-9)
