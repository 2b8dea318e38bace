"""Whitening against numpy's eigenvectors and exact whole numbers."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainyard.llm import queries as Q
from chainyard.llm.spectrum import leading, positives
from chainyard.llm.whitening import fit_whitening, identity_error, whiten

from .conftest import SMALL

ROWS = "vec_id long, embedding array<float>"


def mixed(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
    m = q * values @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("d", [1, 2, 3, 7, 40])
def test_counts_are_those_of_the_eigenvalues(d):
    rng = np.random.default_rng(d)
    for _ in range(20):
        m = rng.standard_normal((d, d))
        m = m + m.T
        assert positives(m) == (np.linalg.eigvalsh(m) > 0).sum()
    assert positives(np.zeros((d, d))) == 0
    swapped = np.eye(d)[::-1]
    assert positives(swapped) == (np.linalg.eigvalsh(swapped) > 0).sum()


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 40), np.ones(40), np.r_[np.ones(10) * 5, np.ones(10) * 3, np.linspace(1, 2, 20)],
    np.r_[5.0, np.zeros(39)], np.r_[1 + 1e-13 * np.arange(5), np.zeros(5)],
    np.r_[1 + 1e-9 * np.arange(5), np.zeros(5)], 10.0 ** -np.arange(10.0)])
def test_leading_pairs(values):
    m = mixed(np.random.default_rng(3), values)
    e, q = leading(m, 32)
    want = np.sort(np.linalg.eigvalsh(m))[::-1]
    assert len(e) == min(32, (values > 1e-12 * values.sum()).sum())
    assert np.abs(e - want[:len(e)]).max() < 1e-13 * want[0]
    assert np.abs(q.T @ q - np.eye(len(e))).max() < 1e-12
    assert np.abs(m @ q - q * e).max() < 1e-12 * want[0]


def result(rows, k=32):
    """n, deviations, whitened (signs as numpy has them) and explained shares."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in r] for r in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    y = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums)] for r in x])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > 1e-12 * e.sum()).sum()))
    return n, far, y @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_registered_query(spark):
    import duckdb
    got = Q.op11_embedding_whitening(spark, SMALL).toPandas()
    z = duckdb.sql(f"select vec_id, embedding from '{SMALL}/embeddings.parquet' order by 1").fetchall()
    n, far, white, share = result([r[1] for r in z])
    assert len(got) == n * 32 and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10
    own = got.sort_values(["vec_id", "component"])
    assert own.deviation.tolist() == [f for f in far for _ in range(32)]
    found = own.whitened.to_numpy().reshape(n, 32)
    signs = np.sign((found * white).sum(axis=0))
    assert np.abs(found - white * signs).max() < 1e-8
    assert np.allclose(own.explained.to_numpy().reshape(n, 32), share, rtol=1e-10)


def whitened(spark, made, kind=ROWS, **options):
    df = spark.createDataFrame(made, kind)
    model = fit_whitening(df, **options)
    out = whiten(df, model)
    return model, out.collect(), identity_error(out, model)


def test_unusable_rows_ties_and_clashing_names(spark):
    rng = np.random.default_rng(0)
    sound = [(i, [float(x) for x in rng.standard_normal(3)]) for i in range(20)]
    sound += [sound[0], (None, [0.0, 0.0, 0.0]), (-5, [1.0, 1.0, 1.0])]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (104, []),
           (103, [1.0, float("inf"), 2.0]), (105, [1.0, 2.0])]
    kind = ROWS + ", whitened string, deviation string, v string, k string, at string"
    model, rows, error = whitened(spark, [(*r, *"abcde") for r in sound + bad], kind)
    n, far, white, share = result([np.float32(r[1]) for r in sound])
    assert model.n == n == len(rows) and error < 1e-12
    assert sorted(int(r.deviation) for r in rows) == sorted(far)
    assert sorted(str(r.vec_id) for r in rows) == sorted(str(r[0]) for r in sound)
    assert np.allclose(model.explained, share)


def test_huge_numbers_stay_exact(spark):
    made = [(i, [(-1.0) ** i * 10.0 ** (4 * i), 1e300, float(i)]) for i in range(9)]
    model, rows, error = whitened(spark, made, "vec_id long, embedding array<double>")
    x = [[min(max(int(np.floor(64 * c)), -2**45), 2**45) + 1_000_000 if abs(c) < 1e100
          else 2**45 + 1_000_000 for c in r] for _, r in made]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(r, sums)) for i, r in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in rows} == want and error < 1e-6


@pytest.mark.parametrize("made", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])] * 5])
def test_without_components(spark, made):
    model, rows, error = whitened(spark, made)
    assert len(model.values) == 0 and error == 0
    assert [r.whitened for r in rows] == [[]] * (5 if len(made) == 5 else 0)


def test_sums_do_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    a, b = (fit_whitening(df.repartition(n, F.rand(n))) for n in (1, 7))
    assert a.sums == b.sums and np.array_equal(a.values, b.values)
    assert np.array_equal(a.vectors, b.vectors)
