"""Near-duplicate vectors against the cosines of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainyard.llm import embedding_dups as E
from chainyard.llm import queries as Q
from chainyard.llm.common import table

from .conftest import SMALL

ROWS = "vec_id long, embedding array<double>"


def slow(ids, x, cosine=0.95):
    """vec_id -> (n_links, component_id) by all cosines."""
    u = np.array(x, float)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= cosine
    np.fill_diagonal(near, False)
    root = E._roots(len(u), *np.nonzero(near))
    least = {r: min(i for i, q in zip(ids, root) if q == r) for r in set(root.tolist())}
    return {i: (int(n), least[r]) for i, n, r in zip(ids, near.sum(axis=1), root)}


def run(spark, made, kind=ROWS, **options):
    out = E.near_duplicates(spark.createDataFrame(made, kind), **options).collect()
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in out]


def planted(n=1500, d=24, seed=0):
    """Lone vectors, pairs at many angles, a crowd of unequal near-copies with a
    rim, a chain, and equal vectors."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[100:200] = x[:100] + rng.standard_normal((100, d)) * rng.uniform(0, 0.5, (100, 1))
    noise = rng.standard_normal((500, d))
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    x[200:700] = x[0] / np.linalg.norm(x[0]) + noise * rng.uniform(0.05, 0.3, (500, 1))
    for k in range(30):  # each step is within the limit, the ends are far apart
        a = math.radians(15 * k)
        x[700 + k] = math.cos(a) * np.eye(d)[0] + math.sin(a) * np.eye(d)[1]
    x[800:830] = x[800]
    x[200:300] *= rng.uniform(0.01, 100, (100, 1))
    return x


@pytest.mark.parametrize("block", [4096, 100])
def test_equal_to_all_pairs_with_crowds_and_chains(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    x = planted()
    ids = [int(i) for i in np.random.default_rng(1).permutation(len(x)) * 7]
    got = run(spark, [(i, r.tolist()) for i, r in zip(ids, x)])
    want = slow(ids, x)
    assert sorted(i for i, *_ in got) == sorted(ids)
    found = sum(n for _, n, *_ in got) / sum(n for n, _ in want.values())
    assert 0.995 <= found <= 1 and all(n <= want[i][0] for i, n, *_ in got)
    assert all(want[i][1] <= c for i, _, c, _ in got)
    assert np.mean([want[i][1] == c for i, _, c, _ in got]) > 0.995
    assert all(kept == (i == c) for i, _, c, kept in got)


def test_crowd_is_counted_by_the_triangle_inequality(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 100)
    rng = np.random.default_rng(5)
    x = np.ones(24) / math.sqrt(24) + 0.01 * rng.standard_normal((600, 24))
    compared = []
    deal = E._dealt
    monkeypatch.setattr(E, "_dealt", lambda routed: compared.append(deal(routed)) or compared[0])
    got = run(spark, [(i, r.tolist()) for i, r in enumerate(x)])
    assert {(n, c) for _, n, c, _ in got} == {(599, 0)}
    assert compared[0].count() == 0  # nothing but core vectors: no pair is compared


def test_registered_query_on_the_table(spark):
    got = Q.op13_embedding_near_duplicates(spark, SMALL).collect()
    z = table(spark, SMALL, "embeddings").collect()
    want = slow([r.vec_id for r in z], [r.embedding for r in z])
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert len(got) == len(z) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_unusable_rows_repeated_ids_and_clashing_names(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.05]
    made = [(5, a), (3, b), (7, a), (7, a), (9, [9.0, -1.0, 0.0]), (9, [-1.0, 9.0, 0.0]),
            (1, None), (2, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (6, [1.0, float("nan"), 3.0]),
            (8, [1.0, float("inf"), 3.0]), (10, [1.0, 2.0]), (11, []), (None, a), (12, [-0.0, 0.0, -1e-300]),
            (13, [0.0, -0.0, -1e-300]), (14, [0.0, 0.0, -1e300])]
    kind = ROWS + ", k string, v string, id string, w string, n_links string, kept string"
    got = run(spark, [(*r, *"abcdef") for r in made], kind)
    alone = [(i, 0, i, True) for i in (1, 2, 4, 6, 8, 9, 9, 10, 11)] + [(None, 0, None, True)]
    linked = [(5, 3, 3, False), (3, 3, 3, True), (7, 3, 3, False), (7, 3, 3, False),
              (12, 2, 12, True), (13, 2, 12, False), (14, 2, 12, False)]
    assert sorted(got, key=str) == sorted(alone + linked, key=str)


@pytest.mark.parametrize("made", [[], [(1, None)], [(1, [2.0])], [(1, [2.0]), (2, [3.0]), (3, [-1.0])]])
def test_small_tables(spark, made):
    want = {1: (1, 1), 2: (1, 1), 3: (0, 3)} if len(made) == 3 else {i: (0, i) for i, _ in made}
    assert {i: (n, c) for i, n, c, _ in run(spark, made)} == want


def test_windows_count_collisions():
    rng = np.random.default_rng(2)
    p = np.round(rng.standard_normal((60, 9)), 1)
    counts = E.colliding(p, p[:20], 0.5)
    # the same sums as the window's ends
    want = ((p[None] >= p[:20, None] - 0.5) & (p[None] <= p[:20, None] + 0.5)).sum(axis=2)
    assert np.array_equal(counts, want)


def test_calibration_finds_pairs_at_the_limit():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 48)) + 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    m = E.calibrated(x, 1_000_000, 0.95)
    other = E.pairs_at_limit(x, 0.95, rng)
    assert np.allclose((x * other).sum(axis=1), 0.95)
    a, b = m.of(x), m.of(other)
    met = (m.codes(a) == m.codes(b)).any(axis=1)
    counted = (np.abs(a - b) <= m.window)[:, :E.COUNTED].sum(axis=1) >= m.least
    assert (met & counted).mean() > 0.99
    apart = (np.abs(a[:-1] - a[1:]) <= m.window)[:, :E.COUNTED].sum(axis=1) >= m.least
    assert apart.mean() < 0.01
