"""Hard negatives against the scores of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainyard.llm import hard_negatives as H
from chainyard.llm import queries as Q
from chainyard.llm.common import table

ROWS = "vec_id long, label int, embedding array<double>"


def slow(rows, anchor, scale=256):
    """All result rows by all scores of (id, label, vector) rows."""
    x = np.array([[min(max(int(np.floor(scale * c)), -2**27), 2**27) for c in r[2]] for r in rows],
                 dtype=np.int64)
    out = []
    for (i, label, _), own in zip(rows, x):
        if not anchor(i):
            continue
        score = (x * own).sum(axis=1).tolist()
        order = sorted(range(len(rows)), key=lambda k: (-score[k], rows[k][0]))
        near = [k for k in order if rows[k][1] == label and rows[k][0] != i][:5]
        for p in near:
            far = [k for k in order if rows[k][1] != label and rows[k][0] != i
                   and 80 * score[p] <= 100 * score[k] <= 100 * score[p]][:5]
            out += [(i, rows[p][0], rank, rows[k][0], score[p], score[k])
                    for rank, k in enumerate(far, 1)]
    return sorted(out)


def run(spark, made, anchor=10, kind=ROWS):
    df = spark.createDataFrame(made, kind)
    got = H.hard_negatives(df, F.col("vec_id") % anchor == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()))


def planted(n=1200, d=16, seed=0):
    """Clusters of many labels, lone vectors, lengths from tiny to long."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[:700] = rng.standard_normal((9, d))[rng.integers(0, 9, 700)] + 0.2 * rng.standard_normal((700, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] *= rng.uniform(0.05, 4, (len(x[::3]), 1))
    x[5:8] = 0
    x[20:30] = x[20]
    order = rng.permutation(n)
    return [(int(k), int(l), x[k].tolist()) for k, l in zip(order, rng.integers(0, 4, n))]


@pytest.mark.parametrize("size", [16_384, 100])
def test_equal_to_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(H, "ROWS", size)
    monkeypatch.setattr(H, "ASKS", 40)
    rows = planted()
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_registered_query_on_the_table(spark, sf):
    path = f"/root/testdata/{sf}"
    got = sorted(map(tuple, Q.op12_hard_negatives(spark, path).collect()))
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in table(spark, path, "embeddings").collect()]
    assert got == slow(rows, lambda i: i % 100 == 0) and got


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-300, 300, (400, 6)), np.zeros((3, 6), int),
                        np.repeat([[1, 2, 3, 4, 5, 6]], 5, 0) * np.arange(-2, 3)[:, None]]).astype(np.int32)
    refs = H.references(x[:200].astype(float))
    angles, norm = H.angles_to(x, refs)
    nearest, farthest = H.pair_angles(angles, angles)
    product = norm[:, None] * norm
    low, high = H.score_bounds(nearest, farthest, product, product)
    score = H.scores(x, x)
    assert np.array_equal(score, x.astype(np.int64) @ x.T.astype(np.int64))
    assert (low <= score).all() and (score <= high).all()
    assert (high - low < 2 * product + 3).mean() > 0.5  # they do say something
    rows = [dict(block=b, n0=norm[o].min(), n1=norm[o].max(), l0=0, l1=0,
                 **{f"a{i}": angles[o, i].min() for i in range(len(refs))},
                 **{f"b{i}": angles[o, i].max() for i in range(len(refs))})
            for b, o in enumerate(np.array_split(np.argsort(angles[:, 0]), 20))]
    parts = np.array_split(np.argsort(angles[:, 0]), 20)
    ranges = H.Ranges(rows, len(refs))
    for k in range(0, len(x), 7):
        least, most = ranges.bounds(angles[k], norm[k])
        for b, o in enumerate(parts):
            assert (least[b] <= score[k, o]).all() and (score[k, o] <= most[b]).all()


def test_blocks_out_of_reach_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 50)
    asks = []
    keep = H._asks
    monkeypatch.setattr(H, "_asks", lambda *a: asks.append(keep(*a)) or asks[-1])
    rng = np.random.default_rng(4)
    centres = np.eye(8)
    rows = [(k, k // 8 % 2, (centres[k % 8] + 0.05 * rng.standard_normal(8)).tolist()) for k in range(1600)]
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)
    assert all(a.count() < 160 * 32 / 3 for a in asks)  # anchors x blocks


def test_unusable_rows_ties_and_clashing_names(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 2.9]
    sound = [(0, 1, a), (10, 1, a), (10, 1, a), (3, 1, b), (4, 2, a), (2, 2, a), (5, 2, b), (6, 3, b),
             (7, 2, [0.0, 0.0, 0.0]), (8, 1, [1e300, -1e300, 1e300]), (20, 9, a), (30, 9, [0.0] * 3)]
    bad = [(11, None, a), (None, 1, a), (12, 1, None), (13, 2, [1.0, None, 3.0]), (15, 2, []),
           (14, 2, [1.0, float("nan"), 3.0]), (16, 2, [float("-inf"), 1.0, 1.0]), (40, 2, [1.0, 2.0])]
    kind = ROWS + ", no string, block string, x string, angles string, rank string, v string"
    got = run(spark, [(*r, *"abcdef") for r in sound + bad], kind=kind)
    assert got == slow(sound, lambda i: i % 10 == 0)


def test_largest_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(k, k % 2, (rng.choice([-1, 1], 64) * 1e30 * (k > 3)).tolist()) for k in range(40)]
    rows += [(k, k % 2, [1e30 * (j < k) for j in range(64)]) for k in range(40, 80)]
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("made", [[], [(1, 1, None)], [(10, 1, [1.0])], [(10, 1, [1.0]), (20, 1, [1.0])],
                                  [(10, 1, [-1.0]), (20, 1, [1.0]), (3, 2, [0.5])]])
def test_small_tables(spark, made):
    usable = [r for r in made if r[2]]
    assert run(spark, made) == (slow(usable, lambda i: i % 10 == 0) if usable else [])
