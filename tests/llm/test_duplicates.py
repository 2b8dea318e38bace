"""SimHash near-duplicates against a comparison of all pairs."""

import collections
import re

import numpy as np
import pytest
import xxhash

from chainyard.llm import queries as Q
from chainyard.llm.common import stored
from chainyard.llm.components import components
from chainyard.llm.simhash_gph import (Allocator, bit_groups, classes, fingerprint, keep_one,
                                       near_duplicates)

from .conftest import SMALL, TEXTS, rows


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps, most=4):
    """Smallest place linked to each place."""
    u = np.array([f % 2**64 for f in fps], np.uint64)
    root = list(range(len(u)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i + 1:] ^ u[i]) <= most):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(u))]


def test_fingerprints():
    for t in TEXTS:
        assert fingerprint(t or "") % 2**64 == slow_fingerprint(t or "")


def crowd(n=1500, seed=0):
    """Fingerprints with crowds, chains and lone ones."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    center = rng.integers(0, 2**64, dtype=np.uint64)

    def flipped(x, most):
        bits = rng.choice(64, rng.integers(0, most + 1), replace=False)
        return x ^ np.uint64(sum(1 << int(b) for b in bits))

    base[:500] = [flipped(center, 5) for _ in range(500)]
    base[500:600] = [flipped(center, 12) for _ in range(100)]
    for i in range(600, 700):  # a chain of four bits a step
        base[i] = flipped(base[i - 1], 4)
    for i in range(700, 900):  # pairs about the limit
        base[i] = flipped(base[i + 200], 6)
    return np.unique(base).view(np.int64)


@pytest.mark.parametrize("most", [4, 2])
def test_classes_equal_all_pairs(spark, most):
    fps = np.sort(crowd())
    got = {r.fp: r.component for r in classes(
        stored(spark.createDataFrame([(int(x),) for x in fps], "fp long"), "fps"), most).collect()}
    want = slow_classes(fps.tolist(), most)
    assert got == {int(x): int(fps[w]) for x, w in zip(fps, want)}
    assert len(set(want)) < len(fps) - 300


def test_probes_retrieve_every_near_fingerprint(spark):
    """Pigeonhole: whatever is allocated, each near pair shares a probed value."""
    fps = crowd(1200, seed=3)
    df = stored(spark.createDataFrame([(int(x),) for x in fps], "fp long"), "fps")
    groups = bit_groups(df, 4)
    assert sorted(sum(groups, [])) == list(range(64)) and {len(g) for g in groups} == {16}
    from chainyard.llm.simhash_gph import _values
    values = [_values(fps, g) for g in groups]
    histogram = np.zeros((4, 1 << 16), np.int32)
    for i, v in enumerate(values):
        np.add.at(histogram[i], v, 1)
    allocator = Allocator(groups, histogram.ravel(), 4)
    t = allocator.thresholds(values)
    assert ((t + 1).sum(axis=1) == 5).all() and len(np.unique(t, axis=0)) > 1
    row, bucket = allocator.probes(fps)
    probed = collections.defaultdict(set)
    for r, b in zip(row.tolist(), bucket.tolist()):
        probed[r].add(b)
    u = fps.view(np.uint64)
    for i in range(0, len(u), 7):
        for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 4).tolist():
            assert any((k << 16) + int(values[k][j]) in probed[i] for k in range(4))


def test_near_duplicates_of_odd_rows(spark, docs, no_docs, clashing):
    texts = [r[1] or "" for r in rows()]
    fps = [slow_fingerprint(t) for t in texts]
    root = slow_classes(fps)
    least = {}
    for r, w in zip(rows(), root):
        if r[0] is not None:
            least[w] = min(least.get(w, r[0]), r[0])
    want = collections.Counter((r[0], f"{f:016x}", least.get(w))
                               for r, f, w in zip(rows(), fps, root))
    for df in (docs, clashing):
        assert collections.Counter(map(tuple, near_duplicates(df).collect())) == want
        kept = stored(df, "docs")
        one = keep_one(kept)
        assert one.columns == df.columns
        got = one.select("doc_id").collect()
        assert len(got) == len(set(root))
        assert {r.doc_id for r in got if r.doc_id is not None} == set(least.values())
    assert near_duplicates(no_docs).count() == 0
    assert keep_one(no_docs).count() == 0


def test_kept_rows_do_not_depend_on_file_splits(spark):
    """As if executors joined or were lost between the jobs of ``keep_one``."""
    texts = [f"text {k} " + " ".join(f"w{k * 31 + j}" for j in range(30)) for k in range(150)]
    rows = [(i, texts[i % 150]) for i in range(600)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "docs")
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    try:
        one = keep_one(docs)
        before = docs.rdd.getNumPartitions()
        spark.conf.set(name, "2000")
        assert spark.read.parquet(*docs.inputFiles()).rdd.getNumPartitions() != before
        assert sorted(r.doc_id for r in one.collect()) == list(range(150))
    finally:
        spark.conf.set(name, old)


def test_registered_near_duplicates(spark):
    import duckdb
    found = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by 1").fetchall()
    fps = [slow_fingerprint(t) for _, t in found]
    root = slow_classes(fps)
    want = {(d, f"{f:016x}", found[w][0]) for (d, _), f, w in zip(found, fps, root)}
    assert set(map(tuple, Q.op4_simhash_near_duplicates(spark, SMALL).collect())) == want


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (300, None)]
    links += [(500, 500 + k) for k in range(1, 300)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {150: 100, 200: 100}
    assert got == want | {500 + k: 500 for k in range(1, 300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
