"""History from many extracts in one pass against successive runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chainyard.operators.scd2 import scd2_history, scd2_snapshot

ROW = "k string, a string, b int, note string, _ingestion_timestamp string"


def extracts(spark, seed, n=6, keys=12):
    """Random extracts: keys come, go and return, values change or are NULL, a
    run may be empty or hold a key twice."""
    rng = random.Random(seed)
    out = []
    for run in range(n):
        rows = []
        for k in range(keys):
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                rows.append((f"k{k}", rng.choice(["x", "y", None]), rng.choice([1, None]),
                             f"n{rng.random()}", f"2024-0{run + 1}-0{rng.choice([1, 1, 2])}"))
        rows.append((None, "x", 1, "no key", "2024"))
        if run == 3:
            rows = []
        out.append((spark.createDataFrame(rows, ROW), f"2024-0{run + 1}-01 00:00:00"))
    return out


def folded(parts, current=None, **kw):
    for df, ts in parts:
        current = scd2_snapshot(current, df, "k", ["a", "b"], ts, **kw)
    return current


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("deletes", [True, False])
def test_equals_successive_runs(spark, seed, deletes):
    parts = extracts(spark, seed)
    want = folded(parts, hard_deletes=deletes)
    got = scd2_history(parts, "k", ["a", "b"], hard_deletes=deletes)
    assert got.columns == want.columns and rows(got) == rows(want)
    first = folded(parts[:2], hard_deletes=deletes)
    later = scd2_history(parts[2:], "k", ["a", "b"], first, hard_deletes=deletes)
    assert rows(later) == rows(want)


def test_first_instant_and_columns_that_come_and_go(spark):
    a = spark.createDataFrame([("k1", "x", 1, "2024-01-01")], "k string, a string, b int, old string")
    b = spark.createDataFrame([("k1", "x", 1, 7), ("k2", "y", 2, 8)], "k string, a string, b long, new int")
    parts = [(a, "2024-01-01 00:00:00"), (b, "2024-02-01 00:00:00")]
    early = "1970-01-01 00:00:00"
    got = scd2_history(parts, "k", ["a", "b"], initial_valid_from=early)
    assert rows(got) == rows(folded(parts, initial_valid_from=early))
    assert {r.k: r.valid_from for r in got.collect()} == {
        "k1": dt.datetime(1970, 1, 1), "k2": dt.datetime(2024, 2, 1)}


def test_one_shuffle(spark):
    plan = scd2_history(extracts(spark, 1), "k", ["a", "b"])._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1


def test_extracts_must_follow_one_another(spark):
    parts = extracts(spark, 0)[:2]
    with pytest.raises(ValueError):
        scd2_history(parts[::-1], "k", ["a"])
    with pytest.raises(ValueError):
        scd2_history([], "k", ["a"])
    assert scd2_history(parts, "k", ["a"]).filter(F.col("k").isNull()).count() == 0
