"""As-of join by one sort against the point-in-time join and a plain search."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainyard.operators.temporal import asof_join, pit_join

T0 = dt.datetime(2024, 1, 1)


def hour(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


def tables(spark, seed, fact_type="string", version_type="string", keys=5):
    """Facts, a third or more of key 1, and versions with gaps; NULL and unknown
    keys, NULL instants, repeated rows."""
    rng = random.Random(seed)
    as_ = {"string": str, "int": int, "bigint": int, "decimal(10,2)": Decimal, "double": float}
    versions = []
    for k in range(1, keys + 1):
        at = sorted(rng.sample(range(200), 12))
        for a, b in zip(at, at[1:] + [None]):
            if rng.random() < 0.8:
                versions.append((as_[version_type](k), f"v{k}-{a}", hour(a), hour(b)))
    facts = []
    for i in range(600):
        k = rng.choice([1, 1, 1, *range(1, keys + 2), None])
        facts.append((i // 2, None if k is None else as_[fact_type](k),
                      hour(rng.choice([None, *range(-5, 205)]) if i % 7 == 0 else rng.randrange(200))))
    v = spark.createDataFrame(versions, f"k {version_type}, sk string, valid_from timestamp_ntz, "
                                        "valid_to timestamp_ntz")
    return spark.createDataFrame(facts, f"id long, k {fact_type}, ts timestamp_ntz"), v, facts, versions


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


TYPES = [("string", "string"), ("int", "bigint"), ("int", "decimal(10,2)"), ("bigint", "string"),
         ("decimal(10,2)", "bigint"), ("string", "int"), ("int", "double")]


@pytest.mark.parametrize("of_fact,of_version", TYPES)
def test_all_plans_agree_for_any_types(spark, of_fact, of_version):
    f, v, facts, versions = tables(spark, 1, of_fact, of_version)
    want = []
    for i, k, t in facts:
        sk = next((s for q, s, a, b in versions if k is not None and t is not None
                   and float(q) == float(k) and a <= t and (b is None or t < b)), None)
        want.append(tuple(map(str, (i, k if of_fact != "decimal(10,2)" or k is None
                                    else k.quantize(Decimal("0.01")), t, sk))))
    assert rows(pit_join(f, v, "k", "ts")) == sorted(want)
    assert rows(pit_join(f, v, "k", "ts", broadcast_max_rows=0)) == sorted(want)
    assert rows(asof_join(f, v, "k", "ts", hot_share=0.2, pieces=7)) == sorted(want)
    assert rows(asof_join(f, v, "k", "ts", hot_share=2.0)) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_by_day(spark, seed):
    f, v, *_ = tables(spark, seed)
    want = rows(pit_join(f, v, "k", "ts", as_date=True))
    assert rows(asof_join(f, v, "k", "ts", as_date=True, hot_share=0.1, pieces=5)) == want


def test_two_keys_and_clashing_names(spark):
    f, v, *_ = tables(spark, 4)
    f = f.withColumn("m", F.col("id") % 2).withColumn("f0", F.lit("x")).withColumn("__t", F.lit("y"))
    v = v.withColumn("m", F.lit(1)).withColumn("p1", F.lit("z"))
    want = rows(pit_join(f, v, ["k", "m"], "ts", broadcast_max_rows=0))
    got = asof_join(f, v, ["k", "m"], "ts", hot_share=0.1, pieces=4)
    assert got.columns == [*f.columns, "sk", "p1"] and rows(got) == want


def test_empty_sides(spark):
    f, v, *_ = tables(spark, 5)
    assert asof_join(f.limit(0), v, "k", "ts").collect() == []
    got = asof_join(f, v.limit(0), "k", "ts").collect()
    assert len(got) == 600 and {r.sk for r in got} == {None}


def test_hot_key_is_cut_by_time(spark):
    facts = spark.range(4000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(T0) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"))
    v = spark.createDataFrame([("hot", "open", hour(-10), None)],
                              "k string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = asof_join(facts, v, "k", "ts", hot_share=0.3, pieces=16)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan
    got = out.groupBy("sk").count().collect()
    assert {r.sk: r["count"] for r in got} == {"open": 2666, None: 1334}
