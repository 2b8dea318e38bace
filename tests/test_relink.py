import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chainyard.operators.relink import interval_changes, relink_partitions
from chainyard.operators.temporal import pit_join
from chainyard.store import TableStore

T0 = dt.datetime(2024, 1, 1)
KIND = "product_id string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz"
def MONTH():
    return F.date_format("ts", "yyyyMM")



def history(spark, spans):
    """Versions from {key: [(name, first day, last day or None)]}."""
    day = lambda d: None if d is None else T0 + dt.timedelta(hours=6 + 24 * d)
    return spark.createDataFrame([(k, s, day(a), day(b)) for k, own in spans.items()
                                  for s, a, b in own], KIND)


def test_intervals_of_each_kind_of_change(spark):
    old = history(spark, {"same": [("a", 0, None)], "closed": [("a", 0, None)], "gone": [("a", 3, 9)],
                          "longer": [("a", 0, 5), ("b", 5, None)], "payload": [("a", 0, 4)]})
    new = history(spark, {"same": [("a", 0, None)], "closed": [("a", 0, 7), ("b", 7, None)],
                          "fresh": [("a", 2, None)], "longer": [("a", 0, 8), ("b", 8, None)],
                          "payload": [("z", 0, 4)]})
    got = {(r.product_id, (r.since - T0).days, r.until and (r.until - T0).days)
           for r in interval_changes(old, new, "product_id", "sk").collect()}
    assert got == {("closed", 7, None), ("gone", 3, 9), ("fresh", 2, None), ("longer", 5, 8),
                   ("longer", 5, None), ("longer", 8, None), ("payload", 0, 4)}


def random_history(spark, rng):
    spans = {}
    for k in range(12):
        cut = sorted(rng.sample(range(300), 4))
        spans[f"p{k}"] = [(f"v{a}-{rng.randrange(3)}", a, b) for a, b in zip(cut, cut[1:] + [None])
                          if rng.random() < 0.8]
    return spans


@pytest.mark.parametrize("seed,as_date", [(0, False), (1, False), (2, True), (3, True)])
def test_equals_a_full_rebuild(spark, tmp, seed, as_date):
    rng = random.Random(seed)
    before = random_history(spark, rng)
    after = dict(before, **{k: v for k, v in random_history(spark, rng).items() if rng.random() < 0.3})
    if "p1" in after and after["p1"]:  # a version that ends sooner, within a day
        s, a, b = after["p1"][-1]
        after["p1"] = [*after["p1"][:-1], (s, a, a + 1), ("late", a + 1, b)]
    old, new = history(spark, before), history(spark, after)
    facts = spark.createDataFrame(
        [(i, rng.choice([None, *[f"p{k}" for k in range(14)]]),
          T0 + dt.timedelta(hours=rng.randrange(320 * 24))) for i in range(800)],
        "id long, product_id string, ts timestamp_ntz")
    link = lambda v: pit_join(facts, v, "product_id", "ts", as_date=as_date)
    store = TableStore(spark, tmp)
    store.commit("f", link(old), part_expr=MONTH())
    v = relink_partitions(store, "f", interval_changes(old, new, "product_id", "sk"), new,
                          "product_id", "ts", "id", MONTH(), as_date=as_date)
    store.publish({("f", None): v})
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert rows(store.read("f")) == rows(link(new))


def test_months_without_a_change_are_not_written(spark, tmp):
    old = history(spark, {"p": [("a", 0, None)], "q": [("a", 0, None)]})
    new = history(spark, {"p": [("a", 0, 40), ("b", 40, 45), ("c", 45, None)], "q": [("a", 0, None)]})
    facts = spark.createDataFrame(
        [(i, "q" if d > 60 else "p", T0 + dt.timedelta(days=d)) for i, d in enumerate(range(0, 120, 10))],
        "id long, product_id string, ts timestamp_ntz")
    store = TableStore(spark, tmp)
    store.commit("f", pit_join(facts, old, "product_id", "ts"), part_expr=MONTH())
    changes = interval_changes(old, new, "product_id", "sk")
    store.publish({("f", None): relink_partitions(store, "f", changes, new, "product_id", "ts", "id",
                                                  MONTH())})
    assert store.history("f").collect()[-1].partitions == ["202402", "202403"]
    assert relink_partitions(store, "f", changes.limit(0), new, "product_id", "ts", "id", MONTH()) is None
    assert relink_partitions(store, "none", changes, new, "product_id", "ts", "id", MONTH()) is None


def test_facts_of_unchanged_keys_are_written_from_where_they_lie(spark, tmp, monkeypatch):
    from chainyard.operators import joins
    old = history(spark, {"p": [("a", 0, None)], "q": [("a", 0, None)]})
    new = history(spark, {"p": [("a", 0, 40), ("b", 40, None)], "q": [("a", 0, None)]})
    facts = spark.createDataFrame(
        [(i, "pq"[i % 2], T0 + dt.timedelta(days=d)) for i, d in enumerate(range(0, 120, 10))],
        "id long, product_id string, ts timestamp_ntz")
    monkeypatch.setattr(joins.checked_broadcast, "__defaults__", (0,))
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (0,))
    store, laid = TableStore(spark, tmp), []
    store.commit("f", pit_join(facts, old, "product_id", "ts"), part_expr=MONTH())
    stage = store.stage
    monkeypatch.setattr(store, "stage", lambda *a, **kw: (laid.append(kw.get("laid")), stage(*a, **kw))[1])
    store.publish({("f", None): relink_partitions(
        store, "f", interval_changes(old, new, "product_id", "sk"), new, "product_id", "ts", "id", MONTH())})
    assert {r.product_id for r in laid[0].collect()} == {"q"}
    assert "hashpartitioning" not in laid[0]._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert rows(store.read("f")) == rows(pit_join(facts, new, "product_id", "ts"))
