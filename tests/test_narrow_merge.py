"""Merges of stored tables that look repeated and matching keys up by hash."""
from chainyard.operators import dedupe, joins, merge
from chainyard.store import TableStore
from pyspark.sql import functions as F


def _rows(spark, a, b, stamp, month="199801"):
    return spark.range(a, b).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(month).alias("m"),
                                    F.lit(stamp).alias("_ingestion_timestamp"))


def test_rows_are_not_shuffled_for_keys_that_do_not_repeat(spark, tmp):
    TableStore(spark, tmp).commit("t", _rows(spark, 0, 50, "a"))
    stored = TableStore(spark, tmp).read("t")
    plan = dedupe.latest_of_stored(stored, "k")._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_large_batches_merge_alike(spark, tmp, monkeypatch):
    old, batch = _rows(spark, 0, 60, "a"), _rows(spark, 50, 90, "b", "199802")
    batch = batch.unionByName(_rows(spark, 85, 90, "c")).unionByName(
        spark.sql("select cast(null as string) k, '199801' m, 'd' _ingestion_timestamp from range(2)"))
    want = sorted(map(str, merge.merge_incremental(old, batch, "k").collect()))
    assert len(want) == 92
    for bound in (0, 7, 500_000):  # no key fits a broadcast, those that meet do not, all do
        monkeypatch.setattr(merge, "checked_broadcast", lambda df, b=bound: (
            (F.broadcast(df), True) if df.count() <= b else (df, False)))
        monkeypatch.setattr(merge, "keys_held", lambda own, held, keys, b=bound: joins.keys_held(
            own, held, keys, 20 if b else 0))
        monkeypatch.setattr(dedupe, "BROADCAST_MAX_ROWS", bound)
        store = TableStore(spark, f"{tmp}-{bound}")
        for df in (old, batch):
            store.publish({("t", None): merge.merge_into_partitions(store, "t", df, "k", F.col("m"))})
        assert sorted(map(str, store.read("t").select("k", "m", "_ingestion_timestamp").collect())) == want
