import pytest

from chainyard.operators.merge import (DuplicateKeyError, merge_incremental, new_since)

S = "k string, v int, _ingestion_timestamp string"


def _df(spark, rows, schema=S):
    return spark.createDataFrame(rows, schema)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_and_idempotence(spark):
    target = _df(spark, [("a", 1, "t1"), ("b", 1, "t1")])
    batch = _df(spark, [("b", 2, "t2"), ("c", 2, "t2")])
    once = merge_incremental(target, batch, "k")
    twice = merge_incremental(once, batch, "k")
    assert _rows(once) == _rows(twice) == [("a", 1, "t1"), ("b", 2, "t2"), ("c", 2, "t2")]


def test_duplicate_key_in_batch_latest_wins_or_strict_raises(spark):
    batch = _df(spark, [("a", 1, "t1"), ("a", 2, "t3"), ("a", 3, "t2")])
    assert _rows(merge_incremental(None, batch, "k")) == [("a", 2, "t3")]
    with pytest.raises(DuplicateKeyError):
        merge_incremental(None, batch, "k", strict=True)


def test_null_key_never_matches(spark):
    target = _df(spark, [(None, 1, "t1")])
    out = merge_incremental(target, _df(spark, [(None, 2, "t2")]), "k")
    assert _rows(out) == [(None, 1, "t1"), (None, 2, "t2")]


def test_schema_sync_adds_and_drops(spark):
    target = _df(spark, [("a", 1, "t1", "old")], S + ", legacy string")
    batch = _df(spark, [("b", 2, "t2", 9)], S + ", extra int")
    out = merge_incremental(target, batch, "k")
    assert out.columns == ["k", "v", "_ingestion_timestamp", "extra"]
    assert _rows(out) == [("a", 1, "t1", None), ("b", 2, "t2", 9)]


def test_new_since_is_strict_and_handles_empty_target(spark):
    staged = _df(spark, [("a", 1, "t1"), ("b", 1, "t2"), ("c", 1, "t3")])
    target = _df(spark, [("x", 0, "t2")])
    assert [r.k for r in new_since(staged, target).collect()] == ["c"]
    empty = target.limit(0)
    assert new_since(staged, empty).count() == 3
    assert new_since(staged, empty, empty_target="none").count() == 0
    assert new_since(staged, None).count() == 3


def _merge(spark, store, rows, schema, part="m"):
    from pyspark.sql import functions as F
    from chainyard.operators.merge import merge_into_partitions
    batch = spark.createDataFrame(rows, schema)
    store.publish({("t", None): merge_into_partitions(store, "t", batch, "k", F.col(part))})
    return store.read("t")


def test_key_that_moves_to_another_month_keeps_one_row(spark, tmp):
    from chainyard.store import TableStore
    store, schema = TableStore(spark, tmp), "k string, m string, _ingestion_timestamp string"
    _merge(spark, store, [("a", "202401", "t1"), ("b", "202403", "t1")], schema)
    got = _merge(spark, store, [("a", "202402", "t2")], schema)
    assert _rows(got) == [("a", "202402", "t2"), ("b", "202403", "t1")]
    # the month it left is empty now
    assert store.read("t", partitions=["202401"]).count() == 0
    assert _rows(_merge(spark, store, [("a", "202401", "t3")], schema)) == [
        ("a", "202401", "t3"), ("b", "202403", "t1")]
    assert store.watermark("t") == "t3"


def test_month_merge_with_new_and_dropped_columns_and_empty_batches(spark, tmp):
    from chainyard.store import TableStore
    store, schema = TableStore(spark, tmp), "k string, m string, old int"
    assert _merge(spark, store, [], schema).count() == 0
    _merge(spark, store, [("a", "202401", 1), ("b", "202402", 1)], schema)
    got = _merge(spark, store, [("b", "202402", 9)], "k string, m string, new int")
    assert got.columns == ["k", "m", "new"]
    assert _rows(got.fillna(-1)) == [("a", "202401", -1), ("b", "202402", 9)]
    assert TableStore(spark, tmp).read("t").count() == 2   # by another reader, from the log
    assert _merge(spark, store, [], "k string, m string, new int").count() == 2
