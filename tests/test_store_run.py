import pytest
from pyspark.sql import functions as F

from chainyard.operators.quality import QualityGateError
from chainyard.plans.run import run_batch
from chainyard.store import TableStore
from chainyard.testing import fixtures as fx
from chainyard.testing.scenario import first_run

SF = "/root/testdata/sf0.001"


def _raw(spark, run):
    raw = {e: fx.RAW[e](spark, SF) for e in ("suppliers", "warehouses", "stores")}
    raw["products"] = fx.product_batch(spark, SF, run, fx.PRODUCT_RUNS)
    for e in ("sales", "shipments", "inventory"):
        r = fx.RAW[e](spark, SF)
        raw[e] = first_run(r) if run == 1 else r
    return raw


def test_versions_publish_and_read(spark, tmp):
    store = TableStore(spark, tmp)
    df = spark.range(3)
    assert store.read("t") is None
    v1 = store.commit("t", df, "raw")
    v2 = store.stage("t", df.filter("id > 0"), "raw")
    assert (v1, v2) == (1, 2)
    assert store.read("t", "RAW").count() == 3          # v2 staged, not published
    store.publish({("t", "raw"): v2})
    assert store.read("t", "RAW").count() == 2
    assert TableStore(spark, tmp).version("t", " raw ") == 2   # log read by a new reader


def test_two_runs_then_failing_gate_publishes_nothing(spark, tmp):
    store = TableStore(spark, tmp)
    for run, ts in enumerate(fx.PRODUCT_RUNS, start=1):
        run_batch(spark, store, _raw(spark, run), ts, fx.AS_OF, calendar=fx.CALENDAR)
    n_sales = fx.raw_sales(spark, SF).count()
    assert store.read("fct_sales", "MARTS").count() == n_sales
    snap = store.read("snap_products", "SNAPSHOTS")
    assert snap.filter("is_current").count() == fx.raw_products(spark, SF).count()
    before = {t: store.version(t, "MARTS") for t in ("fct_sales", "dim_product")}
    bad = _raw(spark, 2)
    bad["sales"] = bad["sales"].withColumn("store_id", F.lit(None).cast("string"))
    with pytest.raises(QualityGateError):
        run_batch(spark, store, bad, "1999-01-01 00:00:00", fx.AS_OF, calendar=fx.CALENDAR)
    store.refresh()
    assert {t: store.version(t, "MARTS") for t in before} == before


def test_stream_merges_only_new_files(spark, tmp):
    from chainyard.streaming.ingest import file_stream, merge_stream_into
    schema = "k string, v int, _ingestion_timestamp string"
    store = TableStore(spark, f"{tmp}/store")
    counts = []
    drops = [[("a", 1, "t1"), ("b", 1, "t1")], [("b", 2, "t2")], None]
    for i, rows in enumerate(drops):
        if rows:
            spark.createDataFrame(rows, schema).write.json(f"{tmp}/land/d{i}")
        s = file_stream(spark, f"{tmp}/land", spark.createDataFrame([], schema).schema,
                        recursiveFileLookup="true")
        counts.append(merge_stream_into(s, store, "t", "k", f"{tmp}/ckpt"))
    assert counts == [1, 1, 0]
    assert sorted(tuple(r) for r in store.read("t").collect()) == [("a", 1, "t1"), ("b", 2, "t2")]


def test_partitioned_versions_rewrite_only_touched_months(spark, tmp):
    from pyspark.sql import functions as F
    from chainyard.operators.merge import merge_into_partitions
    store = TableStore(spark, tmp)
    schema = "k string, month string, v int, _ingestion_timestamp string"
    month = F.col("month")
    first = spark.createDataFrame([("a", "202401", 1, "t1"), ("b", "202402", 1, "t1"),
                                   ("c", "202403", 1, "t1")], schema)
    store.publish({("f", None): merge_into_partitions(store, "f", first, "k", month)})
    batch = spark.createDataFrame([("b", "202402", 2, "t2"), ("d", "202402", 2, "t2")], schema)
    v2 = merge_into_partitions(store, "f", batch, "k", month)
    store.publish({("f", None): v2})
    got = sorted((r.k, r.v) for r in store.read("f").collect())
    assert got == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    # version 2 holds only the touched month
    files = spark.read.parquet(store.path("f", v2)).select("__part").distinct().collect()
    assert [r[0] for r in files] == ["p202402"]
    assert sorted(r.k for r in store.read("f", partitions=["202401"]).collect()) == ["a"]
    assert sorted(r.k for r in store.read("f", version=1).collect()) == ["a", "b", "c"]
    v3 = store.compact("f", month)
    assert sorted((r.k, r.v) for r in store.read("f").collect()) == got
    assert store.history("f").filter(f"version = {v3}").first().partitions is None


def test_run_batch_with_month_partitioned_facts(spark, tmp):
    store = TableStore(spark, tmp)
    for run, ts in enumerate(fx.PRODUCT_RUNS, start=1):
        run_batch(spark, store, _raw(spark, run), ts, fx.AS_OF, calendar=fx.CALENDAR,
                  partition_facts=True)
    for name, entity in (("fct_sales", "sales"), ("fct_inventory", "inventory")):
        got = store.read(name, "MARTS")
        assert got.count() == fx.RAW[entity](spark, SF).count()
        assert "__part" not in got.columns
    key_counts = store.read("fct_sales", "MARTS").groupBy("transaction_id").count()
    assert key_counts.filter("count > 1").count() == 0


def test_a_merge_leaves_neither_its_batch_nor_its_shuffles(spark, tmp):
    import os
    import time
    from chainyard.operators.merge import merge_into_partitions
    from chainyard.session import SHUFFLE_CLEANUP

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}

    store = TableStore(spark, tmp)
    before, conf = shuffles(), spark.conf.get(SHUFFLE_CLEANUP, None)
    for n in (50, 80):
        batch = spark.range(n).selectExpr("id as k", "id % 3 as m", "'x' as v").repartition(3)
        v = merge_into_partitions(store, "t", batch, "k", F.col("m"))
        store.publish({("t", None): v})
    assert os.listdir(f"{tmp.removeprefix('file:')}/_aside") == []
    time.sleep(1)  # files are deleted beside the next query
    assert not shuffles() - before
    assert store.read("t").count() == 80
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == conf
