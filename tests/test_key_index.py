import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainyard.operators import key_index
from chainyard.operators.merge import merge_into_partitions
from chainyard.store import TableStore


def test_every_key_is_found_and_few_others(spark):
    rows = spark.range(30_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 2).alias("n"),
                                      (F.col("id") % 7).cast("string").alias("part"))
    rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("k"),
                                                  F.lit(0).cast("bigint").alias("n"), F.lit("none").alias("part")))
    index = key_index.build(rows, ["k", "n"], "part").cache()
    assert {r.part for r in index.select("part").distinct().collect()} == set("0123456")
    one = lambda i: rows.filter(F.col("k") == f"k{i}")
    for i in (0, 11, 29_999):
        assert str(i % 7) in key_index.parts_with(index, one(i), ["k", "n"])
    assert key_index.parts_with(index, rows, ["k", "n"]) == list("0123456")
    assert key_index.parts_with(index, rows.limit(0), ["k", "n"]) == []
    assert key_index.parts_with(index, rows.filter("k IS NULL"), ["k", "n"]) == []
    others = spark.range(300).select(F.concat(F.lit("x"), "id").alias("k"), F.lit(0).cast("bigint").alias("n"))
    assert len(key_index.parts_with(index, others, ["k", "n"])) <= 2


def shipped(spark, rows):
    return spark.createDataFrame([(i, dt.date(2024, m, 5), v) for i, m, v in rows],
                                 "id string, day date, v int")


def test_merge_reads_the_named_months_only(spark, tmp):
    store, month = TableStore(spark, tmp), F.date_format("day", "yyyyMM")

    def merge(rows, **kw):
        v = merge_into_partitions(store, "t", shipped(spark, rows), "id", month, index=True, **kw)
        store.publish({("t", None): v})
        return store.last_merge.get("t")

    table = {f"{m}-{k}": (m, 0) for m in range(1, 13) for k in range(200)}
    assert merge([(i, m, v) for i, (m, v) in table.items()]) is None
    # a key moves from March to May, one is new, one without a key
    report = merge([("3-7", 5, 1), ("new", 6, 1), (None, 6, 2)])
    table.update({"3-7": (5, 1), "new": (6, 1)})
    assert report["indexed"] and report["own"] == ["202405", "202406"] and report["moved"] == ["202403"]
    assert report["false_hits"] == len(report["named"]) - 1 <= 2
    assert store.history("t").collect()[-1].partitions == ["202403", "202405", "202406"]
    # back again: the index of each month is that of its newest version
    assert merge([("3-7", 4, 2)])["moved"] == ["202405"]
    table["3-7"] = (4, 2)
    assert merge([("9-9", 9, 3)])["moved"] == []
    table["9-9"] = (9, 3)
    got = {(r.id, r.day.month, r.v) for r in store.read("t").collect()}
    assert got == {(i, *x) for i, x in table.items()} | {(None, 6, 2)}


@pytest.mark.parametrize("kind", ["bigint", "decimal(10,0)"])
def test_scans_where_the_index_cannot_tell(spark, tmp, kind):
    """A version without an index, or keys of another type: every month's keys are read."""
    store, month = TableStore(spark, tmp), F.date_format("day", "yyyyMM")
    first = spark.range(40).select(F.col("id").cast("int"), F.make_date(
        F.lit(2024), (F.col("id") % 12 + 1).cast("int"), F.lit(3)).alias("day"))
    store.publish({("t", None): merge_into_partitions(store, "t", first, "id", month,
                                                      index=kind != "bigint")})
    moved = spark.createDataFrame([(5, dt.date(2024, 12, 1))], "id int, day date")
    moved = moved.withColumn("id", F.col("id").cast("int" if kind == "bigint" else kind))
    v = merge_into_partitions(store, "t", moved, "id", month, index=True)
    store.publish({("t", None): v})
    assert store.last_merge["t"]["indexed"] is False and store.last_merge["t"]["moved"] == ["202406"]
    assert sorted(int(r.id) for r in store.read("t").collect()) == list(range(40))
