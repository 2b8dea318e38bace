import hashlib

from pyspark.sql import functions as F

from chainyard.functions.columns import (SURROGATE_NULL, day_diff, delivery_status,
                                         iso_to_timestamp, stock_level, surrogate_key)


def test_stock_level_nulls(spark):
    df = spark.createDataFrame([(None, 10), (5, None), (0, None), (0, 10), (7, 10), (11, 10)],
                               "q int, t int")
    got = [r[0] for r in df.select(stock_level("q", "t")).collect()]
    assert got == ["IN_STOCK", "IN_STOCK", "OUT_OF_STOCK", "OUT_OF_STOCK", "LOW_STOCK",
                   "IN_STOCK"]


def test_delivery_status_nulls(spark):
    df = spark.createDataFrame(
        [(None, "2024-01-05"), ("2024-01-03", None), ("2024-01-05", "2024-01-05"),
         ("2024-01-06", "2024-01-05")], "a string, e string"
    ).select(F.col("a").cast("date").alias("a"), F.col("e").cast("date").alias("e"))
    assert [r[0] for r in df.select(delivery_status("a", "e")).collect()] == [
        "PENDING", "LATE", "ON_TIME", "LATE"]


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([("w", None)], "a string, b string")
    got = df.select(surrogate_key("a", "b")).first()[0]
    assert got == hashlib.md5(f"w-{SURROGATE_NULL}".encode()).hexdigest()


def test_day_diff_counts_calendar_days(spark):
    df = spark.createDataFrame([("2024-01-01 23:00:00", "2024-01-02 01:00:00")], "a string, b string")
    got = df.select(day_diff(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")))
    assert got.first()[0] == 1


def test_iso_parse_defaults_to_epoch(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456+00:00",), (None,), ("",)], "s string")
    got = [str(r[0]) for r in df.select(iso_to_timestamp("s")).collect()]
    assert got == ["2024-01-02 03:04:05.123456", "1970-01-01 00:00:00", "1970-01-01 00:00:00"]


def test_file_extension(spark):
    from chainyard.functions.columns import file_extension
    df = spark.createDataFrame([("s3a://b/raw/x/Data.JSON",), ("/a/b.c/noext",), ("f.tar.gz",)],
                               "p string")
    assert [r[0] for r in df.select(file_extension("p")).collect()] == [".json", "", ".gz"]
