"""Drops of tables whose first part holds no row."""
import os

from pyspark.sql import functions as F

from chainyard.sources.files import empty_files, list_files, read_batch
from chainyard.sources.landing import land, load_log, load_raw, read_raw
from chainyard.testing.queries import _drop


def test_drop_leaves_no_file_without_rows(spark, tmp):
    late = spark.range(0, 40, 1, 4).filter("id >= 10").select(F.col("id").cast("string").alias("id"))
    for fmt in ("csv", "json", "text"):
        _drop(late, f"{tmp}/{fmt}", fmt)
        assert empty_files(spark, f"{tmp}/{fmt}") == []
        assert list_files(spark, f"{tmp}/{fmt}").count() == 3
    for fmt in ("csv", "json"):
        batch = read_batch(spark, f"{tmp}/{fmt}", late.schema)
        assert batch.rejected == []
        assert batch.data.count() == 30


def test_load_logs_files_of_no_byte(spark, tmp):
    land(spark.range(5), f"{tmp}/landing/a")
    hollow = f"{tmp}/landing/a/cut-off.parquet".removeprefix("file:")
    open(hollow, "w").close()
    assert load_raw(spark, f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/log") > 0
    assert load_raw(spark, f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/log") == 0  # tried again
    errors = load_log(spark, f"{tmp}/log").filter("error is not null").select("path", "error").distinct().collect()
    assert [(os.path.basename(r.path), r.error) for r in errors] == [("cut-off.parquet", "file is empty")]
    assert read_raw(spark, f"{tmp}/raw", f"{tmp}/log").count() == 5


def test_compressed_drops_are_read(spark, tmp):
    rows = spark.range(20).select("id", F.lit("x").alias("v"))
    for fmt in ("csv", "json"):
        _drop(rows, f"{tmp}/{fmt}", fmt, compression="gzip")
        batch = read_batch(spark, f"{tmp}/{fmt}", rows.schema)
        assert batch.rejected == [] and batch.data.count() == 20
