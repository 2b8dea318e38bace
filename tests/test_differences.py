"""The rows in which a copy differs from its source."""

import pytest
from pyspark.sql import functions as F

from chainyard.operators.differences import checksum_tree, differing_parts, differing_rows

SCHEMA = "id int, month string, price double, _run_id string"
ROWS = [(1, "a", 1.5, "r"), (2, "a", None, "r"), (2, "a", None, "r"), (None, None, 0.0, "r"),
        (3, "b", float("nan"), "r"), (4, "b", 2.0, "r")]


def _found(spark, copy, **kw):
    rows = differing_rows(spark.createDataFrame(ROWS, SCHEMA), copy, part="month", **kw).collect()
    return sorted(((r.finding, r.copies, r.id, r.price) for r in rows), key=str)


def test_equal_copies_in_any_order_differ_nowhere(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    copy = spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(3).withColumn("_run_id", F.lit("x"))
    assert _found(spark, copy) == []
    assert differing_parts(source, copy, part="month").count() == 0
    assert sum(r.n_rows for r in checksum_tree(source, "month").collect()) == len(ROWS)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_lost_changed_and_repeated_rows_are_named(spark, buckets):
    rows = [ROWS[0], ROWS[1], ROWS[3], ROWS[3], ROWS[3], ROWS[4], (4, "b", 2.5, "r")]
    got = _found(spark, spark.createDataFrame(rows, SCHEMA), buckets=buckets)
    assert got == [("extra", 1, 4, 2.5), ("extra", 2, None, 0.0), ("missing", 1, 2, None),
                   ("missing", 1, 4, 2.0)]


def test_rows_without_a_part_and_parts_on_one_side_alone(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    parts = differing_parts(source, source.filter("month = 'a'"), part="month").collect()
    assert {(r.part, r.rows_source, r.rows_copy) for r in parts} == {("b", 2, 0), ("(none)", 1, 0)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert differing_rows(none, none).count() == 0
    assert len(_found(spark, none)) == 5  # the repeated row counts as one with two copies


def test_other_columns_raise(spark):
    source = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError, match="id, price"):
        differing_rows(source, source.drop("price").withColumn("id", F.col("id").cast("long")))


def test_only_rows_of_differing_buckets_are_compared(spark):
    from chainyard.operators.differences import _differing, _placed
    source = spark.range(20000).selectExpr("id", "id % 12 as month", "cast(id as string) as name")
    copy = source.withColumn("name", F.when(F.col("id") == 77, "odd").otherwise(F.col("name")))
    sides = [_placed(df, ["id", "month", "name"], "month", 1000) for df in (source, copy)]
    found = _differing(*sides)
    assert found.count() == 2  # the changed row as it was and as it is
    read = sum(side.join(found, ["_part", "_bucket"], "left_semi").count() for side in sides)
    assert 2 <= read <= 40
    assert "BroadcastHashJoin" in sides[0].join(found, ["_part", "_bucket"], "left_semi")._jdf.queryExecution().toString()
