import pytest

from chainyard.operators.quality import QualityGateError, SUITE, DataTest, gate, run_suite


def test_counts_and_gate(spark):
    child = spark.createDataFrame([(1, "a", -1), (2, "a", 0), (None, "b", 5), (4, None, 3)],
                                  "id int, k string, q int")
    parent = spark.createDataFrame([("a",)], "k string")
    tests = [DataTest("c", "id", "not_null"), DataTest("c", "k", "unique"),
             DataTest("c", "k", "relationships", "p", "k"), DataTest("c", "q", "positive_value"),
             DataTest("c", "q", "not_negative"),
             DataTest("c", "k", "accepted_values", values=("a",), name="valid_k")]
    res = {(r.column_name, r.test): r.failures
           for r in run_suite(spark, {"c": child, "p": parent}, tests).collect()}
    assert res == {("id", "not_null"): 1, ("k", "unique"): 1, ("k", "relationships"): 1,
                   ("q", "positive_value"): 2, ("q", "not_negative"): 1, ("k", "valid_k"): 1}
    with pytest.raises(QualityGateError):
        gate(run_suite(spark, {"c": child, "p": parent}, tests))
    assert gate(run_suite(spark, {"c": child}, [DataTest("c", "q", "not_null")])) == []


def test_suite_inventory_counts():
    kinds = [t.kind for t in SUITE]
    assert kinds.count("not_null") == 51
    assert kinds.count("unique") == 20
    assert kinds.count("relationships") == 4


def test_unique_reads_a_frame_once_unless_hashes_repeat(spark, tmp):
    spark.range(1000).selectExpr("concat('a long value of its own ', id) as k").write.parquet(f"{tmp}/c")
    spark.range(1000).selectExpr("concat('v', id % 990) as k", "id").write.parquet(f"{tmp}/d")
    c, d = spark.read.parquet(f"{tmp}/c"), spark.read.parquet(f"{tmp}/d")
    once = run_suite(spark, {"c": c}, [DataTest("c", "k", "unique")])
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()  # its values are not shuffled
    both = run_suite(spark, {"c": c, "d": d}, [DataTest("c", "k", "unique"), DataTest("d", "k", "unique"),
                                               DataTest("d", "id", "unique")])
    assert [r.failures for r in both.collect()] == [0, 10, 0]
