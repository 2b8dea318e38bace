import datetime as dt

from chainyard.operators.temporal import pit_join

T = dt.datetime


def _versions(spark):
    return spark.createDataFrame([
        ("p1", "v1", T(2024, 1, 1), T(2024, 2, 1)),
        ("p1", "v2", T(2024, 2, 1), None),
        ("p2", "w1", T(2024, 1, 1, 6), T(2024, 1, 1, 18)),   # same-day versions
        ("p2", "w2", T(2024, 1, 1, 18), None),
    ], "product_id string, sk string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def _facts(spark):
    return spark.createDataFrame([
        ("f1", "p1", T(2024, 1, 1)),         # = valid_from -> v1
        ("f2", "p1", T(2024, 2, 1)),         # = valid_to of v1 -> v2
        ("f3", "p1", T(2023, 12, 31)),       # before first version -> NULL
        ("f4", "p2", T(2024, 1, 1, 12)),
        ("f5", "p3", T(2024, 1, 1)),         # unknown key -> NULL
    ], "fact_id string, product_id string, ts timestamp_ntz")


def test_half_open_boundaries(spark):
    out = {r.fact_id: r.sk for r in
           pit_join(_facts(spark), _versions(spark), "product_id", "ts").collect()}
    assert out == {"f1": "v1", "f2": "v2", "f3": None, "f4": "w1", "f5": None}


def test_date_form_same_day_later_version_wins(spark):
    out = {r.fact_id: r.sk for r in
           pit_join(_facts(spark), _versions(spark), "product_id", "ts", as_date=True).collect()}
    assert out["f4"] == "w2"


def test_row_count_preserved_and_salting_matches(spark):
    facts = spark.range(0, 3000).selectExpr(
        "concat('f', id) as fact_id",
        "case when id % 3 = 0 then 'p2' else 'p1' end as product_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 60 as int))"
        " as ts")
    plain = pit_join(facts, _versions(spark), "product_id", "ts")
    salted = pit_join(facts, _versions(spark), "product_id", "ts", skew_buckets=8,
                      hot_share=0.2, broadcast_max_rows=None)
    assert plain.count() == 3000 == salted.count()
    assert sorted(plain.collect()) == sorted(salted.collect())
