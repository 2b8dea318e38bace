"""Columns that change their type from landing to landing."""

import datetime as dt
import glob
import itertools
import os
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from chainyard.sources.landing import load_log, load_raw, read_raw
from chainyard.sources.reconcile import agreed, common_type, schema_groups

D, I, L, S = T.DecimalType, T.IntegerType(), T.LongType(), T.StringType()
TYPES = [T.ByteType(), T.ShortType(), I, L, D(5, 2), D(12, 4), D(20, 0), D(38, 0), D(38, 20),
         T.FloatType(), T.DoubleType(), S, T.BooleanType(), T.DateType(), T.TimestampNTZType(),
         T.TimestampType(), T.BinaryType(), T.ArrayType(I)]


@pytest.mark.parametrize("types, want", [
    ([I, L], L), ([T.ByteType(), T.ShortType()], T.ShortType()),
    ([I, D(12, 2)], D(12, 2)), ([L, D(12, 2)], D(21, 2)), ([D(10, 2), D(8, 4)], D(12, 4)),
    ([D(38, 0), D(38, 20)], S), ([I, T.DoubleType()], T.DoubleType()),
    ([T.FloatType(), T.DoubleType()], T.DoubleType()), ([L, T.DoubleType()], S),
    ([D(15, 2), T.DoubleType()], T.DoubleType()), ([D(16, 2), T.DoubleType()], S),
    ([T.DateType(), T.TimestampNTZType()], T.TimestampNTZType()), ([T.DateType(), S], S),
    ([T.BooleanType(), S], S), ([T.BooleanType(), I], None), ([T.DateType(), I], None),
    ([T.TimestampType(), S], None), ([T.BinaryType(), S], None), ([T.ArrayType(I), I], None),
])
def test_common_type(types, want):
    assert common_type(types) == want == common_type(reversed(types))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(TYPES), min_size=1, max_size=5))
def test_common_type_needs_no_order(types):
    assert len({str(common_type(p)) for p in itertools.islice(itertools.permutations(types), 24)}) == 1
    found = common_type(types)
    if found is not None:  # one more file of the type found changes nothing but whole digits to text
        assert common_type([*types, found]) in (found, S)


def _land(spark, root, name, rows, schema, files=1):
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(f"{root}/{name}")


def test_days_of_differing_types_load_without_loss(spark, localdir, tmp):
    land, raw, log = f"{localdir}/land", f"{tmp}/raw", f"{tmp}/log"
    _land(spark, land, "d1", [(1, 7), (2, None)], "id int, q int")
    _land(spark, land, "d2", [(3, 2 ** 40)], "id int, q long", 2)
    assert load_raw(spark, land, raw, log) == len(glob.glob(f"{land}/*/*.parquet"))
    assert dict(read_raw(spark, raw, log).dtypes) == {"id": "int", "q": "bigint"}
    _land(spark, land, "d3", [(4, Decimal("1.25"), "new")], "id int, Q decimal(10,2), extra string")
    _land(spark, land, "d4", [(2 ** 50, Decimal("-3.125"))], "id long, q decimal(9,3)")
    assert load_raw(spark, land, raw, log) == 2
    assert load_raw(spark, land, raw, log) == 0
    got = read_raw(spark, raw, log)
    assert dict(got.dtypes) == {"id": "bigint", "q": "decimal(22,3)", "extra": "string"}
    assert {(r.id, r.q, r.extra) for r in got.collect()} == {
        (1, Decimal(7), None), (2, None, None), (3, Decimal(2 ** 40), None),
        (4, Decimal("1.25"), "new"), (2 ** 50, Decimal("-3.125"), None)}


def test_a_column_turned_to_text(spark, localdir, tmp):
    land, raw, log = f"{localdir}/land", f"{tmp}/raw", f"{tmp}/log"
    _land(spark, land, "d1", [(1, 0.1, dt.date(2024, 1, 2))], "id int, x double, d date")
    load_raw(spark, land, raw, log)
    _land(spark, land, "d2", [(2, "n/a", "soon")], "id int, x string, d string")
    load_raw(spark, land, raw, log)
    assert {tuple(r) for r in read_raw(spark, raw, log).select("id", "x", "d").collect()} == {
        (1, "0.1", "2024-01-02"), (2, "n/a", "soon")}


def test_impossible_types_are_refused_by_name_and_tried_again(spark, localdir, tmp):
    land, raw, log = f"{localdir}/land", f"{tmp}/raw", f"{tmp}/log"
    _land(spark, land, "d1", [(1, dt.date(2024, 1, 2))], "id int, day date")
    load_raw(spark, land, raw, log)
    _land(spark, land, "d2", [(2, 20240103)], "id int, day int")
    _land(spark, land, "d3", [(3, dt.datetime(2024, 1, 4, 5))], "id int, day timestamp_ntz")
    assert load_raw(spark, land, raw, log) == 1
    assert {(r.id, r.day) for r in read_raw(spark, raw, log).collect()} == {
        (1, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 4, 5))}
    [bad] = load_log(spark, log).filter("error is not null").collect()
    assert os.path.basename(os.path.dirname(bad.path)) == "d2"
    assert bad.error == "column day: int does not go with date"
    assert load_raw(spark, land, raw, log) == 0  # tried again, refused again


def test_damage_beside_differing_types(spark, localdir, tmp):
    land = f"{localdir}/land"
    _land(spark, land, "d1", [(1,)], "id int")
    _land(spark, land, "d2", [(2 ** 40,)], "id long")
    with open(f"{land}/junk.parquet", "w") as f:
        f.write("no table")
    assert load_raw(spark, land, f"{tmp}/raw", f"{tmp}/log") == 2
    assert sorted(r.id for r in read_raw(spark, f"{tmp}/raw", f"{tmp}/log").collect()) == [1, 2 ** 40]


def test_log_of_loads_without_schemas(spark, localdir, tmp):
    land, raw, log = f"{localdir}/land", f"{tmp}/raw", f"{tmp}/log"
    _land(spark, land, "d1", [(1,)], "id int")
    load_raw(spark, land, raw, log)
    old = f"{tmp}/old"
    load_log(spark, log).drop("schema").write.json(old)
    _land(spark, land, "d2", [(2 ** 40,)], "id long")
    load_raw(spark, land, raw, old)
    assert sorted(r.id for r in read_raw(spark, raw, old).collect()) == [1, 2 ** 40]


def test_files_of_one_schema_are_one_scan(spark, localdir):
    _land(spark, localdir, "a", [(k,) for k in range(20)], "id int", 5)
    _land(spark, localdir, "b", [(k,) for k in range(20)], "id long", 5)
    _land(spark, localdir, "c", [(k, "x") for k in range(20)], "id int, more string", 5)
    files = [f"file:{p}" for p in glob.glob(f"{localdir}/*/*.parquet")]
    groups = schema_groups(spark, files)
    assert sorted(len(g.paths) for g in groups) == [5, 10]
    assert agreed([])[1:] == ([], {}) and schema_groups(spark, []) == []
