import os

from chainyard import state
from chainyard.sources.files import read_batch
from chainyard.sources.daily import discover_names

SCHEMA = "id int, name string"


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_layouts_and_rejections(spark, localdir):
    _write(localdir, "a_array_one_line.json", '[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]')
    _write(localdir, "b_array_pretty.json", '[\n  {"id": 3, "name": "c"},\n  {"id": 4, "name": "d"}\n]\n')
    _write(localdir, "c_lines.json", '{"id": 5, "name": "e"}\n{"id": 6, "name": "f"}\n')
    _write(localdir, "d.csv", "id,name\n7,g\n")
    _write(localdir, "e.txt", "id,name\n8,h\n")
    _write(localdir, "f_empty.csv", "")
    _write(localdir, "g_header_only.csv", "id,name\n")
    _write(localdir, "h.xml", "<x/>")
    b = read_batch(spark, localdir, spark.createDataFrame([], SCHEMA).schema)
    assert sorted(r.id for r in b.data.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    reasons = {os.path.basename(p): why for p, why in b.rejected}
    assert reasons == {"f_empty.csv": "file is empty", "g_header_only.csv": "file has no rows",
                       "h.xml": "unsupported extension '.xml'"}
    assert not any(p.endswith("f_empty.csv") for p in b.files)


def test_watermark_is_rounded_down(spark):
    # the listing's comparison is strict: the second before takes in the whole second
    assert state.modified_after_option("2024-01-01T00:00:05.5+00:00") == "2024-01-01T00:00:04"
    assert state.modified_after_option("2024-01-01T02:00:00+02:00") == "2023-12-31T23:59:59"
    assert state.modified_after_option(None) is None


def test_csv_columns_by_header_name(spark, localdir):
    """The declared schema's order is not the file's; one file has a column more."""
    import datetime as dt
    _write(localdir, "a.csv", "warehouse_id,product_id,quantity_available,reorder_threshold,snapshot_date\n"
                              "W1,P1,5,10,2024-01-01\n")
    _write(localdir, "b.csv", "\ufeffNote,snapshot_date,Warehouse_ID,product_id,reorder_threshold,quantity_available\n"
                              "n,2024-01-02,W2,P2,20,6\n")
    _write(localdir, "c.csv", "warehouse_id,product_id\nW3,P3\n")
    _write(localdir, "d.csv", "warehouse_id,warehouse_id\nW3,P3\n")
    schema = spark.createDataFrame([], "product_id string, warehouse_id string, reorder_threshold int, "
                                       "quantity_available int, snapshot_date date").schema
    b = read_batch(spark, localdir, schema)
    rows = {r.product_id: (r.warehouse_id, r.reorder_threshold, r.quantity_available,
                           r.snapshot_date, r.Note) for r in b.data.collect()}
    assert rows == {"P1": ("W1", 10, 5, dt.date(2024, 1, 1), None),
                    "P2": ("W2", 20, 6, dt.date(2024, 1, 2), "n")}
    assert sorted(os.path.basename(p) for p, _ in b.rejected) == ["c.csv", "d.csv"]


def test_json_records_are_never_lost(spark, localdir):
    _write(localdir, "a.json", '{"id": 1, "name": "a"}\n[{"id": 2, "name": "b"}, {"id": 3, "name": "c"}]\n'
                               '{"id": 4, "name": "d"}\n{"id": 5, "name": "e"}\n')
    _write(localdir, "b.json", '[{"id": 6, "name": "f"}]\n[{"id": 7, "name": "g"}, {"id": 8, "name": "h"}]\n')
    _write(localdir, "c.json", '\n\n{\n "id": 9,\n "name": "i"\n}\n')
    _write(localdir, "d.json", '{"id": "x", "name": "b"\n{"id": 10, "name": "j"}\n')
    b = read_batch(spark, localdir, spark.createDataFrame([], SCHEMA).schema, corrupt_col="_corrupt")
    assert sorted(r.id for r in b.data.collect()) == list(range(1, 11))
    assert len(b.corrupt.collect()) == 1


def test_daily_table_names():
    names = ["sales_2024_01_02", "sales_2024_01_01", "sales_x", "salesman", "SALES_2024_1_1",
             "sales/2024/01/03"]
    assert discover_names(names) == ["sales/2024/01/03", "sales_2024_01_01", "sales_2024_01_02"]


def test_state_roundtrip_and_cadence(spark, tmp):
    import datetime as dt
    assert state.load_state(spark, f"{tmp}/s") == {}
    state.save_state(spark, f"{tmp}/s", {})
    assert state.load_state(spark, f"{tmp}/s") == {}
    state.save_state(spark, f"{tmp}/s", {"a": "1"})
    state.save_state(spark, f"{tmp}/s", {"a": "2", "b": "x"})
    assert state.load_state(spark, f"{tmp}/s") == {"a": "2", "b": "x"}
    now = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    assert state.refresh_due(None, now)
    assert not state.refresh_due("2024-02-15T00:00:00+00:00", now)
    assert state.refresh_due("2024-01-15T00:00:00+00:00", now)
    assert state.weekday_due(dt.datetime(2024, 3, 4), 0) and not state.weekday_due(now, 0)


def test_malformed_rows_are_quarantined(spark, localdir):
    _write(localdir, "good_and_bad.json", '{"id": 1, "name": "a"}\n{"id": "x", "name": "b"\n{"id": 3, "name": "c"}\n')
    _write(localdir, "bad.csv", "id,name\n4,d\nnot_a_number,e\n")
    b = read_batch(spark, localdir, spark.createDataFrame([], SCHEMA).schema,
                   corrupt_col="_corrupt")
    assert sorted(r.id for r in b.data.collect()) == [1, 3, 4]
    assert "_corrupt" not in b.data.columns
    bad = sorted(r._corrupt for r in b.corrupt.collect())
    assert len(bad) == 2 and any("not_a_number" in x for x in bad)


def test_cadence():
    import datetime as dt
    monday = dt.datetime(2024, 3, 4, tzinfo=dt.timezone.utc)
    assert state.due(None, 30, 0, monday) and not state.due(None, 30, 1, monday)
    assert not state.due("2024-03-01T00:00:00+00:00", 30, None, monday)
