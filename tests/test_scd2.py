from pyspark.sql import Row

from chainyard.operators.scd2 import as_of, scd2_snapshot

R = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00",
     "2024-04-01 00:00:00"]
SCHEMA = "id string, a string, b string, note string, _ingestion_timestamp string"


def _src(spark, rows, i):
    return spark.createDataFrame([(*r, f"t{i}") for r in rows], SCHEMA)


def _runs(spark):
    batches = [
        [("1", "a", None, "x"), ("2", "c", "d", "x")],
        [("1", "a", "B", "x"), ("2", "c", "d", "CHANGED")],   # checked / unchecked change
        [("1", "a", "B", "x")],                                # 2 deleted
        [("1", "a", "B", "x"), ("2", "c", "d", "y")],          # 2 reappears
    ]
    snap, states = None, []
    for i, rows in enumerate(batches):
        snap = scd2_snapshot(snap, _src(spark, rows, i), "id", ["a", "b"], R[i])
        states.append(snap)
    return states


def _versions(df):
    return sorted((r.id, str(r.valid_from)[:10], str(r.valid_to)[:10] if r.valid_to else None)
                  for r in df.collect())


def test_four_runs_give_expected_versions(spark):
    final = _runs(spark)[-1]
    assert _versions(final) == [
        ("1", "2024-01-01", "2024-02-01"), ("1", "2024-02-01", None),
        ("2", "2024-01-01", "2024-03-01"), ("2", "2024-04-01", None)]


def test_unchecked_change_keeps_old_row(spark):
    run2 = _runs(spark)[1]
    row2 = [r for r in run2.collect() if r.id == "2"]
    assert len(row2) == 1 and row2[0].note == "x" and row2[0].is_current


def test_null_safe_change_detection(spark):
    run2 = _runs(spark)[1]
    assert sorted(r.b or "-" for r in run2.collect() if r.id == "1") == ["-", "B"]


def test_invariants_one_current_no_overlap(spark):
    for state in _runs(spark):
        rows = state.collect()
        by_key = {}
        for r in rows:
            by_key.setdefault(r.id, []).append(r)
        for versions in by_key.values():
            assert sum(v.is_current for v in versions) <= 1
            ordered = sorted(versions, key=lambda v: v.valid_from)
            for a, b in zip(ordered, ordered[1:]):
                assert a.valid_to is not None and a.valid_to <= b.valid_from
        assert len({r.surrogate_key for r in rows}) == len(rows)


def test_surrogate_key_is_md5_of_key_and_time(spark):
    import hashlib
    first = _runs(spark)[0].filter("id = '1'").first()
    assert first.surrogate_key == hashlib.md5(b"1|2024-01-01 00:00:00").hexdigest()


def test_duplicate_source_keys_take_latest(spark):
    src = spark.createDataFrame([("1", "old", None, "n", "t1"), ("1", "new", None, "n", "t2")],
                                SCHEMA)
    snap = scd2_snapshot(None, src, "id", ["a", "b"], R[0])
    assert [r.a for r in snap.collect()] == ["new"]


def test_without_hard_deletes_row_stays_open(spark):
    s1 = scd2_snapshot(None, _src(spark, [("1", "a", "b", "x")], 0), "id", ["a"], R[0])
    s2 = scd2_snapshot(s1, _src(spark, [("9", "z", "z", "x")], 1), "id", ["a"], R[1],
                       hard_deletes=False)
    assert {r.id: r.is_current for r in s2.collect()} == {"1": True, "9": True}


def test_as_of_picks_one_version(spark):
    final = _runs(spark)[-1]
    assert _versions(as_of(final, "2024-03-15 00:00:00")) == [("1", "2024-02-01", None)]


def test_initial_valid_from(spark):
    s = scd2_snapshot(None, _src(spark, [("1", "a", "b", "x")], 0), "id", ["a"], R[1],
                      initial_valid_from="1900-01-01 00:00:00")
    r = s.first()
    assert str(r.valid_from).startswith("1900-01-01") and str(r.updated_at).startswith("2024-02")
