"""Damaged files of a landing, found by one scan of all of them."""

import glob
import os

import pytest

from chainyard.sources.files import list_files
from chainyard.sources.landing import damaged_files, load_log, load_raw, read_raw


def _rewrite(path, change, aside):
    with open(path, "rb") as f:
        whole = f.read()
    with open(path, "wb") as f:
        f.write(change(whole))
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.replace(crc, f"{aside}/{os.path.basename(path)}.old")


@pytest.fixture()
def landing(spark, localdir):
    """Five sound files, an empty one, and three that are damaged in their own way."""
    root = f"{localdir}/land"
    spark.range(0, 100000, 1, 4).selectExpr("id", "md5(cast(id as string)) as s").write.parquet(
        f"{root}/a b+c%41")
    spark.range(0, 0, 1, 1).write.parquet(f"{root}/empty")
    spark.range(100000, 100005, 1, 1).selectExpr("id", "id as extra").write.parquet(f"{root}/c")
    files = sorted(glob.glob(f"{root}/a b+c%41/*.parquet"))
    _rewrite(files[0], lambda b: b[:-20], localdir)
    _rewrite(files[1], lambda b: b[:len(b) // 2] + bytes(3000) + b[len(b) // 2 + 3000:], localdir)
    with open(f"{root}/junk.parquet", "w") as f:
        f.write("no table")
    return root, {os.path.basename(p) for p in files[:2]} | {"junk.parquet"}


def test_damaged_files_are_named_with_what_is_wrong(spark, landing):
    root, damaged = landing
    paths = [r.path for r in list_files(spark, root, glob="*.parquet").collect()]
    found = {os.path.basename(r.path): r.error for r in damaged_files(spark, paths).collect()}
    assert set(found) == damaged
    kinds = sorted(e.split(":")[0].split(" of ")[-1] for e in found.values())
    assert kinds == ["25000 rows can be read", "no readable footer", "no readable footer"]


def test_sound_files_of_a_damaged_landing_load_once(spark, landing, tmp):
    root, damaged = landing
    assert load_raw(spark, root, f"{tmp}/raw", f"{tmp}/log") == 4
    got = read_raw(spark, f"{tmp}/raw", f"{tmp}/log")
    assert got.count() == 50005 and got.filter("extra is not null").count() == 5
    assert load_raw(spark, root, f"{tmp}/raw", f"{tmp}/log") == 0
    bad = load_log(spark, f"{tmp}/log").filter("error is not null")
    assert {os.path.basename(r.path) for r in bad.select("path").distinct().collect()} == damaged


def test_nothing_but_damage(spark, localdir):
    with open(f"{localdir}/x.parquet", "w") as f:
        f.write("no table")
    assert [r.path for r in damaged_files(spark, [f"file:{localdir}/x.parquet"]).collect()]


def test_files_that_differ_in_schema_alone_are_not_damaged(spark, localdir, tmp):
    spark.range(2).selectExpr("id as k").write.parquet(f"{localdir}/l/a")
    spark.range(2).selectExpr("cast(id as string) as k").write.parquet(f"{localdir}/l/b")
    files = glob.glob(f"{localdir}/l/*/*.parquet")
    with pytest.raises(Exception, match="CANNOT_MERGE"):
        damaged_files(spark, files).collect()
    assert load_raw(spark, f"{localdir}/l", f"{tmp}/raw", f"{tmp}/log") == len(files)
    got = read_raw(spark, f"{tmp}/raw", f"{tmp}/log")
    assert sorted(r.k for r in got.collect()) == ["0", "0", "1", "1"]
