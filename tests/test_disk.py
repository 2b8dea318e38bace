"""What queries over large tables leave on disk while they run."""

import datetime as dt
import glob
import itertools
import json
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chainyard.sources import ingest
from chainyard.testing import queries as Q
from chainyard.testing.scenario import Warehouse

T0 = dt.datetime(1997, 12, 20)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty lines of twenty orders, over 1997 to 1998."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = lambda n: T0 + dt.timedelta(days=n)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 1)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"C{i}", i % 2, 1.0, "M") for i in range(4)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"S{i}", i % 2, 1.0) for i in range(3)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"part {i}", "Brand#1", "PROMO" if i % 2 else "SMALL", 10 * i, 900.0 + i) for i in range(6)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string",
                   [(i, i % 4, "O", 1.0, day(17 * i), "LOW") for i in range(20)]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate timestamp_ntz",
                     [(i // 2, i % 6, i % 3, i % 2 + 1, 5.0, 9.0, 0.05, 0.0, "N", "OF"[i % 2], day(8 * i + 3))
                      for i in range(40)])}
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    n = itertools.count()
    monkeypatch.setattr(Q, "_scratch", lambda w, name: f"{tmp_path}/{name}-{next(n)}")
    return str(tmp_path)


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize("write", [Q._stored, lambda w, name, df: Q._drop(df, Q._scratch(w, name))])
def test_written_inputs_leave_no_shuffle(spark, tables, scratch, write):
    known = shuffle_files(spark)
    write(Warehouse(spark, tables), "x", spark.range(1000).repartition(4, "id"))
    for _ in range(50):
        if not shuffle_files(spark) - known:
            return
        time.sleep(0.1)
    raise AssertionError(shuffle_files(spark) - known)


def test_checksummed_copies_are_deleted(spark, tables, scratch):
    out = Q.QUERIES["table_checksum_match"](spark, tables)
    assert not glob.glob(f"{scratch}/checksum-0/*/*.parquet")
    found = sorted(map(tuple, out.collect()))
    assert [(n, ok) for n, _, ok in found] == [(f"stg_{n}", True) for n in ("inventory", "sales", "shipments")]
    assert found[1][1] == found[2][1] == 40


def test_second_asof_join_does_not_hold_the_stored_shipments(spark, tables, scratch):
    out = Q.QUERIES["fct_shipments_asof"](spark, tables)
    assert not glob.glob(f"{scratch}/*raw*/*.parquet") + glob.glob(f"{scratch}/*/_aside/raw-*/*")
    assert glob.glob(f"{scratch}/*/_aside/linked-*/*.parquet")
    same(out, Warehouse(spark, tables).fct_shipments())


def test_late_change_links_and_lays_out_apart(spark, tables, scratch, monkeypatch):
    from chainyard.store import TableStore
    aside, put = [], TableStore.set_aside
    monkeypatch.setattr(TableStore, "set_aside", lambda self, name, df: (aside.append(name), put(self, name, df))[1])
    out = Q.QUERIES["fct_sales_late_change"](spark, tables)
    assert "linked" in aside and not glob.glob(f"{scratch}/*/_aside/linked-*/*")
    same(out, Warehouse(spark, tables).fct_sales())


def test_versions_are_zstd(spark, tmp_path):
    from chainyard.store import TableStore
    store = TableStore(spark, str(tmp_path))
    store.commit("t", spark.range(10))
    store.set_aside("a", spark.range(10))
    files = glob.glob(f"{tmp_path}/PUBLIC.t/*/*.parquet") + glob.glob(f"{tmp_path}/_aside/*/*.parquet")
    with_rows = [m for m in map(pq.read_metadata, files) if m.num_rows]
    assert {m.row_group(0).column(0).compression for m in with_rows} == {"ZSTD"}


def test_drops_of_the_ingestion_run_are_compressed(spark, tables, scratch):
    out = Q.QUERIES["ingest_run"](spark, tables)
    drops = glob.glob(f"{scratch}/ingest-run-*/source/*/*/*/part-*")
    assert drops and all(p.endswith(".gz") for p in drops)
    assert {r.status for r in out.collect()} == {"PASSED"}
    assert sum(r.rows_dest for r in out.collect() if r.source_name == "shipments") == 40


@pytest.mark.parametrize("bad", [0, 1])
def test_files_are_parsed_for_the_quarantine_only_if_a_row_is_malformed(spark, tmp_path, monkeypatch, bad):
    from pyspark.sql import types as T
    (tmp_path / "in" / "s").mkdir(parents=True)
    lines = [json.dumps({"a": str(i)}) for i in range(3)] + ['{"a": '] * bad
    (tmp_path / "in" / "s" / "x.json").write_text("\n".join(lines) + "\n")
    read = ingest.read_paths

    def watched(*args):
        batch = read(*args)
        batch.corrupt = batch.corrupt.withColumn("a", F.raise_error(F.lit("parsed")).cast("string")) \
            if not bad else batch.corrupt
        batch.corrupt = batch.corrupt if bad else batch.corrupt.unionByName(
            spark.range(1).select(*[F.raise_error(F.lit("parsed")).cast(f.dataType).alias(f.name)
                                    for f in batch.corrupt.schema]))
        return batch

    monkeypatch.setattr(ingest, "read_paths", watched)
    res = ingest.ingest_files(spark, str(tmp_path / "in"), str(tmp_path / "land"), str(tmp_path / "state"),
                              {"s": T.StructType([T.StructField("a", T.StringType())])}, dynamic=["s"])
    assert res.quarantined == {"s": bad} and res.reports[0]["rows_dest"] == 3
    aside = spark.read.parquet(str(tmp_path / "land" / "_quarantine" / "s"))
    assert aside.count() == bad and ingest.CORRUPT in aside.columns
