"""Registered queries (name -> callable(spark, sf_dir)) and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainyard.session import configure, shuffles_dropped
from chainyard.testing import oracle as O
from chainyard.testing.scenario import Warehouse

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _scratch(w, name):
    """A fresh folder for a query's files, under the shared checkpoint dir."""
    from chainyard.session import shared_dir
    return shared_dir(w.spark, name)


def _drop(df, path: str, fmt: str = "csv", **options) -> None:
    """``df`` dropped as files, none without rows: a writer of a plain folder
    leaves a file for its first task even if that has no row (the first part of
    a table whose row groups are larger than its parts), one that lays files out
    by a column opens a file only for a row."""
    from pyspark.sql import functions as F
    writer = df.withColumn("_drop", F.lit(0)).write.partitionBy("_drop").mode("overwrite")
    writer.options(**({"header": "true"} if fmt == "csv" else {}), **options).format(fmt)
    with shuffles_dropped(df.sparkSession):
        writer.save(path)


def _stored(w, name: str, df):
    """``df`` written once and read back, for a query that reads it several times."""
    path = _scratch(w, name)
    with shuffles_dropped(w.spark):
        df.write.option("compression", "zstd").parquet(path)
    return w.spark.read.schema(df.schema).parquet(path)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Warehouse(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# -- staging (M1-M7) -------------------------------------------------------
for _entity in ("sales", "shipments", "inventory", "products", "suppliers", "warehouses",
                "stores"):
    register(f"stg_{_entity}", O.model(f"stg_{_entity}"))(
        lambda w, _e=_entity: w.stg(_e))


# -- snapshots, dimensions, facts (M8-M19) ----------------------------------
@register("snap_suppliers", O.model("snap_suppliers"))
def _snap_suppliers(w):
    return w.snap_static("suppliers")


@register("snap_stores", O.model("snap_stores"))
def _snap_stores(w):
    return w.snap_static("stores")


@register("snap_warehouses", O.model("snap_warehouses"))
def _snap_warehouses(w):
    return w.snap_static("warehouses")


@register("dim_date", O.model("dim_date"))
def _dim_date(w):
    return w.dim_date()


@register("dim_product", O.model("dim_product"))
def _dim_product(w):
    return w.dim_product()


@register("dim_supplier", O.model("dim_supplier"))
def _dim_supplier(w):
    return w.dim_supplier()


@register("dim_store", O.model("dim_store"))
def _dim_store(w):
    return w.dim_store()


@register("dim_warehouse", O.model("dim_warehouse"))
def _dim_warehouse(w):
    return w.dim_warehouse()


@register("fct_sales", O.model("fct_sales"))
def _fct_sales(w):
    return w.fct_sales()


@register("fct_shipments", O.model("fct_shipments"))
def _fct_shipments(w):
    return w.fct_shipments()


@register("fct_inventory", O.model("fct_inventory"))
def _fct_inventory(w):
    return w.fct_inventory()


@register("fct_sales_asof", O.model("fct_sales"))
def _fct_sales_asof(w):
    """Sales meet the product versions by one sort, not by a broadcast."""
    from chainyard.operators.temporal import asof_join
    # the join counts its hot keys and cuts them before it sorts
    w.raw["sales"] = _stored(w, "raw-sales", w.model("raw_sales"))
    return w.fct_sales(join=asof_join)


@register("fct_shipments_asof", O.model("fct_shipments"))
def _fct_shipments_asof(w):
    """Shipments meet two dimensions' versions by one sort for each, by day.  What
    the first sort gave is written down, so that the second does not hold its
    shuffle and the stored shipments besides its own."""
    from chainyard.operators.temporal import asof_join
    from chainyard.store import TableStore
    store = TableStore(w.spark, _scratch(w, "shipments-asof"))
    w.raw["shipments"] = store.set_aside("raw", w.model("raw_shipments"))

    def join(fact, versions, key, *args, **kw):
        out = asof_join(fact, versions, key, *args, **kw)
        if key == "product_id":
            out = store.set_aside("linked", out)
            store.release("raw")
        return out

    return w.fct_shipments(join=join, hot_share=0.002, pieces=8)


@register("fct_sales_sort_merge", O.model("fct_sales"))
def _fct_sales_sort_merge(w):
    """The join by key of dimensions beyond the broadcast bound."""
    return w.fct_sales(broadcast_max_rows=0)


_HOT_KEY = """
    with fact as (select l_orderkey as orderkey, l_linenumber as line,
                         cast(if(l_linenumber <= 2, 1, l_partkey) as bigint) as part, l_shipdate as shipped
                  from lineitem),
         version as (select cast(l_partkey % 50 as decimal(12,2)) as part, o_orderdate as since,
                            count(*) as lines
                     from lineitem join orders on l_orderkey = o_orderkey group by all)"""


@register("asof_hot_key", _HOT_KEY + """
    select orderkey, line, fact.part, shipped, since as opened, lines
    from fact asof left join version on version.part = fact.part and version.since <= fact.shipped""")
def _asof_hot_key(w):
    """A key with more than a third of the facts and a version for each day of
    its orders, compared as whole number and as decimal."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from chainyard.operators.temporal import asof_join
    from chainyard.testing import fixtures as fx
    lines = fx.table(w.spark, w.sf_dir, "lineitem")
    orders = fx.table(w.spark, w.sf_dir, "orders")
    fact = lines.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_linenumber") <= 2, 1).otherwise(F.col("l_partkey")).cast("bigint").alias("part"),
        F.col("l_shipdate").alias("shipped"))
    starts = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
              .groupBy((F.col("l_partkey") % 50).cast("decimal(12,2)").alias("part"),
                       F.col("o_orderdate").alias("opened"))
              .agg(F.count(F.lit(1)).alias("lines")))
    closed = F.lead("opened").over(Window.partitionBy("part").orderBy("opened"))
    versions = starts.withColumn("valid_from", F.col("opened")).withColumn("valid_to", closed)
    return asof_join(fact, versions, "part", "shipped", pieces=16)


# -- a late dimension change: facts published first, product versions closed after ----
def _late_change(w):
    """Sales are linked to the products of the first run and published by month;
    the second run then closes versions of PROMO products back in 1998."""
    from pyspark.sql import functions as F
    from chainyard.operators.relink import interval_changes, relink_partitions
    from chainyard.plans import dims, facts
    from chainyard.store import TableStore
    from chainyard.testing import fixtures as fx
    store = TableStore(w.spark, _scratch(w, "late-change"))
    suppliers, month = w.snap_static("suppliers"), facts.FACT_MONTH["fct_sales"]()
    before = dims.dim_product(w.snap_products(fx.PRODUCT_RUNS[:1]), suppliers)
    after = store.set_aside("after", w.dim_product())
    # linked and laid out by two jobs, each of which drops its shuffles
    linked = store.set_aside("linked", facts.fct_sales(w.stg("sales"), w.calendar(), before))
    store.commit("fct_sales", linked, part_expr=month)
    store.release("linked")
    changes = interval_changes(before, after, "product_id", ["surrogate_key", "supplier_id"])
    versions = after.select("product_id", "valid_from", "valid_to", "supplier_id",
                            F.col("surrogate_key").alias("product_surrogate_key"))
    v = relink_partitions(store, "fct_sales", changes, versions, "product_id",
                          "transaction_timestamp", "transaction_id", month)
    store.publish({("fct_sales", None): v})
    return store


@register("fct_sales_late_change", O.model("fct_sales"))
def _fct_sales_late_change(w):
    """Re-linked facts equal a full rebuild."""
    return _late_change(w).read("fct_sales")


@register("late_change_months", O.with_models(f"""
    select distinct strftime(transaction_timestamp, '%Y%m') as month
    from stg_sales natural join (select product_id, category from stg_products)
    where category = '{O.fx.REBRAND_TYPE}'
      and transaction_timestamp >= timestamp '{O.fx.PRODUCT_RUNS[1]}'"""))
def _late_change_months(w):
    """The months that the re-linking wrote: those with a fact to link anew."""
    from pyspark.sql import functions as F
    log = _late_change(w).history("fct_sales").filter("version = 2")
    return log.select(F.explode("partitions").alias("month"))


# -- SCD2 over four runs: insert, change, unchanged, delete, reappear ------
def _scenario(w, k: int):
    from chainyard.plans import dims, staging
    from chainyard.testing import fixtures as fx
    runs = fx.SCENARIO_RUNS
    batches = [staging.stg_products(fx.product_batch(w.spark, w.sf_dir, i + 1, runs))
               for i in range(k)]
    return dims.snapshot_runs("products", batches, runs[:k])


for _k in range(1, 5):
    register(f"snap_products_v{_k}",
             O.with_models(f"select * from ({O.product_versions_sql(O.fx.SCENARIO_RUNS, _k)})"))(
        lambda w, _k=_k: _scenario(w, _k))


def _product_history(w, known: int):
    """All runs of the scenario; the first ``known`` of them run one by one before."""
    from chainyard.plans import dims, staging
    from chainyard.testing import fixtures as fx
    runs = fx.SCENARIO_RUNS
    batches = [staging.stg_products(fx.product_batch(w.spark, w.sf_dir, i + 1, runs))
               for i in range(known, len(runs))]
    return dims.history("products", batches, runs[known:], _scenario(w, known) if known else None)


for _known in range(3):
    register("snap_products_history" + (f"_after_{_known}" if _known else ""),
             O.with_models(f"select * from ({O.product_versions_sql(O.fx.SCENARIO_RUNS, 4)})"))(
        lambda w, _known=_known: _product_history(w, _known))


@register("snap_products", O.model("snap_products"))
def _snap_products(w):
    return w.snap_products()


# -- incremental facts: first run up to 1998, second run merges the rest ----
def _incremental(w, name: str):
    """Run 1 builds the fact from the batches ingested up to 1998 and
    publishes it; run 2 takes only rows ingested after the published
    watermark and merges them in, rewriting the months they touch."""
    from chainyard.operators.merge import merge_into_partitions, new_since
    from chainyard.plans import facts
    from chainyard.store import TableStore
    from chainyard.testing.scenario import first_run
    store = TableStore(w.spark, _scratch(w, "incremental"))
    staged = w.stg({"fct_sales": "sales", "fct_shipments": "shipments",
                    "fct_inventory": "inventory"}[name])
    for batch in (first_run(staged), staged):
        rows = getattr(w, name)(new_since(batch, store.read(name), mark=store.watermark(name)))
        store.publish({(name, None): merge_into_partitions(
            store, name, rows, facts.FACT_KEYS[name], facts.FACT_MONTH[name]())})
    return store.read(name)


for _name in ("fct_sales", "fct_shipments", "fct_inventory"):
    register(f"{_name}_incremental", O.model(_name))(
        lambda w, _n=_name: _incremental(w, _n))


@register("fct_sales_month_merge", O.model("fct_sales"))
def _fct_sales_month_merge(w):
    """As ``fct_sales_incremental``, with the fact laid out by transaction
    month: run 2 rewrites only the months its batch touches and the store
    assembles the table from the newest version of each month."""
    from chainyard.operators.merge import merge_into_partitions, new_since
    from chainyard.plans import facts
    from chainyard.store import TableStore
    from chainyard.testing.scenario import first_run
    store = TableStore(w.spark, _scratch(w, "month-merge"))
    staged = w.stg("sales")
    month = facts.FACT_MONTH["fct_sales"]
    for batch in (first_run(staged), staged):
        rows = w.fct_sales(new_since(batch, store.read("fct_sales")))
        v = merge_into_partitions(store, "fct_sales", rows, "transaction_id", month())
        store.publish({("fct_sales", None): v})
    return store.read("fct_sales")


@register("merge_duplicate_keys", O.with_models("""
    select * exclude (rn) from (
        select *, row_number() over (partition by order_line
                                     order by _ingestion_timestamp desc, transaction_id desc) rn
        from raw_sales) where rn = 1"""))
def _merge_duplicate_keys(w):
    """Merge on a key that repeats within and across batches: the latest
    row per key wins (ingestion time, then transaction id)."""
    from chainyard.operators.merge import merge_incremental
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    raw = fx.raw_sales(w.spark, w.sf_dir)
    order = ["_ingestion_timestamp", "transaction_id"]
    first = merge_incremental(None, first_run(raw), "order_line", order)
    rest = raw.filter(raw["_ingestion_timestamp"] > O.FIRST_RUN_UNTIL)
    return merge_incremental(first, rest, "order_line", order)


@register("merge_schema_sync", O.with_models(f"""
    select inventory_key, warehouse_id, product_id, date_id, quantity_available,
           reorder_threshold, snapshot_date,
           case when _ingestion_timestamp > '{O.FIRST_RUN_UNTIL}' then stock_level end
               as stock_level,
           _ingestion_timestamp, _run_id
    from fct_inventory"""))
def _merge_schema_sync(w):
    """The stored target predates ``stock_level`` and still carries a
    retired column; merging a current batch adds the one (NULL on old
    rows) and drops the other."""
    from pyspark.sql import functions as F
    from chainyard.plans import facts
    from chainyard.testing.scenario import first_run
    from chainyard.store import TableStore
    store = TableStore(w.spark, _scratch(w, "schema-sync"))
    staged = w.stg("inventory")
    store.commit("fct_inventory", w.fct_inventory(first_run(staged)).drop("stock_level")
                 .withColumn("legacy_bin", F.lit("A")))
    store.commit("fct_inventory", facts.incremental(
        "fct_inventory", store.read("fct_inventory"), staged, w.fct_inventory))
    return store.read("fct_inventory")


@register("merge_moved_month", O.with_models("""
    select shipment_id, carrier, quantity_shipped,
           if(quantity_shipped > 25, shipment_date + interval 40 day, shipment_date)::date
               as shipment_date
    from raw_shipments"""))
def _merge_moved_month(w):
    """A second batch moves the larger shipments by 40 days, into other
    months: each keeps one row."""
    from pyspark.sql import functions as F
    from chainyard.operators.merge import merge_into_partitions
    from chainyard.store import TableStore
    from chainyard.testing import fixtures as fx
    store = TableStore(w.spark, _scratch(w, "moved-month"))
    ship = fx.raw_shipments(w.spark, w.sf_dir).select(
        "shipment_id", "carrier", "quantity_shipped", F.col("shipment_date").cast("date"),
        "_ingestion_timestamp")
    moved = ship.filter("quantity_shipped > 25").withColumn(
        "shipment_date", F.date_add("shipment_date", 40))
    for batch in (ship, moved):
        v = merge_into_partitions(store, "s", batch, "shipment_id",
                                  F.date_format("shipment_date", "yyyyMM"))
        store.publish({("s", None): v})
    return store.read("s").drop("_ingestion_timestamp")


def _indexed_merges(w):
    """Shipments by month with a key index; then the largest of 1995 move by 400
    days and a few new ones come."""
    from pyspark.sql import functions as F
    from chainyard.operators.merge import merge_into_partitions
    from chainyard.store import TableStore
    from chainyard.testing import fixtures as fx
    store = TableStore(w.spark, _scratch(w, "key-index"))
    ship = fx.raw_shipments(w.spark, w.sf_dir).select(
        "shipment_id", "carrier", "quantity_shipped", F.col("shipment_date").cast("date"))
    moved = ship.filter("quantity_shipped = 50 AND year(shipment_date) = 1995").withColumn(
        "shipment_date", F.date_add("shipment_date", 400))
    fresh = ship.filter("quantity_shipped = 49 AND year(shipment_date) = 1995").withColumn(
        "shipment_id", F.concat(F.lit("again-"), "shipment_id"))
    for batch in (ship, moved.unionByName(fresh)):
        v = merge_into_partitions(store, "s", batch, "shipment_id",
                                  F.date_format("shipment_date", "yyyyMM"), index=True)
        store.publish({("s", None): v})
    return store


_MOVED = "quantity_shipped = 50 and year(shipment_date) = 1995"
_FRESH = "quantity_shipped = 49 and year(shipment_date) = 1995"


@register("merge_key_index", O.with_models(f"""
    select shipment_id, carrier, quantity_shipped,
           cast(if({_MOVED}, shipment_date + interval 400 day, shipment_date) as date) as shipment_date
    from raw_shipments
    union all select concat('again-', shipment_id), carrier, quantity_shipped, shipment_date
    from raw_shipments where {_FRESH}"""))
def _merge_key_index(w):
    """A merge that finds moved keys by the index equals one that scans."""
    return _indexed_merges(w).read("s")


@register("merge_key_index_months", O.with_models(f"""
    select month, bool_or(came) as of_batch
    from (select strftime(shipment_date + interval 400 day, '%Y%m') as month, true as came
          from raw_shipments where {_MOVED}
          union all select strftime(shipment_date, '%Y%m'), true from raw_shipments where {_FRESH}
          union all select strftime(shipment_date, '%Y%m'), false from raw_shipments where {_MOVED})
    group by month"""))
def _merge_key_index_months(w):
    """Months that the merge wrote: its own and those that a key has left."""
    from pyspark.sql import functions as F
    store = _indexed_merges(w)
    report = store.last_merge["s"]
    if not report["indexed"]:
        raise AssertionError("the merge read every month")
    wrote = store.history("s").filter("version = 2").select(F.explode("partitions").alias("month"))
    return wrote.withColumn("of_batch", F.col("month").isin(report["own"]))


@register("month_merge_schema_sync", O.with_models(f"""
    select inventory_key, warehouse_id, product_id, date_id, quantity_available,
           reorder_threshold, snapshot_date,
           case when _ingestion_timestamp > '{O.FIRST_RUN_UNTIL}' then stock_level end
               as stock_level,
           _ingestion_timestamp, _run_id
    from fct_inventory"""))
def _month_merge_schema_sync(w):
    """As ``merge_schema_sync`` in the month form, after an empty first batch:
    months that the second batch leaves alone show its columns too."""
    from pyspark.sql import functions as F
    from chainyard.operators.merge import merge_into_partitions
    from chainyard.plans import facts
    from chainyard.store import TableStore
    from chainyard.testing.scenario import first_run
    store = TableStore(w.spark, _scratch(w, "month-sync"))
    staged, month = w.stg("inventory"), facts.FACT_MONTH["fct_inventory"]()
    old = w.fct_inventory(first_run(staged)).drop("stock_level").withColumn(
        "legacy_bin", F.lit("A"))
    new = w.fct_inventory(staged.filter(F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL))
    for batch in (old.limit(0), old, new):
        store.publish({("i", None): merge_into_partitions(store, "i", batch, "inventory_key", month)})
    return store.read("i")


# -- the data tests on inputs damaged by a fixed rule ------------------------
_BROKEN = """
    with broken as (
        select case when l_linenumber = 1 then null else 'k' || cast(l_partkey as varchar) end
                   as key,
               case when l_linenumber = 2 then -cast(l_quantity as integer)
                    else cast(l_quantity as integer) end as quantity,
               case when l_linenumber = 3 then 'LOST' else 'ON_TIME' end as status,
               case when l_linenumber = 4 then 'MANY' else 'LOW_STOCK' end as level
        from lineitem)
    select 'not_null' as test, cast(count(*) filter (where key is null) as bigint) as failures
    from broken
    union all select 'unique', cast(count(*) as bigint) from (
        select key from broken where key is not null group by key having count(*) > 1)
    union all select 'relationships', cast(count(*) as bigint) from broken
        where key is not null and key not in (select 'k' || cast(p_partkey as varchar) from part
                                              where p_size > 10)
    union all select 'positive_value', cast(count(*) filter (where quantity <= 0) as bigint) from broken
    union all select 'not_negative', cast(count(*) filter (where quantity < 0) as bigint) from broken
    union all select 'delivery_status', cast(count(*) filter (where status = 'LOST') as bigint)
        from broken
    union all select 'stock_level', cast(count(*) filter (where level = 'MANY') as bigint)
        from broken"""


@register("dq_damaged", _BROKEN)
def _dq_damaged(w):
    """Every kind of data test on line items damaged by a fixed rule: known
    counts above zero."""
    from pyspark.sql import functions as F
    from chainyard.operators.quality import SUITE, DataTest, run_suite
    from chainyard.testing import fixtures as fx
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    key = F.concat(F.lit("k"), F.col("l_partkey").cast("string"))
    broken = fx.table(w.spark, w.sf_dir, "lineitem").select(
        F.when(n != 1, key).alias("key"), F.when(n == 2, -q).otherwise(q).alias("quantity"),
        F.when(n == 3, "LOST").otherwise("ON_TIME").alias("status"),
        F.when(n == 4, "MANY").otherwise("LOW_STOCK").alias("level"))
    part = fx.table(w.spark, w.sf_dir, "part").filter("p_size > 10").select(
        F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("key"))
    values = {t.label: t.values for t in SUITE if t.kind == "accepted_values"}
    tests = [DataTest("broken", "key", "not_null"), DataTest("broken", "key", "unique"),
             DataTest("broken", "key", "relationships", to="part", field="key"),
             DataTest("broken", "quantity", "positive_value"),
             DataTest("broken", "quantity", "not_negative"),
             DataTest("broken", "status", "accepted_values", values=values["valid_delivery_status"]),
             DataTest("broken", "level", "accepted_values", values=values["valid_stock_level"])]
    found = run_suite(w.spark, {"broken": broken, "part": part}, tests)
    test = F.when(F.col("column_name") == "status", "delivery_status").when(
        F.col("column_name") == "level", "stock_level").otherwise(F.col("test"))
    return found.select(test.alias("test"), "failures")


# -- data-quality suite (Q1-Q7): failing-row counts per test ----------------
def _dq(w, kind: str):
    """The tests of a kind; what several of them read is computed once and stored:
    the events of a source that more than one tested model is built from, and of a
    fact with several references the referring columns."""
    from chainyard.operators.quality import run_suite, select_tests
    tests, tables = select_tests(kind), w.tables()
    models = {t.model for t in tests}
    for e in ("sales", "shipments", "inventory"):
        if len(models & {f"raw_{e}", f"stg_{e}", f"fct_{e}"}) > 1:
            w.raw[e] = _stored(w, f"raw-{e}", w.model(f"raw_{e}"))
    for model in sorted(models):
        columns = [t.column for t in tests if t.model == model and t.kind == "relationships"]
        if len(columns) > 1:
            tables[model] = _stored(w, model, w.model(model).select(*dict.fromkeys(columns)))
    return run_suite(w.spark, tables, tests)


def _dq_oracle(kind: str) -> str:
    from chainyard.operators.quality import select_tests
    return O.dq_sql(select_tests(kind))


for _q, _kind in (("dq_not_null", "not_null"), ("dq_unique", "unique"),
                  ("dq_relationships", "relationships"), ("dq_positive", "positive_value"),
                  ("dq_not_negative", "not_negative"),
                  ("dq_delivery_status", "valid_delivery_status"),
                  ("dq_stock_level", "valid_stock_level")):
    register(_q, _dq_oracle(_kind))(lambda w, _k=_kind: _dq(w, _k))


# -- ingestion: files, sheet exports, daily tables, raw load (S1-S10, K1-K5) --
# Fixed values of the ingestion scenario (injected, so runs are repeatable).
INGEST_TS = "2024-02-01T02:00:00+00:00"
INGEST_RUN = "run-ingest"
DROP_BUCKET = "supply-drop"


def _land_and_read(w, df, root, name, mode="overwrite"):
    from chainyard.sources.landing import land
    return w.spark.read.parquet(land(df, f"{root}/landing/{name}.parquet", mode=mode))


@register("csv_ingest", O.with_models(f"""
    select product_id, product_name, category, brand, supplier_id, unit_price,
           '{INGEST_TS}' as _ingestion_timestamp, '{INGEST_RUN}' as _run_id,
           '{DROP_BUCKET}' as _source_bucket, 's3_ingest_script' as _ingested_by
    from raw_products"""))
def _csv_ingest(w):
    """Products dropped as CSV files: typed read, lineage, Parquet landing."""
    from chainyard import schemas
    from chainyard.sources.files import read_batch
    from chainyard.sources.lineage import add_lineage
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "csv-ingest")
    fx.raw_products(w.spark, w.sf_dir).drop("_ingestion_timestamp") \
      .write.option("header", "true").csv(f"{root}/drop/products")
    batch = read_batch(w.spark, f"{root}/drop/products", schemas.RAW["products"])
    df = add_lineage(batch.data.drop("_source_key"), "files", INGEST_TS, INGEST_RUN,
                     source_bucket=DROP_BUCKET)
    return _land_and_read(w, df, root, "products")


@register("json_ingest", O.with_models(f"""
    select shipment_id, warehouse_id, store_id, product_id, quantity_shipped, shipment_date,
           expected_delivery_date, actual_delivery_date, carrier,
           '{INGEST_TS}' as _ingestion_timestamp, '{INGEST_RUN}' as _run_id,
           '{DROP_BUCKET}' as _source_bucket, 's3_ingest_script' as _ingested_by
    from raw_shipments"""))
def _json_ingest(w):
    """Shipments dropped as JSON-lines files (layout sniffed per file)."""
    from chainyard import schemas
    from chainyard.sources.files import read_batch
    from chainyard.sources.lineage import add_lineage
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "json-ingest")
    fx.raw_shipments(w.spark, w.sf_dir).drop("_ingestion_timestamp", "_run_id") \
      .write.option("compression", "gzip").json(f"{root}/drop/shipments")
    batch = read_batch(w.spark, f"{root}/drop/shipments", schemas.RAW["shipments"])
    df = add_lineage(batch.data.drop("_source_key"), "files", INGEST_TS, INGEST_RUN,
                     source_bucket=DROP_BUCKET)
    return _land_and_read(w, df, root, "shipments")


@register("sheet_ingest", O.with_models(f"""
    select store_id, store_name, city, state, region, store_open_date,
           '{INGEST_TS}' as _ingestion_timestamp, '{INGEST_RUN}' as _run_id,
           'google_sheets' as _source, 'gsheets_ingest_script' as _ingested_by
    from raw_stores"""))
def _sheet_ingest(w):
    """Stores from a sheet-tab export; the landing copy is overwritten on
    every run, so running twice leaves one copy."""
    from chainyard import schemas
    from chainyard.sources.landing import land, read_sheet_export
    from chainyard.sources.lineage import add_lineage
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "sheet-ingest")
    fx.raw_stores(w.spark, w.sf_dir).drop("_ingestion_timestamp") \
      .write.option("header", "true").csv(f"{root}/export/Sheet1")
    dest = f"{root}/landing/store_data.parquet"
    for _ in range(2):
        tab = read_sheet_export(w.spark, f"{root}/export", "Sheet1", schemas.RAW["stores"])
        land(add_lineage(tab, "sheet", INGEST_TS, INGEST_RUN), dest, mode="overwrite")
    return w.spark.read.parquet(dest)


_SALES_COLS = ("transaction_id, store_id, product_id, quantity_sold, unit_price, discount_pct, "
               "sale_amount, transaction_timestamp, _ingestion_timestamp, _run_id, "
               "_source_table, order_line")


@register("sales_daily_union", O.with_models(f"""
    select {_SALES_COLS},
           cast(regexp_extract(_source_table, '^sales[_/](\\d{{4}})[_/](\\d{{2}})[_/](\\d{{2}})$', 1)
                as integer) as table_year,
           cast(regexp_extract(_source_table, '^sales[_/](\\d{{4}})[_/](\\d{{2}})[_/](\\d{{2}})$', 2)
                as integer) as table_month,
           cast(regexp_extract(_source_table, '^sales[_/](\\d{{4}})[_/](\\d{{2}})[_/](\\d{{2}})$', 3)
                as integer) as table_day
    from raw_sales"""))
def _sales_daily_union(w):
    """Every day's sales table landed under year/month folders, then the
    union of all discovered tables read back in one scan."""
    from pyspark.sql import functions as F
    from chainyard.sources import daily
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "daily-sales")
    daily.land_daily(fx.raw_sales(w.spark, w.sf_dir), f"{root}/postgres")
    union = daily.read_daily(w.spark, f"{root}/postgres")
    parts = daily.table_date_parts("_source_table")
    return union.withColumns({"table_year": parts["yyyy"].cast("int"),
                              "table_month": parts["mm"].cast("int"),
                              "table_day": parts["dd"].cast("int")})


@register("ingest_unseen_tables", O.with_models(f"""
    select {_SALES_COLS} from raw_sales r
    where not exists (select 1 from (select distinct _source_table as table_name
                                     from raw_sales
                                     where _source_table < 'sales_1998_01_01') seen
                      where seen.table_name = r._source_table)"""))
def _ingest_unseen_tables(w):
    """Only daily tables missing from the seen-set of an earlier run (the
    tables dated before 1998) are ingested."""
    from pyspark.sql import functions as F
    from chainyard.sources import daily
    from chainyard.testing import fixtures as fx
    raw = fx.raw_sales(w.spark, w.sf_dir)
    catalog = raw.select(F.col("_source_table").alias("table_name")).distinct()
    tables = daily.discover(catalog)
    seen = tables.filter(F.concat("yyyy", "mm", "dd") < F.lit("19980101"))
    todo = daily.unseen(tables, seen).select(F.col("table_name").alias("_source_table"))
    return raw.join(todo, "_source_table", "left_semi")


@register("modified_after_ingest", """
    select event_id, ts, user_id, event_type, value, props from events
    where ts >= timestamp '2024-01-16 00:00:00'""")
def _modified_after_ingest(w):
    """Two drops of event files; the second run lists the files modified since
    the watermark saved by the first, and reads those that were not listed
    then."""
    from pyspark.sql import functions as F
    from chainyard import state
    from chainyard.sources.files import list_files, read_paths
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "modified-after")
    events = fx.table(w.spark, w.sf_dir, "events")
    split = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    events.filter(split).write.options(**micros).json(f"{root}/drop/events/a")
    first = list_files(w.spark, f"{root}/drop/events").collect()
    mark = max(r.modificationTime for r in first).replace(tzinfo=None).isoformat() + "+00:00"
    state.save_state(w.spark, f"{root}/state/files", {"dynamic.events": mark})
    after = state.modified_after_option(
        state.load_state(w.spark, f"{root}/state/files")["dynamic.events"])
    events.filter(~split).write.options(**micros).json(f"{root}/drop/events/b")
    loaded = w.spark.createDataFrame([(r.path, r.modificationTime) for r in first],
                                     "path string, modificationTime timestamp")
    new = list_files(w.spark, f"{root}/drop/events", after).join(
        loaded, ["path", "modificationTime"], "left_anti")
    batch = read_paths(w.spark, [r.path for r in new.collect()], events.schema)
    return batch.data.drop("_source_key")


@register("raw_schema_merge_load", O.with_models(f"""
    select shipment_id, warehouse_id, store_id, product_id, quantity_shipped, shipment_date,
           expected_delivery_date, actual_delivery_date,
           case when _ingestion_timestamp > '{O.FIRST_RUN_UNTIL}' then carrier end as carrier,
           _ingestion_timestamp, _run_id
    from raw_shipments"""))
def _raw_schema_merge_load(w):
    """Two landing drops with different schemas loaded into RAW by two
    runs: each file loads once, columns merge by name."""
    from pyspark.sql import functions as F
    from chainyard.sources.landing import land, load_raw, read_raw
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    root = _scratch(w, "raw-load")
    ship = fx.raw_shipments(w.spark, w.sf_dir)
    land(first_run(ship).drop("carrier"), f"{root}/landing/shipments/a")
    load_raw(w.spark, f"{root}/landing", f"{root}/raw/shipments", f"{root}/raw/_loaded")
    land(ship.filter(F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL),
         f"{root}/landing/shipments/b")
    load_raw(w.spark, f"{root}/landing", f"{root}/raw/shipments", f"{root}/raw/_loaded")
    return read_raw(w.spark, f"{root}/raw/shipments", f"{root}/raw/_loaded")


@register("raw_load_damaged", O.with_models("""
    select shipment_id, warehouse_id, store_id, product_id, quantity_shipped, shipment_date,
           expected_delivery_date, actual_delivery_date, carrier, _ingestion_timestamp, _run_id
    from raw_shipments where quantity_shipped <= 45"""))
def _raw_load_damaged(w):
    """A landing some of whose files are no Parquet: the others load, once."""
    from pyspark.sql import functions as F
    from chainyard.sources.landing import land, load_log, load_raw, read_raw
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "raw-damaged")
    ship = fx.raw_shipments(w.spark, w.sf_dir)
    land(ship.filter("quantity_shipped <= 45"), f"{root}/landing/shipments")
    lost = ship.filter("quantity_shipped > 45").select(F.to_json(F.struct("*")).alias("value"))
    _drop(lost, f"{root}/text", "text", compression="none")
    jvm, conf = w.spark.sparkContext._jvm, w.spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)
    parts = [f.getPath() for f in fs.globStatus(path(f"{root}/text/_drop=0/part-*"))]
    for k, part in enumerate(parts):
        fs.rename(part, path(f"{root}/landing/shipments/odd-{k}.parquet"))
    for _ in range(2):
        load_raw(w.spark, f"{root}/landing", f"{root}/raw", f"{root}/_loaded")
    found = load_log(w.spark, f"{root}/_loaded").filter("error is not null").select("path").distinct()
    if found.count() != len(parts):
        raise AssertionError("not every damaged file was found")
    return read_raw(w.spark, f"{root}/raw", f"{root}/_loaded")


@register("raw_types_reconciled", O.with_models(f"""
    select shipment_id, warehouse_id, product_id, carrier, _run_id,
           cast(quantity_shipped + case when _ingestion_timestamp > '{O.FIRST_RUN_UNTIL}'
                and quantity_shipped > 25 then 0.25 else 0 end as decimal(21, 2)) as quantity_shipped,
           cast(shipment_date as timestamp) as shipment_date
    from raw_shipments"""))
def _raw_types_reconciled(w):
    """Landings in which a quantity comes as int, then as long and as decimal, and a
    date as a timestamp: loaded by two runs, no load rewritten, no value lost."""
    from pyspark.sql import functions as F
    from chainyard.sources.landing import land, load_raw, read_raw
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    root = _scratch(w, "raw-types")
    ship = fx.raw_shipments(w.spark, w.sf_dir).select(
        "shipment_id", "warehouse_id", "product_id", "carrier", "_run_id", "quantity_shipped",
        "shipment_date", "_ingestion_timestamp")
    later = ship.filter(F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL)
    quantity = F.col("quantity_shipped")
    drops = [first_run(ship),
             later.filter(quantity <= 25).withColumn("quantity_shipped", quantity.cast("long")),
             later.filter(quantity > 25)
             .withColumn("quantity_shipped", (quantity + F.lit(0.25)).cast("decimal(12,2)"))
             .withColumn("shipment_date", F.col("shipment_date").cast("timestamp_ntz"))]
    for run in (drops[:1], drops[1:]):
        for df in run:
            land(df.drop("_ingestion_timestamp"), f"{root}/landing/shipments")
        load_raw(w.spark, f"{root}/landing", f"{root}/raw", f"{root}/_loaded")
    return read_raw(w.spark, f"{root}/raw", f"{root}/_loaded")


@register("raw_types_refused", O.with_models("""
    select 'loaded' as outcome, cast(null as varchar) as reason, count(*) as n_rows
    from raw_shipments where quantity_shipped <= 45
    union all
    select 'refused', 'column shipment_date: int does not go with date', count(*)
    from raw_shipments where quantity_shipped > 45"""))
def _raw_types_refused(w):
    """A landing whose day became a number: its files are refused by name, the others load."""
    from pyspark.sql import functions as F
    from chainyard.sources.landing import land, load_log, load_raw, read_raw
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "raw-refused")
    ship = fx.raw_shipments(w.spark, w.sf_dir)
    day = F.date_format("shipment_date", "yyyyMMdd").cast("int")
    land(ship.filter("quantity_shipped <= 45"), f"{root}/landing/a")
    land(ship.filter("quantity_shipped > 45").withColumn("shipment_date", day), f"{root}/landing/b")
    load_raw(w.spark, f"{root}/landing", f"{root}/raw", f"{root}/_loaded")
    log = load_log(w.spark, f"{root}/_loaded").filter("error is not null")
    files = w.spark.read.parquet(f"{root}/landing/b").groupBy(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file")).count()
    refused = log.select(F.element_at(F.split("path", "/"), -1).alias("file"), "error").join(
        files, "file").groupBy("error").agg(F.sum("count").alias("n_rows"))
    loaded = read_raw(w.spark, f"{root}/raw", f"{root}/_loaded").agg(F.count("*").alias("n_rows"))
    return loaded.select(F.lit("loaded").alias("outcome"), F.lit(None).cast("string").alias("reason"),
                         "n_rows").unionByName(
        refused.select(F.lit("refused").alias("outcome"), F.col("error").alias("reason"), "n_rows"))


# -- profiles, checksums, read-back validation (A2, A4, Q8-Q13, K10, K11) ----
_PROFILE_NUMERIC = ("quantity_sold", "unit_price", "discount_pct", "sale_amount")
_PROFILE_OTHER = ("transaction_id", "store_id", "product_id", "transaction_timestamp",
                  "transaction_date")


def _profile_sql() -> str:
    parts = []
    for c in _PROFILE_NUMERIC:
        v = f"cast({c} as decimal(38,6))"
        parts.append(f"select '{c}' as column_name, "
                     f"cast(count(*) filter (where {c} is null) as bigint) as null_count, "
                     f"min({v}) as min, max({v}) as max, "
                     f"cast(coalesce(sum({v}), 0) as decimal(38,6)) as sum from stg_sales")
    for c in _PROFILE_OTHER:
        parts.append(f"select '{c}' as column_name, "
                     f"cast(count(*) filter (where {c} is null) as bigint) as null_count, "
                     f"cast(null as decimal(38,6)) as min, cast(null as decimal(38,6)) as max, "
                     f"cast(null as decimal(38,6)) as sum from stg_sales")
    return O.with_models("\nunion all\n".join(parts))


@register("column_profile", _profile_sql())
def _column_profile(w):
    from chainyard.operators.validate import profile
    return profile(w.stg("sales"))


@register("table_checksum_match", O.with_models("""
    select 'stg_sales' as table_name, count(*) as row_count, true as checksum_match
    from stg_sales
    union all
    select 'stg_shipments', count(*), true from stg_shipments
    union all
    select 'stg_inventory', count(*), true from stg_inventory"""))
def _table_checksum_match(w):
    """Checksum of each staged table equals that of its Parquet round trip
    read back with a different partitioning.  One table at a time is on disk: its
    checksums are noted, then its copy and the shuffles are deleted."""
    from pyspark.sql import functions as F
    from chainyard.operators.validate import checksum
    from chainyard.session import remove_path
    root = _scratch(w, "checksum")
    out = None
    for name in ("sales", "shipments", "inventory"):
        df = w.stg(name)
        with shuffles_dropped(w.spark):
            df.write.option("compression", "zstd").parquet(f"{root}/{name}")
        # by the first two columns, of which one at least has many values
        back = w.spark.read.parquet(f"{root}/{name}").repartition(*df.columns[:2])
        a = _stored(w, "checksum-source", checksum(df).select(
            F.col("row_count"), F.col("checksum").alias("a")))
        b = _stored(w, "checksum-copy", checksum(back).select(
            F.col("checksum").alias("b"), F.col("row_count").alias("n")))
        remove_path(w.spark, f"{root}/{name}")
        row = a.join(b, F.col("row_count") == F.col("n"), "full_outer").select(
            F.lit(f"stg_{name}").alias("table_name"), F.col("row_count"),
            (F.col("a") == F.col("b")).alias("checksum_match"))
        out = row if out is None else out.unionByName(row)
    return out


_RAW_DATA_COLS = {"products": 6, "suppliers": 4, "warehouses": 3, "stores": 6, "sales": 9,
                  "shipments": 9, "inventory": 5}


@register("validate_readback", O.with_models("\nunion all\n".join(
    f"select '{n}' as source_name, 'PASSED' as status, count(*) as rows_source, "
    f"count(*) as rows_dest, {k} as columns_source, {k} as columns_dest, "
    f"true as row_count_passed, true as column_count_passed, true as schema_passed, "
    f"true as checksum_passed, true as col_stats_passed from raw_{n}"
    for n, k in _RAW_DATA_COLS.items())))
def _validate_readback(w):
    """Every raw source landed as Parquet (source measured during the
    write), read back and validated; the reports are appended to the
    validation log and read from it."""
    from pyspark.sql import functions as F
    from chainyard.operators.validate import load_history, save_reports
    from chainyard.sources.ingest import land_validated
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "readback")
    reports = []
    for name in _RAW_DATA_COLS:
        rep = land_validated(fx.RAW[name](w.spark, w.sf_dir), f"{root}/landing/{name}.parquet",
                             INGEST_RUN, name)
        rep["validated_at"] = INGEST_TS
        reports.append(rep)
    save_reports(w.spark, reports, f"{root}/monitoring/validation")
    hist = load_history(w.spark, f"{root}/monitoring/validation")
    return hist.select("source_name", "status", "rows_source", "rows_dest",
                       F.col("columns_source").cast("int").alias("columns_source"),
                       F.col("columns_dest").cast("int").alias("columns_dest"),
                       "row_count_passed", "column_count_passed", "schema_passed",
                       "checksum_passed", "col_stats_passed")


# -- the whole warehouse run twice through the versioned store ------------
@register("warehouse_run", O.warehouse_run_sales_sql())
def _warehouse_run(w):
    """Two scheduled runs: snapshots, dimensions, incremental facts, data
    tests, publish.  Run 1 sees the batches ingested up to 1998 and the
    original products; run 2 sees everything and the re-branded products.
    Raw inputs are first landed as RAW tables, as ingestion does.
    Returns the published sales fact: rows of run 1 keep the product
    version they were linked to then (facts are not re-linked later)."""
    from chainyard.plans.run import run_batch
    from chainyard.store import TableStore
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    store = TableStore(w.spark, _scratch(w, "warehouse"))
    for i, run_ts in enumerate(fx.PRODUCT_RUNS):
        raw = {e: fx.RAW[e](w.spark, w.sf_dir) for e in ("suppliers", "warehouses", "stores")}
        raw["products"] = fx.product_batch(w.spark, w.sf_dir, i + 1, fx.PRODUCT_RUNS)
        for e in ("sales", "shipments", "inventory"):
            r = fx.RAW[e](w.spark, w.sf_dir)
            raw[e] = first_run(r) if i == 0 else r
        landed = {(e, "RAW"): store.stage(e, df, "RAW") for e, df in raw.items()}
        store.publish(landed)
        raw = {e: store.read(e, "RAW") for e in raw}
        run_batch(w.spark, store, raw, run_ts, fx.AS_OF, calendar=fx.CALENDAR)
    return store.read("fct_sales", "MARTS")


# -- lossless file ingestion on damaged drops ------------------------------
@register("csv_header_order", """
    select 'c' || cast(c_custkey as varchar) as customer_id, c_name as customer_name,
           cast(c_nationkey as integer) as nation, cast(c_acctbal as decimal(15,2)) as balance
    from customer""")
def _csv_header_order(w):
    """Customers dropped as CSV files whose columns stand in two orders, one
    with a column more: matched by header name."""
    from pyspark.sql import functions as F
    from chainyard.sources.files import read_batch
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "csv-header")
    c = fx.table(w.spark, w.sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer_name"), F.col("c_nationkey").cast("int").alias("nation"),
        F.col("c_acctbal").cast("decimal(15,2)").alias("balance"))
    even = F.col("nation") % 2 == 0
    _drop(c.filter(even), f"{root}/drop/a")
    _drop(c.filter(~even).select("balance", "nation", F.lit("x").alias("note"), "customer_name",
                                 "customer_id"), f"{root}/drop/b")
    batch = read_batch(w.spark, f"{root}/drop", c.schema)
    if batch.rejected:
        raise AssertionError(batch.rejected)
    return batch.data.select(c.columns)


@register("json_layouts", """
    select cast(s_suppkey as bigint) as id, s_name as name,
           case s_nationkey % 3 when 0 then 'lines' when 1 then 'array' else 'pretty' end as layout
    from supplier""")
def _json_layouts(w):
    """Suppliers dropped as JSON lines, as one-line arrays and as arrays over
    several lines: no record is lost."""
    from functools import reduce
    from pyspark.sql import functions as F
    from chainyard.sources.files import list_files, read_batch, read_json
    from chainyard.sources.heads import file_layouts
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "json-layouts")
    kind = F.element_at(F.array(F.lit("lines"), F.lit("array"), F.lit("pretty")),
                        (F.col("s_nationkey") % 3 + 1).cast("int"))
    s = fx.table(w.spark, w.sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("id"), F.col("s_name").alias("name"),
        kind.alias("layout"))
    s.filter("layout = 'lines'").coalesce(2).write.json(f"{root}/drop/lines")
    # an array holds the suppliers of a hundred ids: on one line, or a record a line
    record = F.to_json(F.struct("id", "name", "layout"))
    for layout, gap in (("array", ", "), ("pretty", ",\n")):
        text = F.concat(F.lit("[" if gap == ", " else "[\n"),
                        F.concat_ws(gap, F.collect_list(record)),
                        F.lit("]" if gap == ", " else "\n]"))
        one = s.filter(F.col("layout") == layout).groupBy(F.floor(F.col("id") / 100).alias("file")).agg(
            text.alias("value"))
        (one.write.partitionBy("file").option("lineSep", "\n").text(f"{root}/drop/{layout}"))
    # Spark's text writer names its files .txt; their content is JSON
    batch = read_batch(w.spark, f"{root}/drop/lines", s.schema)
    parts = [batch.data]
    for layout in ("array", "pretty"):
        paths = [r.path for r in list_files(w.spark, f"{root}/drop/{layout}").collect()]
        found = file_layouts(w.spark, [(p, "json") for p in paths])
        for k in sorted({v[0] for v in found.values()}):
            parts.append(read_json(w.spark, [p for p in paths if found[p][0] == k], s.schema, layout=k))
    return reduce(DataFrame.unionByName, [p.select("id", "name", "layout") for p in parts])


@register("hostile_heads", """
    select cast(c_custkey as bigint) as id, if(c_nationkey % 4 = 0, concat('a', chr(8232), 'b', chr(133),
           c_name), c_name) as name, case c_nationkey % 4 when 0 then 'separators' when 1 then 'junk'
           when 2 then 'long' else 'header' end as kind
    from customer""")
def _hostile_heads(w):
    """Customers dropped as files whose first line misleads: JSON strings with
    U+2028 and U+0085, a first line of junk, a first record of more than 64 KiB,
    a CSV header of more than 64 KiB.  Every sound record lands."""
    from pyspark.sql import functions as F
    from chainyard.sources.files import read_batch
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "hostile-heads")
    nation = F.col("c_nationkey") % 4
    name = F.when(nation == 0, F.concat(F.lit("a\u2028b\u0085"), "c_name")).otherwise(F.col("c_name"))
    c = fx.table(w.spark, w.sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("id"), name.alias("name"),
        F.element_at(F.array(*map(F.lit, ("separators", "junk", "long", "header"))),
                     (nation + 1).cast("int")).alias("kind"))
    pad = F.when(F.col("id") == F.col("least"), F.lit("x" * 70_000)).otherwise(F.lit("y"))
    for kind in ("separators", "junk", "long"):
        rows = c.filter(F.col("kind") == kind)
        least = rows.agg(F.min("id").alias("least"))
        # one file, in order: what misleads stands first
        lines = rows.join(F.broadcast(least)).select("id", F.to_json(F.struct(
            "id", "name", "kind", *([pad.alias("note")] if kind == "long" else []))).alias("value"))
        if kind == "junk":
            lines = lines.unionByName(w.spark.sql("select -1L as id, '-- exported --' as value"))
        folder = f"{root}/made/{kind}"
        lines.coalesce(1).sortWithinPartitions("id").select("value").write.text(folder)
    header = c.filter("kind = 'header'").select(F.lit("n").alias("n" * 70_000), "kind", "name", "id")
    header.coalesce(1).write.option("header", "true").csv(f"{root}/drop")
    # Spark's text writer names its files .txt: give them the name that drops have
    jvm, conf = w.spark.sparkContext._jvm, w.spark.sparkContext._jsc.hadoopConfiguration()
    for kind in ("separators", "junk", "long"):
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/made/{kind}")
        fs = folder.getFileSystem(conf)
        for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/made/{kind}/part-*")):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{root}/drop/{kind}.json"))
    batch = read_batch(w.spark, f"{root}/drop", c.schema, corrupt_col="_corrupt")
    batch.corrupt.write.parquet(f"{root}/aside")
    if batch.rejected or w.spark.read.parquet(f"{root}/aside").count() != 1:
        raise AssertionError(batch.rejected)
    return batch.data.select("id", "name", "kind")


@register("quarantine_counts", """
    select 'lineitem' as source, count(*) as source_lines,
           cast(count(*) filter (where l_linenumber = 3) as bigint) as quarantined,
           cast(count(*) filter (where l_linenumber <> 3) as bigint) as landed,
           sum(cast(l_quantity as bigint)) filter (where l_linenumber <> 3) as quantity
    from lineitem""")
def _quarantine_counts(w):
    """Line items dropped as CSV, a third line's quantity damaged: the run
    lands the sound rows, quarantines the damaged and counts both."""
    from pyspark.sql import functions as F
    from chainyard.sources.ingest import ingest_files
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "quarantine")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    damaged = F.when(F.col("l_linenumber") == 3, "oops").otherwise(quantity)
    _drop(fx.table(w.spark, w.sf_dir, "lineitem").select("l_orderkey", damaged.alias("quantity")),
          f"{root}/drop/lines")
    schema = w.spark.createDataFrame([], "l_orderkey bigint, quantity bigint").schema
    run = ingest_files(w.spark, f"{root}/drop", f"{root}/landing", f"{root}/state",
                       {"lines": schema}, dynamic=["lines"])
    landed = w.spark.read.parquet(run.landed["lines"])
    bad = w.spark.read.parquet(f"{root}/landing/_quarantine/lines/run={run.run_id}")
    a = landed.agg(F.count(F.lit(1)).alias("landed"), F.sum("quantity").alias("quantity"))
    b = bad.agg(F.count(F.lit(1)).alias("quarantined"))
    key = F.lit("lineitem").alias("source")
    return a.select(key, "*").join(b.select(key, "*"), "source").select(
        "source", (F.col("landed") + F.col("quarantined")).alias("source_lines"), "quarantined",
        "landed", "quantity")


@register("ingest_isolation", """
    select 'c' || cast(c_custkey as varchar) as id, cast(count(*) as bigint) as copies
    from customer group by 1""")
def _ingest_isolation(w):
    """Three runs over three drops of customers, with a folder that always
    fails and a file of unknown type that is retried: each row lands once."""
    from pyspark.sql import functions as F
    from chainyard.sources.ingest import ingest_files
    from chainyard.testing import fixtures as fx
    root = _scratch(w, "isolation")
    c = fx.table(w.spark, w.sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), "c_nationkey")
    schema = w.spark.createDataFrame([], "id string").schema
    c.limit(1).select("id").coalesce(1).write.option("header", "true").csv(f"{root}/drop/broken")
    c.limit(1).select("id").coalesce(1).write.orc(f"{root}/drop/good/odd")
    landed = None
    for k in range(3):
        _drop(c.filter(F.col("c_nationkey") % 3 == k).select("id"), f"{root}/drop/good/{k}")
        run = ingest_files(w.spark, f"{root}/drop", f"{root}/landing", f"{root}/state",
                           {"good": schema}, dynamic=["broken", "good"], raise_on_failure=False)
        part = w.spark.read.parquet(run.landed["good"]).select("id")
        landed = part if landed is None else landed.unionByName(part)
        if len(run.failed) != 2:
            raise AssertionError(run.failed)
    return landed.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))


@register("validate_damaged_copy", O.with_models("""
    select source_name, if(row_count_passed and schema_passed and checksum_passed
                           and col_stats_passed, 'PASSED', 'FAILED') as status,
           n as rows_source, if(row_count_passed, n, m) as rows_dest, row_count_passed,
           schema_passed, checksum_passed, col_stats_passed
    from (select count(*) as n, count(*) filter (where product_id not like '%7') as m
          from raw_sales),
         (values ('as it is', true, true, true, true), ('rows dropped', false, true, false, false),
                 ('value changed', true, true, false, false),
                 ('column retyped', true, false, false, true),
                 ('column lost', true, false, false, false))
             as known(source_name, row_count_passed, schema_passed, checksum_passed,
                      col_stats_passed)"""))
def _validate_damaged_copy(w):
    """Sales against copies with known damage: which checks fail."""
    from functools import reduce
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F
    from chainyard.operators.validate import compare_copies, described
    from chainyard.testing import fixtures as fx
    raw = _stored(w, "sales", fx.raw_sales(w.spark, w.sf_dir))
    first = raw.agg(F.min("transaction_id")).first()[0]
    copies = {
        "as it is": raw, "rows dropped": raw.filter("product_id not like '%7'"),
        "value changed": raw.withColumn("quantity_sold", F.when(
            F.col("transaction_id") == first, F.col("quantity_sold") + 1)
            .otherwise(F.col("quantity_sold")).cast(raw.schema["quantity_sold"].dataType)),
        "column retyped": raw.withColumn("quantity_sold", F.col("quantity_sold").cast("decimal(20,0)")),
        "column lost": raw.drop("discount_pct")}
    both = [reduce(DataFrame.unionByName, [described(pick(df), n) for n, df in copies.items()])
            for pick in (lambda _: raw, lambda df: df)]
    return compare_copies(*both, INGEST_RUN, INGEST_TS).select(
        "source_name", "status", "rows_source", "rows_dest", "row_count_passed", "schema_passed",
        "checksum_passed", "col_stats_passed")


_SALE_DATA = ("transaction_id, store_id, product_id, quantity_sold, unit_price, discount_pct, "
              "sale_amount, transaction_timestamp")
_DAMAGED_SALES = f"""
    damaged as (
        select * replace (case when store_id like '%13' then quantity_sold + 1
                               else quantity_sold end as quantity_sold)
        from (select {_SALE_DATA} from raw_sales)
        where not (product_id like '%77' and quantity_sold > 45)
        union all
        select {_SALE_DATA} from raw_sales where store_id like '%31' and quantity_sold = 1),
    sound as (select {_SALE_DATA} from raw_sales)"""


def _damaged_sales(w):
    """Sales and a copy of them with rows lost, changed and landed twice."""
    from pyspark.sql import functions as F
    from chainyard.testing import fixtures as fx
    sales = _stored(w, "sales", fx.raw_sales(w.spark, w.sf_dir).select(*_SALE_DATA.split(", ")))
    kept = sales.filter("not (product_id like '%77' and quantity_sold > 45)")
    changed = kept.withColumn("quantity_sold", F.expr(
        "cast(if(store_id like '%13', quantity_sold + 1, quantity_sold) as int)"))
    return sales, changed.unionByName(sales.filter("store_id like '%31' and quantity_sold = 1"))


@register("validate_differing_rows", O.with_models(f"""
    , {_DAMAGED_SALES.strip()},
    found as (select 'missing' as finding, * from (select * from sound except all select * from damaged)
              union all
              select 'extra', * from (select * from damaged except all select * from sound))
    select finding, count(*) as copies, {_SALE_DATA} from found group by all"""))
def _validate_differing_rows(w):
    """The very rows of a damaged copy that are lost, changed or landed twice."""
    from chainyard.operators.differences import differing_rows
    rows = differing_rows(*_damaged_sales(w), part="date_format(transaction_timestamp, 'yyyy-MM')")
    return rows.select("finding", "copies", *_SALE_DATA.split(", "))


@register("validate_differing_months", O.with_models(f"""
    , {_DAMAGED_SALES.strip()},
    found as ((select * from sound except all select * from damaged)
              union all (select * from damaged except all select * from sound)),
    months as (select distinct strftime(transaction_timestamp, '%Y-%m') as part from found)
    select part, (select count(*) from sound where strftime(transaction_timestamp, '%Y-%m') = part)
                     as rows_source,
           (select count(*) from damaged where strftime(transaction_timestamp, '%Y-%m') = part)
               as rows_copy
    from months"""))
def _validate_differing_months(w):
    """The months in which a damaged copy differs from its source."""
    from chainyard.operators.differences import differing_parts
    return differing_parts(*_damaged_sales(w), part="date_format(transaction_timestamp, 'yyyy-MM')"
                           ).drop("buckets_differing")


# -- history with closed versions on every dimension -------------------------
for _entity in ("suppliers", "stores", "warehouses"):
    register(f"snap_{_entity}_v2", O.with_models(
        O.two_run_snapshot_sql(_entity, *O.SNAPSHOT_COLS[_entity])))(
        lambda w, _e=_entity: w.snap_two_runs(_e))


@register("fct_shipments_moved_warehouses", O.with_models(O.shipments_with_versions(
    "dim_product",
    f"({O.two_run_snapshot_sql('warehouses', *O.SNAPSHOT_COLS['warehouses'])})")))
def _fct_shipments_moved_warehouses(w):
    """Shipments meet closed versions on both dimension sides."""
    from chainyard.plans import dims, facts
    from chainyard.testing import fixtures as fx
    return facts.fct_shipments(w.stg("shipments"), w.calendar(), w.dim_product(),
                               dims.dim_warehouse(w.snap_two_runs("warehouses")), fx.AS_OF)


# -- the whole chain: drops -> landing -> RAW -> staging -> marts -> tests ------
@register("chain_two_runs", O.chain_sql())
def _chain_two_runs(w):
    """Two scheduled runs from dropped files and daily tables to published
    marts.  The second run's product refresh re-brands some products and lacks
    others; later sales of those link to no version."""
    import datetime as dt
    from functools import reduce
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F
    from chainyard import schemas
    from chainyard.plans.run import run_batch
    from chainyard.sources.ingest import ingest_files, ingest_sales_tables, ingest_sheet
    from chainyard.sources.landing import load_raw, read_raw
    from chainyard.store import TableStore
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    root, spark = _scratch(w, "chain"), w.spark
    store = TableStore(spark, f"{root}/warehouse")
    late = F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL
    raw = {e: fx.RAW[e](spark, w.sf_dir) for e in fx.RAW}

    def drop(entity, df, tag, fmt="csv"):
        _drop(df.select(*schemas.RAW[entity].names), f"{root}/drops/{entity}/{tag}", fmt)

    for run, run_ts in enumerate(fx.PRODUCT_RUNS, start=1):
        new = first_run if run == 1 else (lambda df: df.filter(late))
        drop("products", fx.product_refresh(spark, w.sf_dir, run), "all")
        for e in ("suppliers", "warehouses"):
            drop(e, raw[e], "all")
        drop("shipments", new(raw["shipments"]), f"run{run}", "json")
        drop("inventory", new(raw["inventory"]), f"run{run}")
        raw["stores"].select(*schemas.RAW["stores"].names).write.mode("overwrite").option(
            "header", "true").csv(f"{root}/export/Sheet1")
        now, run_id = dt.datetime.fromisoformat(fx.iso(run_ts)), f"run-{run}"
        ingest_files(spark, f"{root}/drops", f"{root}/landing", f"{root}/state/files", schemas.RAW,
                     dynamic=["shipments", "inventory"],
                     static=["products", "suppliers", "warehouses"], now=now, run_id=run_id)
        sales = new(raw["sales"]).select(*schemas.RAW["sales"].names)
        tables = {f"sales_{2000 + run}_01_0{k + 1}": sales.filter(
            F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == k) for k in range(2)}
        ingest_sales_tables(spark, tables.__getitem__, list(tables), f"{root}/landing/sales",
                            f"{root}/state/sales", run_id=run_id)
        ingest_sheet(spark, f"{root}/export", "Sheet1", f"{root}/landing/stores",
                     schemas.RAW["stores"], run_id=run_id)
        batch = {}
        for e in fx.RAW:
            load_raw(spark, f"{root}/landing/{e}", f"{root}/raw/{e}", f"{root}/raw/_log_{e}")
            batch[e] = read_raw(spark, f"{root}/raw/{e}", f"{root}/raw/_log_{e}")
        run_batch(spark, store, batch, run_ts, fx.AS_OF, calendar=fx.CALENDAR)

    def long(name, layer, key, version, amount):
        return store.read(name, layer).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), version.alias("version"),
            amount.cast("int").alias("amount"))

    return reduce(DataFrame.unionByName, [
        long("fct_sales", "MARTS", "transaction_id", F.col("product_surrogate_key"),
             F.col("quantity_sold")),
        long("fct_shipments", "MARTS", "shipment_id",
             F.concat_ws("/", "product_surrogate_key", "warehouse_surrogate_key"),
             F.col("delivery_days_variance")),
        long("fct_inventory", "MARTS", "inventory_key", F.col("stock_level"),
             F.col("quantity_available")),
        long("snap_products", "SNAPSHOTS", "surrogate_key", F.col("brand"), F.col("is_current"))])


# -- streaming ingestion (file source, available-now, keyed merge) --------
@register("stream_ingest", O.with_models("""
    select shipment_id, warehouse_id, store_id, product_id, quantity_shipped, shipment_date,
           expected_delivery_date, actual_delivery_date, carrier, _ingestion_timestamp, _run_id
    from raw_shipments"""))
def _stream_ingest(w):
    """Shipment files arrive in two drops; an available-now stream run
    after each drop merges only the new files into the RAW table; a third
    run with no new file starts no batch."""
    from pyspark.sql import functions as F
    from chainyard import schemas
    from chainyard.store import TableStore
    from chainyard.streaming.ingest import file_stream, merge_stream_into
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    root = _scratch(w, "stream")
    store = TableStore(w.spark, f"{root}/store")
    ship = fx.raw_shipments(w.spark, w.sf_dir)
    schema = schemas.with_lineage(schemas.RAW["shipments"], "_ingestion_timestamp", "_run_id")
    drops = [first_run(ship), ship.filter(F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL)]
    runs = []
    for i, drop in enumerate(drops + [None]):
        if drop is not None:
            drop.write.option("compression", "gzip").json(f"{root}/landing/shipments/drop={i}")
        stream = file_stream(w.spark, f"{root}/landing/shipments", schema,
                             recursiveFileLookup="true")
        runs.append(merge_stream_into(stream, store, "shipments", "shipment_id",
                                      f"{root}/checkpoint/shipments", "RAW"))
    if runs[-1] != 0:
        raise AssertionError(f"a run without new files started {runs[-1]} batch(es)")
    return store.read("shipments", "RAW")


# -- ingestion runs: watermarks, static cadence, per-folder validation ------
_DYNAMIC = {"shipments": "json", "inventory": "csv"}
_STATIC = ("products", "suppliers", "warehouses")


def _ingest_run_sql() -> str:
    parts = []
    for name in _DYNAMIC:
        for run, cmp in ((1, "<="), (2, ">")):
            parts.append(f"select {run} as run, '{name}' as source_name, 'PASSED' as status, "
                         f"count(*) as rows_source, count(*) as rows_dest from raw_{name} "
                         f"where _ingestion_timestamp {cmp} '{O.FIRST_RUN_UNTIL}'")
    for name in _STATIC:
        parts.append(f"select 1 as run, '{name}' as source_name, 'PASSED' as status, "
                     f"count(*) as rows_source, count(*) as rows_dest from raw_{name}")
    return O.with_models("\nunion all\n".join(parts))


@register("ingest_run", _ingest_run_sql())
def _ingest_run(w):
    """Two scheduled file-ingestion runs.  Run 1 lands every folder; run 2
    lands only the dynamic files dropped after run 1's watermark, and skips
    the static folders (refreshed less than 30 days ago).  Every landing is
    read back and validated; the reports are the result."""
    from pyspark.sql import functions as F
    from chainyard import schemas
    from chainyard.sources.ingest import ingest_files
    from chainyard.testing import fixtures as fx
    from chainyard.testing.scenario import first_run
    root = _scratch(w, "ingest-run")
    spark = w.spark

    def drop(name, df, tag):
        _drop(df.select(*schemas.RAW[name].names), f"{root}/source/{name}/{tag}",
              _DYNAMIC.get(name, "csv"), compression="gzip")

    for name in _DYNAMIC:
        drop(name, first_run(fx.RAW[name](spark, w.sf_dir)), "a")
    for name in _STATIC:
        drop(name, fx.RAW[name](spark, w.sf_dir), "a")
    rows = []
    for run in (1, 2):
        res = ingest_files(spark, f"{root}/source", f"{root}/landing", f"{root}/state",
                           schemas.RAW, dynamic=list(_DYNAMIC), static=_STATIC,
                           bucket=DROP_BUCKET)
        rows += [(run, r["source_name"], r["status"], r["rows_source"], r["rows_dest"])
                 for r in res.reports]
        if run == 1:
            for name in _DYNAMIC:
                raw = fx.RAW[name](spark, w.sf_dir)
                drop(name, raw.filter(F.col("_ingestion_timestamp") > O.FIRST_RUN_UNTIL), "b")
    return spark.createDataFrame(
        rows, "run int, source_name string, status string, rows_source long, rows_dest long")
