"""Supply-chain raw inputs derived from the driver's TPC-H-style tables.

The driver's data has no supply-chain entities, so each raw source is a
fixed expression over its tables (see FIXTURES.md).  Everything here is a
lazy DataFrame over the whole tables: work grows with the scale factor.
Decimals are cast *before* arithmetic so results agree with other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainyard.session import configure

# Fixed values of the fixture scenario.
STATIC_INGESTED_AT = "1996-01-01T00:00:00+00:00"
# Snapshot run instants of the product history used by the marts: every
# product at the first run; PROMO products re-branded at the second.
PRODUCT_RUNS = ("1996-01-01 00:00:00", "1998-07-01 00:00:00")
DIM_RUN = "1996-01-01 00:00:00"
# Four snapshot runs exercising every SCD2 rule: insert; checked change
# (PROMO re-brand) plus an unchecked change (new ingestion stamp); delete
# (size > 45 discontinued); reappearance.
SCENARIO_RUNS = ("1996-01-01 00:00:00", "1997-01-01 00:00:00",
                 "1998-01-01 00:00:00", "1999-01-01 00:00:00")
REBRAND_TYPE = "PROMO"
DISCONTINUED_MIN_SIZE = 45
# Calendar covering every fact date of the fixture (sales 1995-2001).
CALENDAR = {"start": "1995-01-01", "as_of": "2001-12-31"}
AS_OF = CALENDAR["as_of"]
# The date of each fact.
FACT_DATES = {"sales": "transaction_date", "shipments": "shipment_date",
              "inventory": "snapshot_date"}


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table ``name`` (read once per session: listing and
    footer reads are not repeated for every model that uses it)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def iso(ts: str) -> str:
    """'1996-01-01 00:00:00' -> '1996-01-01T00:00:00+00:00'."""
    return ts.replace(" ", "T") + "+00:00"


def _year_stamp(c) -> F.Column:
    return F.concat(F.year(c).cast("string"), F.lit("-01-01T02:00:00+00:00"))


def _run_of_year(c) -> F.Column:
    return F.concat(F.lit("run-"), F.year(c).cast("string"))


def _line_id() -> F.Column:
    return F.concat_ws("-", *(F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
                      F.col("l_shipdate").cast("date").cast("string"))


def _products(spark, sf_dir, ingested_at: str, max_size: int | None = None) -> DataFrame:
    configure(spark)
    part = table(spark, sf_dir, "part")
    if max_size is not None:
        part = part.filter(F.col("p_size") <= max_size)
    n_suppliers = table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("S"), (F.col("p_partkey") % n_suppliers).cast("string")).alias("supplier_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
    )


def raw_products(spark, sf_dir, ingested_at: str = STATIC_INGESTED_AT) -> DataFrame:
    return _products(spark, sf_dir, ingested_at)


def product_batch(spark, sf_dir, run: int, runs=SCENARIO_RUNS) -> DataFrame:
    """Product source as seen by snapshot run ``run`` (1-based) of ``runs``.

    Run >= 2 re-brands PROMO products; run 3 (only when there are 4 runs)
    lacks discontinued products, which come back at run 4.
    """
    discontinued = run == 3 and len(runs) >= 4
    base = _products(spark, sf_dir, iso(runs[run - 1]),
                     DISCONTINUED_MIN_SIZE if discontinued else None)
    if run >= 2:
        base = base.withColumn(
            "brand", F.when(F.col("category") == REBRAND_TYPE, F.concat("brand", F.lit("-R")))
                      .otherwise(F.col("brand")))
    return base


def product_refresh(spark, sf_dir, run: int) -> DataFrame:
    """Full refresh ``run`` (1 or 2) of the products, as files carry it: the
    second re-brands PROMO products and lacks the discontinued ones."""
    base = _products(spark, sf_dir, iso(PRODUCT_RUNS[run - 1]),
                     DISCONTINUED_MIN_SIZE if run == 2 else None)
    if run == 2:
        promo = F.col("category") == REBRAND_TYPE
        base = base.withColumn("brand", F.when(promo, F.concat("brand", F.lit("-R")))
                               .otherwise(F.col("brand")))
    return base


# The second snapshot run of the other dimensions: which rows change what.
SECOND_RUN = {
    "suppliers": ("category", "RAW", "country"),
    "stores": ("region", "ASIA", "city"),
    "warehouses": ("state", "ASIA", "city"),
}


def raw_suppliers(spark, sf_dir, ingested_at: str = STATIC_INGESTED_AT) -> DataFrame:
    configure(spark)
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    k = F.col("s_suppkey") % 3
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.when(k == 0, "RAW").when(k == 1, "PARTS").otherwise("PACKAGING").alias("category"),
        F.col("n_name").alias("country"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
    )


def raw_warehouses(spark, sf_dir, ingested_at: str = STATIC_INGESTED_AT) -> DataFrame:
    configure(spark)
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("W"), F.col("n_nationkey").cast("string")).alias("warehouse_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
    )


def raw_stores(spark, sf_dir, ingested_at: str = STATIC_INGESTED_AT) -> DataFrame:
    configure(spark)
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
                .join(region, nation.n_regionkey == region.r_regionkey)
                .select(
        F.concat(F.lit("ST"), F.col("c_custkey").cast("string")).alias("store_id"),
        F.col("c_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("state"),
        F.col("r_name").alias("region"),
        F.date_add(F.lit("1995-01-01").cast("date"),
                   (F.col("c_custkey") % 365).cast("int")).alias("store_open_date"),
        F.lit(ingested_at).alias("_ingestion_timestamp"),
    ))


def raw_sales(spark, sf_dir) -> DataFrame:
    """One sale per line item; ingested in yearly batches by ship year."""
    configure(spark)
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    return j.select(
        _line_id().alias("transaction_id"),
        F.concat(F.lit("ST"), F.col("o_custkey").cast("string")).alias("store_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity_sold"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_discount").cast("decimal(5,4)").alias("discount_pct"),
        F.expr("cast(cast(l_quantity as decimal(4,0)) * cast(p_retailprice as decimal(10,2))"
               " * (cast(1 as decimal(5,4)) - cast(l_discount as decimal(5,4)))"
               " as decimal(10,2))").alias("sale_amount"),
        F.col("o_orderdate").alias("transaction_timestamp"),
        _year_stamp(F.col("l_shipdate")).alias("_ingestion_timestamp"),
        _run_of_year(F.col("l_shipdate")).alias("_run_id"),
        F.concat(F.lit("sales_"), F.date_format("o_orderdate", "yyyy_MM_dd")).alias("_source_table"),
        # kept for the duplicate-key merge scenario; staging does not select it
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("order_line"),
    )


def raw_shipments(spark, sf_dir) -> DataFrame:
    configure(spark)
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(sup, li.l_suppkey == sup.s_suppkey))
    ship = F.col("l_shipdate").cast("date")
    return j.select(
        _line_id().alias("shipment_id"),
        F.concat(F.lit("W"), F.col("s_nationkey").cast("string")).alias("warehouse_id"),
        F.concat(F.lit("ST"), F.col("o_custkey").cast("string")).alias("store_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity_shipped"),
        ship.alias("shipment_date"),
        F.date_add(ship, 7).alias("expected_delivery_date"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("date"))
         .otherwise(F.date_add(ship, (F.col("l_orderkey") % 15).cast("int")))
         .alias("actual_delivery_date"),
        F.concat(F.lit("CARRIER_"), (F.col("l_suppkey") % 4).cast("string")).alias("carrier"),
        _year_stamp(F.col("l_shipdate")).alias("_ingestion_timestamp"),
        _run_of_year(F.col("l_shipdate")).alias("_run_id"),
    )


def raw_inventory(spark, sf_dir) -> DataFrame:
    """Daily stock per warehouse and product: an aggregate of shipped lines."""
    configure(spark)
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    day = F.col("l_shipdate").cast("date")
    agg = (li.join(sup, li.l_suppkey == sup.s_suppkey)
             .groupBy("s_nationkey", "l_partkey", day.alias("snapshot_date"))
             .agg(F.sum(F.col("l_quantity").cast("int")).alias("q")))
    return agg.select(
        F.concat(F.lit("W"), F.col("s_nationkey").cast("string")).alias("warehouse_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        "snapshot_date",
        (F.col("q") % 40).cast("int").alias("quantity_available"),
        F.lit(10).alias("reorder_threshold"),
        _year_stamp(F.col("snapshot_date")).alias("_ingestion_timestamp"),
        _run_of_year(F.col("snapshot_date")).alias("_run_id"),
    )


RAW = {
    "products": raw_products,
    "suppliers": raw_suppliers,
    "warehouses": raw_warehouses,
    "stores": raw_stores,
    "sales": raw_sales,
    "shipments": raw_shipments,
    "inventory": raw_inventory,
}
