"""Fact models (M17-M19): staged events joined to the calendar and to the
dimension version valid at the event (point-in-time), maintained either by
full rebuild or by incremental keyed merge (I9 + K8 + K9).

The calendar is broadcast: its size is fixed by the spine parameters, not
by the data.  Dimension versions grow with the data, so they are broadcast
only after a row count shows them within a bound (``pit_join``); larger
ones take a key-partitioned sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.functions.columns import day_diff, surrogate_key
from chainyard.operators.merge import merge_incremental, new_since
from chainyard.operators.temporal import pit_join


def _dates(dim_date: DataFrame) -> DataFrame:
    return F.broadcast(dim_date.select("date_id", "full_date"))


def fct_sales(sales: DataFrame, dim_date: DataFrame, dim_product: DataFrame, join=pit_join,
              **options) -> DataFrame:
    """``join``: ``pit_join`` or ``asof_join``, with its ``options``."""
    products = dim_product.select(
        F.col("surrogate_key").alias("product_surrogate_key"), "product_id", "supplier_id",
        "valid_from", "valid_to")
    dated = sales.join(_dates(dim_date), sales.transaction_date == F.col("full_date"), "left")
    j = join(dated, products, "product_id", "transaction_timestamp", **options)
    return j.select(
        "product_surrogate_key", "transaction_id", "store_id", "product_id", "supplier_id",
        "date_id", "quantity_sold", "unit_price", "discount_pct", "sale_amount",
        "transaction_timestamp", "_ingestion_timestamp", "_run_id", "_source_table")


def fct_shipments(shipments: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                  dim_warehouse: DataFrame, as_of: str, join=pit_join,
                  **options) -> DataFrame:
    """``as_of`` stands in for ``current_date()`` in the variance of a
    still-pending shipment, so a rebuild gives the same answer."""
    products = dim_product.select(
        F.col("surrogate_key").alias("product_surrogate_key"), "product_id", "supplier_id",
        "valid_from", "valid_to")
    warehouses = dim_warehouse.select(
        F.col("surrogate_key").alias("warehouse_surrogate_key"), "warehouse_id",
        "valid_from", "valid_to")
    dated = shipments.join(_dates(dim_date), shipments.shipment_date == F.col("full_date"), "left")
    j = join(dated, products, "product_id", "shipment_date", as_date=True, **options)
    j = join(j, warehouses, "warehouse_id", "shipment_date", as_date=True, **options)
    variance = day_diff("expected_delivery_date",
                        F.coalesce(F.col("actual_delivery_date"), F.lit(as_of).cast("date")))
    return j.select(
        "product_surrogate_key", "warehouse_surrogate_key", "shipment_id", "warehouse_id",
        "store_id", "product_id", "supplier_id", "date_id", "quantity_shipped", "carrier",
        "shipment_date", "expected_delivery_date", "actual_delivery_date", "delivery_status",
        variance.alias("delivery_days_variance"), "_ingestion_timestamp", "_run_id")


def fct_inventory(inventory: DataFrame, dim_date: DataFrame) -> DataFrame:
    dated = inventory.join(_dates(dim_date), inventory.snapshot_date == F.col("full_date"), "left")
    return dated.select(
        surrogate_key("warehouse_id", "product_id", "snapshot_date").alias("inventory_key"),
        "warehouse_id", "product_id", "date_id", "quantity_available", "reorder_threshold",
        "snapshot_date", "stock_level", "_ingestion_timestamp", "_run_id")


# Merge keys of the incremental facts.
FACT_KEYS = {
    "fct_sales": "transaction_id",
    "fct_shipments": "shipment_id",
    "fct_inventory": "inventory_key",
}

# Event month of each fact: the layout of month-partitioned fact versions
# (a key's event date never changes, so its month never does).
FACT_MONTH = {
    "fct_sales": lambda: F.date_format("transaction_timestamp", "yyyyMM"),
    "fct_shipments": lambda: F.date_format("shipment_date", "yyyyMM"),
    "fct_inventory": lambda: F.date_format("snapshot_date", "yyyyMM"),
}


def incremental(name: str, target: DataFrame | None, staged: DataFrame, build,
                key: str | None = None, **merge_kw) -> DataFrame:
    """Process only staged rows ingested after the target's high watermark,
    build fact rows from them with ``build(staged_subset)`` and merge them
    into ``target`` by key.  ``target=None`` is the first (full) run."""
    batch = build(new_since(staged, target))
    return merge_incremental(target, batch, key or FACT_KEYS[name], **merge_kw)
