"""Staging models: rename, type and clean each raw source (M1-M7).

Each model is a pure ``DataFrame -> DataFrame`` projection: explicit casts
of the raw columns, lineage passed through, rows with a null natural key
dropped.  With ANSI casts a malformed integer or date fails the run, the
same as a warehouse CAST; nothing is silently nulled.  Catalyst pushes the
key filter and the column pruning into the scan underneath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.functions.columns import delivery_status, stock_level


def _cast(name: str, to: str) -> F.Column:
    return F.col(name).cast(to).alias(name)


def stg_sales(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("transaction_id").isNotNull()).select(
        _cast("transaction_id", "string"),
        _cast("store_id", "string"),
        _cast("product_id", "string"),
        _cast("quantity_sold", "int"),
        _cast("unit_price", "decimal(10,2)"),
        _cast("discount_pct", "decimal(5,4)"),
        _cast("sale_amount", "decimal(10,2)"),
        _cast("transaction_timestamp", "timestamp_ntz"),
        F.col("transaction_timestamp").cast("timestamp_ntz").cast("date").alias("transaction_date"),
        "_ingestion_timestamp",
        "_run_id",
        "_source_table",
    )


def stg_shipments(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("shipment_id").isNotNull()).select(
        _cast("shipment_id", "string"),
        _cast("warehouse_id", "string"),
        _cast("store_id", "string"),
        _cast("product_id", "string"),
        _cast("quantity_shipped", "int"),
        _cast("shipment_date", "date"),
        _cast("expected_delivery_date", "date"),
        _cast("actual_delivery_date", "date"),
        _cast("carrier", "string"),
        # on the raw values, as the source model does
        delivery_status("actual_delivery_date", "expected_delivery_date").alias("delivery_status"),
        "_ingestion_timestamp",
        "_run_id",
    )


def stg_inventory(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("warehouse_id").isNotNull() & F.col("product_id").isNotNull()).select(
        _cast("warehouse_id", "string"),
        _cast("product_id", "string"),
        _cast("quantity_available", "int"),
        _cast("reorder_threshold", "int"),
        _cast("snapshot_date", "date"),
        stock_level("quantity_available", "reorder_threshold").alias("stock_level"),
        "_ingestion_timestamp",
        "_run_id",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("product_id").isNotNull()).select(
        _cast("product_id", "string"),
        _cast("product_name", "string"),
        _cast("category", "string"),
        _cast("brand", "string"),
        _cast("supplier_id", "string"),
        _cast("unit_price", "decimal(10,2)"),
        "_ingestion_timestamp",
    )


def stg_suppliers(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("supplier_id").isNotNull()).select(
        _cast("supplier_id", "string"),
        _cast("supplier_name", "string"),
        _cast("category", "string"),
        _cast("country", "string"),
        "_ingestion_timestamp",
    )


def stg_warehouses(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("warehouse_id").isNotNull()).select(
        _cast("warehouse_id", "string"),
        _cast("city", "string"),
        _cast("state", "string"),
        "_ingestion_timestamp",
    )


def stg_stores(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("store_id").isNotNull()).select(
        _cast("store_id", "string"),
        _cast("store_name", "string"),
        _cast("city", "string"),
        _cast("state", "string"),
        _cast("region", "string"),
        _cast("store_open_date", "date"),
        "_ingestion_timestamp",
    )


STAGING = {
    "sales": stg_sales,
    "shipments": stg_shipments,
    "inventory": stg_inventory,
    "products": stg_products,
    "suppliers": stg_suppliers,
    "warehouses": stg_warehouses,
    "stores": stg_stores,
}
