"""Declared schemas of the raw sources and the lineage-column set.

Sources are read with these schemas instead of inference: an inferred
schema drifts between files (an int column with one blank becomes a
double), and a declared schema lets an empty folder read as zero rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Lineage columns added at ingestion.  They are ignored when a
# landed copy is compared with its source (read-back validation).
METADATA_COLS = (
    "_ingestion_timestamp",
    "_run_id",
    "_source_bucket",
    "_source_key",
    "_source",
    "_source_table",
    "_source_schema",
    "_spreadsheet_id",
    "_sheet_tab",
    "_ingested_by",
)

# The names given to the lineage columns by each ingestor.
INGESTED_BY = {
    "files": "s3_ingest_script",
    "sales": "supabase_ingest_script",
    "sheet": "gsheets_ingest_script",
}
SOURCE_LABEL = {"sales": "supabase_postgres", "sheet": "google_sheets"}

S, I, D = T.StringType(), T.IntegerType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw (landing) shapes, before staging casts.  Text-typed where the source is
# text (CSV / sheet export); staging does the typing.
RAW = {
    "products": _struct(("product_id", S), ("product_name", S), ("category", S),
                        ("brand", S), ("supplier_id", S), ("unit_price", T.DecimalType(10, 2))),
    "suppliers": _struct(("supplier_id", S), ("supplier_name", S), ("category", S),
                         ("country", S)),
    "warehouses": _struct(("warehouse_id", S), ("city", S), ("state", S)),
    "stores": _struct(("store_id", S), ("store_name", S), ("city", S), ("state", S),
                      ("region", S), ("store_open_date", D)),
    "sales": _struct(("transaction_id", S), ("store_id", S), ("product_id", S),
                     ("quantity_sold", I), ("unit_price", T.DecimalType(10, 2)),
                     ("discount_pct", T.DecimalType(5, 4)),
                     ("sale_amount", T.DecimalType(10, 2)),
                     ("transaction_timestamp", T.TimestampNTZType())),
    "shipments": _struct(("shipment_id", S), ("warehouse_id", S), ("store_id", S),
                         ("product_id", S), ("quantity_shipped", I), ("shipment_date", D),
                         ("expected_delivery_date", D), ("actual_delivery_date", D),
                         ("carrier", S)),
    "inventory": _struct(("warehouse_id", S), ("product_id", S), ("snapshot_date", D),
                         ("quantity_available", I), ("reorder_threshold", I)),
}

# Natural keys of each entity (staging drops rows with a null key).
NATURAL_KEY = {
    "products": ("product_id",),
    "suppliers": ("supplier_id",),
    "warehouses": ("warehouse_id",),
    "stores": ("store_id",),
    "sales": ("transaction_id",),
    "shipments": ("shipment_id",),
    "inventory": ("warehouse_id", "product_id"),
}

# Columns an SCD2 snapshot compares to detect a new version (check strategy).
CHECK_COLS = {
    "products": ("product_name", "category", "brand", "supplier_id", "unit_price"),
    "suppliers": ("supplier_name", "category", "country"),
    "stores": ("store_name", "city", "state", "region"),
    "warehouses": ("city", "state"),
}

LINEAGE = {
    "_ingestion_timestamp": S,
    "_run_id": S,
    "_source_table": S,
}


def with_lineage(schema: T.StructType, *names: str) -> T.StructType:
    """``schema`` plus the named lineage columns (all strings)."""
    out = T.StructType(list(schema.fields))
    for n in names:
        out = out.add(n, LINEAGE.get(n, S), True)
    return out
