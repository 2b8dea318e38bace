"""Dimension models (M12-M16) and the snapshot runs that feed them (M8-M11)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainyard.functions.columns import date_id, day_of_week0
from chainyard.operators.joins import checked_broadcast, spread, unspread
from chainyard.operators.scd2 import scd2_history, scd2_snapshot
from chainyard.schemas import CHECK_COLS, NATURAL_KEY

# Calendar defaults (start date, horizon).
DEFAULT_START = "2023-01-01"
DEFAULT_HORIZON_DAYS = 730


def date_spine(spark: SparkSession, start: str = DEFAULT_START, as_of: str | None = None,
               horizon_days: int = DEFAULT_HORIZON_DAYS) -> DataFrame:
    """Calendar dimension, one row per day from ``start`` to
    ``as_of + horizon_days``.  ``as_of`` replaces ``current_date()`` so a rebuild is repeatable; its
    size is bounded by the parameters, never by the data, so joining it by
    broadcast is always safe.
    """
    as_of = as_of or dt.date.today().isoformat()
    first = dt.date.fromisoformat(start)
    last = dt.date.fromisoformat(as_of) + dt.timedelta(days=horizon_days)
    n = max((last - first).days + 1, 0)
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    spine = spark.range(0, n, numPartitions=1).select(d.alias("calendar_date"))
    c = F.col("calendar_date")
    return spine.select(
        date_id(c).alias("date_id"),
        c.alias("full_date"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.weekofyear(c).alias("week_of_year"),
        day_of_week0(c).alias("day_of_week"),
        F.date_format(c, "EEE").alias("day_name"),
        F.dayofmonth(c).alias("day_of_month"),
        F.dayofyear(c).alias("day_of_year"),
        day_of_week0(c).isin(0, 6).alias("is_weekend"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
    )


def calendar_bounds(dates: dict[str, DataFrame]) -> dict[str, str]:
    """``start`` and ``as_of`` of the calendar that covers all facts: the first
    and the last of the date columns given by source."""
    ends = []
    for df in dates.values():
        for c in df.columns:
            d = df.select(F.col(c).cast("date").alias("d"))
            ends.append(d.agg(F.min("d").alias("a"), F.max("d").alias("b")))
    one = reduce(DataFrame.unionByName, ends).agg(F.min("a").alias("a"), F.max("b").alias("b")).first()
    if one.a is None:
        return {}
    return {"start": one.a.isoformat(), "as_of": one.b.isoformat()}


def snapshot(entity: str, current: DataFrame | None, staged: DataFrame, run_ts: str,
             hard_deletes: bool = True, initial_valid_from: str | None = None) -> DataFrame:
    """One SCD2 run of ``entity`` (products, suppliers, stores, warehouses)."""
    return scd2_snapshot(current, staged, NATURAL_KEY[entity][0], CHECK_COLS[entity],
                         run_ts, hard_deletes=hard_deletes,
                         initial_valid_from=initial_valid_from)


def snapshot_runs(entity: str, batches, run_instants, current: DataFrame | None = None,
                  **kw) -> DataFrame:
    """Fold successive runs: ``batches[i]`` is the staged source at
    ``run_instants[i]``.  Returns the final snapshot state (lazy)."""
    for staged, ts in zip(batches, run_instants):
        current = snapshot(entity, current, staged, ts, **kw)
    return current


def history(entity: str, batches, run_instants, current: DataFrame | None = None,
            **kw) -> DataFrame:
    """As ``snapshot_runs``, all runs in one pass with one shuffle."""
    return scd2_history(list(zip(batches, run_instants)), NATURAL_KEY[entity][0],
                        CHECK_COLS[entity], current, **kw)


def dim_product(snap_products: DataFrame, snap_suppliers: DataFrame) -> DataFrame:
    """All product versions, with the *current* supplier's attributes."""
    suppliers = (snap_suppliers.filter(F.col("is_current"))
                 .select("supplier_id", "supplier_name",
                         F.col("category").alias("supplier_category"),
                         F.col("country").alias("supplier_country")))
    suppliers, small = checked_broadcast(suppliers)
    named = suppliers.withColumnRenamed("supplier_id", "of_supplier")
    match = F.col("supplier_id") == F.col("of_supplier")
    if not small:
        snap_products = snap_products.withColumn("__spread", spread(["supplier_id"], "surrogate_key"))
        named = named.withColumn("__unspread", unspread("of_supplier"))
        match = match & (F.col("__spread") == F.col("__unspread"))
    return snap_products.join(named, match, "left").select(
        "surrogate_key", "valid_from", "valid_to", "is_current", "updated_at",
        "product_id", "product_name", "category", "brand", "unit_price", "supplier_id",
        "supplier_name", "supplier_category", "supplier_country")


def dim_supplier(snap: DataFrame) -> DataFrame:
    return snap.select("surrogate_key", "valid_from", "valid_to", "is_current", "updated_at",
                       "supplier_id", "supplier_name", "category", "country")


def dim_store(snap: DataFrame) -> DataFrame:
    return snap.select("surrogate_key", "valid_from", "valid_to", "is_current", "updated_at",
                       "store_id", "store_name", "city", "state", "region", "store_open_date")


def dim_warehouse(snap: DataFrame) -> DataFrame:
    return snap.select("surrogate_key", "valid_from", "valid_to", "is_current", "updated_at",
                       "warehouse_id", "city", "state")
