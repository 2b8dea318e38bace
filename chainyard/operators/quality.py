"""Declarative data-quality tests (not_null, unique, relationships,
positive / not-negative values, accepted values) and the run gate.

A test "fails" with the number of rows its check query would return, as
a schema test does: failing rows for row-level checks, duplicated values
for ``unique``, orphan child rows for ``relationships``.

Execution: every row-level test of a table is fused into one aggregate
pass (``count_if`` per test); all ``unique`` tests share ONE partial
aggregate over the hashes of (test, value) pairs (a hot value is pre-counted
map-side), and only values of repeated hashes are counted themselves;
each ``relationships`` test is one ``left_anti`` join against the distinct
parent keys (broadcast when counted small).  Only the small result table reaches the driver, in ``gate``.
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.functions.columns import DELIVERY_STATUSES, STOCK_LEVELS
from chainyard.operators.joins import BROADCAST_MAX_ROWS, broadcast_if_small, repeated_hashes

ROW_TESTS = ("not_null", "positive_value", "not_negative", "accepted_values")

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("test", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
])


@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    kind: str
    to: str | None = None          # relationships: parent model
    field: str | None = None       # relationships: parent column
    values: tuple = dc_field(default=())  # accepted_values
    name: str | None = None        # reported test name (default: kind)

    @property
    def label(self) -> str:
        return self.name or self.kind


def failing(t: DataTest) -> F.Column:
    """Row-level failure predicate (NULL never fails except for not_null)."""
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "positive_value":
        return c <= 0
    if t.kind == "not_negative":
        return c < 0
    if t.kind == "accepted_values":
        return ~c.isin(*t.values)
    raise ValueError(t.kind)


def _row_tests(df: DataFrame, tests: list[DataTest]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.coalesce(failing(t), F.lit(False))).alias(f"f{i}")
                      for i, t in enumerate(tests)])
    rows = [F.struct(F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
                     F.lit(t.label).alias("test"), F.col(f"f{i}").cast("long").alias("failures"))
            for i, t in enumerate(tests)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _uniques(spark: SparkSession, frames: list[tuple[DataTest, DataFrame]]) -> DataFrame:
    """Duplicated-value counts of many ``unique`` tests.

    One shuffle of a hash of each value finds the hashes that occur twice or more;
    only the values of these are shuffled themselves and counted."""
    pairs = None
    for i, (t, df) in enumerate(frames):
        p = (df.select(F.lit(i).alias("__t"), F.col(t.column).cast("string").alias("__v"))
               .filter(F.col("__v").isNotNull()))
        pairs = p if pairs is None else pairs.unionByName(p)
    repeated = repeated_hashes(pairs, ["__t", "__v"])
    n = repeated.count()
    if n == 0:  # the frames are not read again
        pairs = spark.createDataFrame([], pairs.schema)
    elif n <= BROADCAST_MAX_ROWS:
        mine = F.xxhash64("__t", "__v") == repeated["__h"]
        pairs = pairs.join(F.broadcast(repeated), mine, "left_semi")
    dup = (pairs.groupBy("__t", "__v").agg(F.count(F.lit(1)).alias("__n"))
                .filter(F.col("__n") > 1).groupBy("__t")
                .agg(F.count(F.lit(1)).alias("__failures")))
    meta = spark.createDataFrame(
        [(i, t.model, t.column, t.label) for i, (t, _) in enumerate(frames)],
        "__t int, model string, column_name string, test string")
    return meta.join(F.broadcast(dup), "__t", "left").select(
        "model", "column_name", "test",
        F.coalesce(F.col("__failures"), F.lit(0)).cast("long").alias("failures"))


def _relationship(child: DataFrame, parent: DataFrame, t: DataTest) -> DataFrame:
    keys = parent.select(F.col(t.field).alias("__parent")).distinct()
    orphans = (child.select(F.col(t.column).alias("__child"))
                    .filter(F.col("__child").isNotNull())
                    .join(broadcast_if_small(keys), F.col("__child") == F.col("__parent"),
                          "left_anti"))
    return orphans.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(t.model).alias("model"), F.lit(t.column).alias("column_name"),
        F.lit(t.label).alias("test"), F.col("failures").cast("long"))


def run_suite(spark: SparkSession, tables, tests) -> DataFrame:
    """Results of ``tests`` over ``tables`` (name -> DataFrame or a
    zero-argument callable returning one), one row per test."""
    cache: dict[str, DataFrame] = {}

    def get(name):
        if name not in cache:
            t = tables[name]
            cache[name] = t() if callable(t) else t
        return cache[name]

    parts, uniques = [], []
    by_model: dict[str, list[DataTest]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)
    for model, ts in by_model.items():
        df = get(model)
        row = [t for t in ts if t.kind in ROW_TESTS]
        if row:
            parts.append(_row_tests(df, row))
        for t in ts:
            if t.kind == "unique":
                uniques.append((t, df))
            elif t.kind == "relationships":
                parts.append(_relationship(df, get(t.to), t))
    if uniques:
        parts.append(_uniques(spark, uniques))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> list:
    """Raise when any test failed; return the failing rows otherwise (none).

    Run it *before* publishing a layer, so bad data never becomes visible.
    """
    bad = results.filter(F.col("failures") > 0).collect()
    if bad:
        lines = ", ".join(f"{r.test}({r.model}.{r.column_name})={r.failures}" for r in bad)
        raise QualityGateError(f"{len(bad)} data test(s) failed: {lines}")
    return bad


def _nn(model, *cols):
    return [DataTest(model, c, "not_null") for c in cols]


def _u(model, *cols):
    return [DataTest(model, c, "unique") for c in cols]


def _scd(model, key):
    return (_nn(model, "surrogate_key") + _u(model, "surrogate_key")
            + _nn(model, key, "valid_from", "is_current"))


# The test inventory of the warehouse -- raw sources, staging
# and marts -- plus the four custom tests attached to the columns they were
# written for (stock levels: IN_STOCK is what staging emits).
SUITE = (
    # raw sources
    _nn("raw_inventory", "warehouse_id", "product_id", "snapshot_date")
    + _nn("raw_shipments", "shipment_id") + _u("raw_shipments", "shipment_id")
    + _nn("raw_products", "product_id") + _u("raw_products", "product_id")
    + _nn("raw_warehouses", "warehouse_id") + _u("raw_warehouses", "warehouse_id")
    + _nn("raw_suppliers", "supplier_id") + _u("raw_suppliers", "supplier_id")
    + _nn("raw_sales", "transaction_id") + _u("raw_sales", "transaction_id")
    + _nn("raw_sales", "store_id", "product_id")
    + _nn("raw_stores", "store_id") + _u("raw_stores", "store_id")
    # staging
    + _nn("stg_sales", "transaction_id") + _u("stg_sales", "transaction_id")
    + _nn("stg_sales", "store_id", "product_id", "quantity_sold", "sale_amount",
          "transaction_date")
    + _nn("stg_shipments", "shipment_id") + _u("stg_shipments", "shipment_id")
    + _nn("stg_shipments", "warehouse_id", "store_id", "product_id")
    + _nn("stg_inventory", "warehouse_id", "product_id", "snapshot_date")
    + _nn("stg_products", "product_id") + _u("stg_products", "product_id")
    + _nn("stg_warehouses", "warehouse_id") + _u("stg_warehouses", "warehouse_id")
    + _nn("stg_suppliers", "supplier_id") + _u("stg_suppliers", "supplier_id")
    + _nn("stg_stores", "store_id") + _u("stg_stores", "store_id")
    # marts
    + _nn("dim_date", "date_id") + _u("dim_date", "date_id")
    + _scd("dim_product", "product_id") + _scd("dim_store", "store_id")
    + _scd("dim_supplier", "supplier_id") + _scd("dim_warehouse", "warehouse_id")
    + _nn("fct_sales", "transaction_id") + _u("fct_sales", "transaction_id")
    + _nn("fct_sales", "store_id", "product_id", "date_id")
    + [DataTest("fct_sales", "date_id", "relationships", "dim_date", "date_id"),
       DataTest("fct_sales", "product_surrogate_key", "relationships", "dim_product",
            "surrogate_key")]
    + _nn("fct_shipments", "shipment_id") + _u("fct_shipments", "shipment_id")
    + [DataTest("fct_shipments", "product_surrogate_key", "relationships", "dim_product",
            "surrogate_key"),
       DataTest("fct_shipments", "warehouse_surrogate_key", "relationships", "dim_warehouse",
            "surrogate_key")]
    + _nn("fct_inventory", "inventory_key") + _u("fct_inventory", "inventory_key")
    # custom tests
    + [DataTest("stg_sales", "quantity_sold", "positive_value"),
       DataTest("stg_sales", "unit_price", "positive_value"),
       DataTest("stg_sales", "discount_pct", "not_negative"),
       DataTest("stg_shipments", "quantity_shipped", "not_negative"),
       DataTest("stg_inventory", "quantity_available", "not_negative"),
       DataTest("stg_inventory", "reorder_threshold", "not_negative"),
       DataTest("stg_shipments", "delivery_status", "accepted_values",
            values=DELIVERY_STATUSES, name="valid_delivery_status"),
       DataTest("fct_shipments", "delivery_status", "accepted_values",
            values=DELIVERY_STATUSES, name="valid_delivery_status"),
       DataTest("stg_inventory", "stock_level", "accepted_values",
            values=STOCK_LEVELS, name="valid_stock_level"),
       DataTest("fct_inventory", "stock_level", "accepted_values",
            values=STOCK_LEVELS, name="valid_stock_level")]
)


def select_tests(kind: str, suite=SUITE) -> list[DataTest]:
    return [t for t in suite if t.label == kind or t.kind == kind]
