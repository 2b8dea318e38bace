"""The warehouse built from the fixture inputs, one lazy DataFrame per model.

Used by the registered queries, the benchmark and the tests.  Snapshot
states are folded run by run in one plan; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainyard.plans import dims, facts, staging
from chainyard.testing import fixtures as fx


def _memo(fn):
    """Cache a model per Warehouse and arguments: a model used by several
    others (dim_product by both facts) is planned once."""
    def wrapper(self, *args, **kw):
        key = (fn.__name__, args, tuple(sorted(kw.items())))
        if key not in self._memo:
            self._memo[key] = fn(self, *args, **kw)
        return self._memo[key]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict = {}
        self.raw: dict[str, DataFrame] = {}  # sources that have been stored

    def source(self, entity: str) -> DataFrame:
        return self.raw[entity] if entity in self.raw else fx.RAW[entity](self.spark, self.sf_dir)

    def model(self, name: str) -> DataFrame:
        """Any model by name: raw_*, stg_*, snap_*, dim_*, fct_*."""
        if name.startswith("raw_"):
            return self.source(name[4:])
        if name.startswith("stg_"):
            return self.stg(name[4:])
        if name in ("snap_suppliers", "snap_stores", "snap_warehouses"):
            return self.snap_static(name[5:])
        return getattr(self, name)()

    def tables(self) -> dict:
        """Lazy name -> model mapping for the quality suite."""
        return _Models(self)

    # staging -----------------------------------------------------------
    @_memo
    def stg(self, entity: str) -> DataFrame:
        return staging.STAGING[entity](self.source(entity))

    # snapshots ---------------------------------------------------------
    @_memo
    def snap_products(self, runs=fx.PRODUCT_RUNS) -> DataFrame:
        batches = [staging.stg_products(fx.product_batch(self.spark, self.sf_dir, i + 1, runs))
                   for i in range(len(runs))]
        return dims.snapshot_runs("products", batches, runs)

    @_memo
    def snap_static(self, entity: str, run_ts: str = fx.DIM_RUN) -> DataFrame:
        staged = staging.STAGING[entity](fx.RAW[entity](self.spark, self.sf_dir, fx.iso(run_ts)))
        return dims.snapshot(entity, None, staged, run_ts)

    def snap_two_runs(self, entity: str) -> DataFrame:
        """History of a dimension after a second run that changes some rows."""
        by, value, column = fx.SECOND_RUN[entity]
        first = self.stg(entity)
        change = F.when(F.col(by) == value, F.concat(column, F.lit("-N"))).otherwise(F.col(column))
        second = first.withColumn(column, change).withColumn(
            "_ingestion_timestamp", F.lit(fx.iso(fx.PRODUCT_RUNS[1])))
        return dims.snapshot_runs(entity, [first, second], fx.PRODUCT_RUNS)

    # dimensions --------------------------------------------------------
    def dim_date(self) -> DataFrame:
        """The calendar from the first to two years after the last fact date."""
        bounds = dims.calendar_bounds({e: self.stg(e).select(c) for e, c in fx.FACT_DATES.items()})
        return dims.date_spine(self.spark, **bounds)

    @_memo
    def calendar(self) -> DataFrame:
        """The calendar of the fact models: fixed, so that building one fact
        does not read the others."""
        return dims.date_spine(self.spark, **fx.CALENDAR)

    @_memo
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.snap_products(), self.snap_static("suppliers"))

    @_memo
    def dim_supplier(self) -> DataFrame:
        return dims.dim_supplier(self.snap_static("suppliers"))

    @_memo
    def dim_store(self) -> DataFrame:
        return dims.dim_store(self.snap_static("stores"))

    @_memo
    def dim_warehouse(self) -> DataFrame:
        return dims.dim_warehouse(self.snap_static("warehouses"))

    # facts -------------------------------------------------------------
    def fct_sales(self, sales: DataFrame | None = None, **kw) -> DataFrame:
        sales = self.stg("sales") if sales is None else sales
        return facts.fct_sales(sales, self.calendar(), self.dim_product(), **kw)

    def fct_shipments(self, shipments: DataFrame | None = None, **kw) -> DataFrame:
        shipments = self.stg("shipments") if shipments is None else shipments
        return facts.fct_shipments(shipments, self.calendar(), self.dim_product(),
                                   self.dim_warehouse(), fx.AS_OF, **kw)

    def fct_inventory(self, inventory: DataFrame | None = None) -> DataFrame:
        inventory = self.stg("inventory") if inventory is None else inventory
        return facts.fct_inventory(inventory, self.calendar())


# Ingestion batch that ends the first incremental run of the scenario.
FIRST_RUN_UNTIL = "1998-01-01T02:00:00+00:00"


def first_run(staged: DataFrame) -> DataFrame:
    """Staged rows that had arrived by the first incremental run."""
    return staged.filter(F.col("_ingestion_timestamp") <= F.lit(FIRST_RUN_UNTIL))


class _Models(dict):
    def __init__(self, w: Warehouse):
        super().__init__()
        self.w = w

    def __missing__(self, name):
        df = self.w.model(name)
        self[name] = df
        return df
