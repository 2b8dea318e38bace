"""One ordered warehouse run over a batch of raw inputs.

    raw -> staging (lazy) -> snapshots -> dimensions -> facts -> tests -> publish

Every layer is *staged* as a new table version on shared storage, each
later layer reads the staged versions (so no plan recomputes an earlier
layer), the data tests run on the staged versions, and only when they all
pass are the versions published.  A failing test leaves every table at
its previous version -- nothing half-built is ever visible.

``run_ts`` (snapshot instant) and ``as_of`` (the run's "today") are
arguments, so a run can be repeated with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainyard.operators.merge import merge_incremental, merge_into_partitions, new_since
from chainyard.operators.quality import SUITE, gate, run_suite
from chainyard.plans import dims, facts
from chainyard.plans.staging import STAGING
from chainyard.session import shuffles_dropped
from chainyard.sources.landing import latest_refresh
from chainyard.store import TableStore

SNAPSHOT_ENTITIES = ("products", "suppliers", "stores", "warehouses")
FACT_DATES = {"sales": "transaction_date", "shipments": "shipment_date",
              "inventory": "snapshot_date"}
FACT_SOURCES = {"fct_sales": "sales", "fct_shipments": "shipments",
                "fct_inventory": "inventory"}


def run_batch(spark: SparkSession, store: TableStore, raw: dict[str, DataFrame],
              run_ts: str, as_of: str, calendar: dict | None = None,
              full_refresh: bool = False, tests=SUITE, skew_buckets: int | None = None,
              initial_valid_from: str | None = None,
              partition_facts: bool = True) -> dict[str, int]:
    """Build, test and publish every model from ``raw`` (entity -> raw
    DataFrame).  Returns the published version of each table; raises
    ``QualityGateError`` (publishing nothing) when a data test fails.

    Facts are laid out by event month and a run rewrites only the months its
    batch touches; ``partition_facts=False`` rewrites whole fact tables."""
    raw = {e: latest_refresh(df) if e in SNAPSHOT_ENTITIES else df for e, df in raw.items()}
    staged = {e: STAGING[e](df) for e, df in raw.items()}
    versions: dict[str, tuple[str, int]] = {}
    built: dict[str, DataFrame] = {}

    def keep(name: str, layer: str, df: DataFrame) -> DataFrame:
        v = store.stage(name, df, layer)
        versions[name] = (layer, v)
        built[name] = store.read(name, layer, version=v)
        return built[name]

    snaps = {}
    for e in SNAPSHOT_ENTITIES:
        current = None if full_refresh else store.read(f"snap_{e}", "SNAPSHOTS")
        snaps[e] = keep(f"snap_{e}", "SNAPSHOTS",
                        dims.snapshot(e, current, staged[e], run_ts,
                                      initial_valid_from=initial_valid_from))

    cal = dict(calendar or {"as_of": as_of, **dims.calendar_bounds(
        {e: staged[e].select(c) for e, c in FACT_DATES.items()})})
    cal.setdefault("as_of", as_of)
    dim_date = keep("dim_date", "MARTS", dims.date_spine(spark, **cal))
    dim_product = keep("dim_product", "MARTS",
                       dims.dim_product(snaps["products"], snaps["suppliers"]))
    keep("dim_supplier", "MARTS", dims.dim_supplier(snaps["suppliers"]))
    keep("dim_store", "MARTS", dims.dim_store(snaps["stores"]))
    dim_warehouse = keep("dim_warehouse", "MARTS", dims.dim_warehouse(snaps["warehouses"]))

    builders = {
        "fct_sales": lambda s: facts.fct_sales(s, dim_date, dim_product,
                                               skew_buckets=skew_buckets),
        "fct_shipments": lambda s: facts.fct_shipments(s, dim_date, dim_product, dim_warehouse,
                                                       as_of, skew_buckets=skew_buckets),
        "fct_inventory": lambda s: facts.fct_inventory(s, dim_date),
    }
    for name, entity in FACT_SOURCES.items():
        target = None if full_refresh else store.read(name, "MARTS")
        mark = None if target is None else store.watermark(name, "MARTS")
        batch = builders[name](new_since(staged[entity], target, mark=mark))
        if partition_facts:
            v = merge_into_partitions(store, name, batch, facts.FACT_KEYS[name],
                                      facts.FACT_MONTH[name](), "MARTS")
            versions[name] = ("MARTS", v)
            built[name] = store.read(name, "MARTS", version=v)
        else:
            keep(name, "MARTS", merge_incremental(target, batch, facts.FACT_KEYS[name]))

    tables = {**{f"raw_{e}": df for e, df in raw.items()},
              **{f"stg_{e}": df for e, df in staged.items()}, **built}
    known = [t for t in tests if t.model in tables and (t.to is None or t.to in tables)]
    with shuffles_dropped(spark):
        gate(run_suite(spark, tables, known))

    store.publish({(name, layer): v for name, (layer, v) in versions.items()})
    return {name: v for name, (_, v) in versions.items()}
