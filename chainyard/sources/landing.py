"""Landing writes and the RAW load (K1-K5, S6, S8).

* ``land``: Parquet (snappy), append or overwrite (a refreshed sheet
  export replaces the previous one).
* ``load_raw``: every landed file not loaded before becomes part of the RAW
  table, each file once: new files = listing ``left_anti`` the log of loads,
  and a load counts from its one log entry on.  Schemas of the files are
  merged by name (new columns appear as NULL on older rows), columns that
  differ in type by ``reconcile``; an unreadable file, or one whose types do not
  go with the table's, is logged and leaves the others loaded
  (``damaged_files`` finds them by two scans for each schema, however many
  files there are).
* ``latest_refresh``: of a static source only the newest full refresh counts.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.sources.files import Batch, empty_files, list_files, read_batch
from chainyard.sources.reconcile import Group, agreed, read_groups, schema_groups


def land(df: DataFrame, dest: str, mode: str = "append",
         partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(dest)
    return dest


def read_sheet_export(spark: SparkSession, folder: str, tab: str, schema=None) -> DataFrame:
    """Rows of one exported sheet tab -- ``<folder>/<tab>.csv|.json`` or a
    folder ``<folder>/<tab>/`` of part files; raise when the tab is missing
    or empty."""
    batch: Batch = read_batch(spark, folder, schema)

    def is_tab(path: str) -> bool:
        parts = path.rstrip("/").split("/")
        return parts[-1].rsplit(".", 1)[0] == tab or (len(parts) > 1 and parts[-2] == tab)

    mine = [f for f in batch.files if is_tab(f)]
    if not mine or batch.data is None:
        raise FileNotFoundError(f"Tab '{tab}' not found in {folder}.")
    keys = mine + ["file:" + f for f in mine if "://" not in f and not f.startswith("file:")]
    df = batch.data.filter(F.col("_source_key").isin(keys))
    if df.isEmpty():
        raise ValueError(f"Tab '{tab}' is empty.")
    return df.drop("_source_key")


LOAD_LOG = "load string, path string, loaded_at string, error string, schema string"


def load_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The log of loads: a row for each landed file, with the error of those
    that could not be read; one row of a load carries the schema it was written with."""
    from chainyard.session import path_exists
    if not path_exists(spark, log_path):  # first load: nothing loaded yet
        return spark.createDataFrame([], LOAD_LOG)
    return spark.read.schema(LOAD_LOG).json(log_path)


def damaged_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, error of those of the Parquet files that cannot be read whole.

    A file is sound if a read of all of its columns yields as many rows as its
    footer counts.  Both reads skip what is damaged: one of no column takes the
    rows from the footers, one of all columns decodes every page and ends within
    a file where it is broken, so a file that still yields some rows is found.
    Files without a row in either are empty or have no readable footer; only
    their footers are looked at one by one, on the executors.

    A schema in which the files cannot be merged raises.
    """
    from pyspark.errors import AnalysisException
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    try:
        rows = (spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "true")
                .parquet(*paths))
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return _without_rows(listed)  # no footer can be read
    # the scan's paths are written as URIs, in which a plus sign stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counted = rows.select(path.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))
    # a hash of all columns, so that none is pruned
    whole = rows.select(path.alias("path"), F.xxhash64(*rows.columns).alias("h")).groupBy("path").agg(
        F.count("h").alias("n_read"), F.bit_xor("h").alias("h")).select(
        "path", F.when(F.col("h").isNotNull(), F.col("n_read")).alias("n_read"))
    found = listed.join(counted, "path", "left").join(whole, "path", "left")
    broken = [(r.path, r.n_rows, r.n_read or 0) for r in
              found.filter(~F.col("n_rows").eqNullSafe(F.col("n_read")) | F.col("n_rows").isNull()).collect()]
    partly = spark.createDataFrame([(p, f"{k} of {n} rows can be read") for p, n, k in broken if n],
                                   "path string, error string")
    none = [(p,) for p, n, _ in broken if not n]
    if not none:
        return partly
    return partly.unionByName(_without_rows(spark.createDataFrame(none, "path string")))


def _without_rows(files: DataFrame) -> DataFrame:
    """Those of the files that are not an empty Parquet table, with the reason."""
    def judged(batches):
        import io
        import pyarrow.parquet as pq
        for batch in batches:
            errors = []
            for content in batch["content"]:
                try:
                    n = pq.read_metadata(io.BytesIO(content)).num_rows
                    errors.append(f"0 of {n} rows can be read" if n else None)
                except Exception as exc:  # noqa: BLE001 - logged, the others load
                    errors.append(f"no readable footer: {exc}"[:500])
            yield batch.assign(error=errors)[["path", "error"]]

    spark = files.sparkSession
    paths = [r.path for r in files.collect()]
    contents = spark.read.format("binaryFile").load(paths).select("path", "content")
    return contents.mapInPandas(judged, "path string, error string").filter("error IS NOT NULL")


def _loads(spark: SparkSession, log_path: str) -> list[tuple[str, T.StructType | None]]:
    """(load, schema) of each logged load, oldest first; no schema for a load of an
    earlier version of the log."""
    found = (load_log(spark, log_path).filter("error IS NULL").groupBy("load")
             .agg(F.min("loaded_at").alias("at"), F.max("schema").alias("schema")).collect())
    return [(r.load, T.StructType.fromJson(json.loads(r.schema)) if r.schema else None)
            for r in sorted(found, key=lambda r: (r["at"], r.load))]


def _load_groups(spark: SparkSession, raw: str, log_path: str) -> list[Group]:
    """The loads of the RAW table by schema: from the log, so no footer is read."""
    loads = _loads(spark, log_path)
    groups = [Group(schema, (f"{raw}/load={load}",)) for load, schema in loads if schema]
    unknown = [f"{raw}/load={load}" for load, schema in loads if not schema]
    return (schema_groups(spark, unknown) if unknown else []) + groups


def load_raw(spark: SparkSession, landing: str, raw: str, log_path: str) -> int:
    """Load landed Parquet files not loaded before into ``raw``; returns the
    number of files loaded.

    A load writes a folder of its own and then one log entry naming it, which
    is its only commit: a crash in between leaves a folder that no reader
    takes and the next load repeats.  Files that cannot be read, or whose types
    do not go with those of the table or of files before them, are logged with
    their error, and tried again by the next load; so are files of no byte, which
    Spark's listing leaves out.
    """
    listing = list_files(spark, landing, glob="*.parquet")
    done = load_log(spark, log_path).filter("error IS NULL").select("path")
    paths = [r.path for r in listing.join(done, "path", "left_anti").select("path").collect()
             if "/_quarantine/" not in r.path]
    hollow = {p: "file is empty" for p in empty_files(spark, landing)
              if p.endswith(".parquet") and "/_quarantine/" not in p}
    if not paths and not hollow:
        return 0
    load = uuid.uuid4().hex
    if not paths:
        _record(spark, log_path, load, list(hollow), hollow, None)
        return 0
    known = [g.schema for g in _load_groups(spark, raw, log_path)]

    def write(groups: list[Group], schema: T.StructType) -> None:
        (read_groups(spark, groups, schema)
         .write.mode("overwrite").option("compression", "snappy").parquet(f"{raw}/load={load}"))

    # unreadable files lend no schema to their group
    groups = schema_groups(spark, paths)
    _, held, errors = agreed(groups, known)
    schema, held, _ = agreed(held)  # a load has its own types: older ones are cast when read
    damaged: dict[str, str] = {}
    try:
        if not all(len(g.schema) for g in held):
            raise ValueError("files without a schema")
        if held:
            write(held, schema)
    except Exception:  # noqa: BLE001 - some file is damaged; find which
        damaged = {r.path: r.error for g in held
                   for r in damaged_files(spark, list(g.paths)).collect()}
        if not damaged:
            raise
        good = [Group(g.schema, tuple(p for p in g.paths if p not in damaged)) for g in held]
        good = [g for g in good if g.paths]
        if good:
            write(good, schema)
    errors |= damaged
    loaded = [p for p in paths if p not in errors]
    _record(spark, log_path, load, paths + list(hollow), errors | hollow, schema)
    return len(loaded)


def _record(spark: SparkSession, log_path: str, load: str, paths: list[str],
            errors: dict[str, str], schema: T.StructType | None) -> None:
    """The one log entry of a load; its first loaded file carries the schema."""
    stamp = dt.datetime.now(dt.timezone.utc).isoformat()
    first = next((p for p in paths if p not in errors), None)
    (spark.createDataFrame([(load, p, stamp, errors.get(p),
                             schema.json() if p == first else None) for p in paths], LOAD_LOG)
          .coalesce(1).write.mode("append").json(log_path))


def read_raw(spark: SparkSession, raw: str, log_path: str) -> DataFrame:
    """The RAW table: all logged loads, their columns merged by name and type."""
    groups = _load_groups(spark, raw, log_path)
    schema, held, refused = agreed(groups)
    if refused:  # only loads that were written beside each other at one time
        raise ValueError(f"loads do not go together: {sorted(refused.items())[:3]}")
    return read_groups(spark, held, schema)


def latest_refresh(df: DataFrame, stamp: str = "_ingestion_timestamp") -> DataFrame:
    """The rows of the newest full refresh of a static source: a source that is
    refreshed as a whole holds no row that its last refresh lacks."""
    if stamp not in df.columns:
        return df
    newest = df.agg(F.max(stamp)).first()[0]
    return df if newest is None else df.filter(F.col(stamp) == F.lit(newest))
