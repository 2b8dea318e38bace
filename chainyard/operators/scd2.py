"""SCD Type II snapshot with the ``check`` strategy and hard deletes.

One run compares the open versions of the current snapshot with the new
source extract in a single full outer join on the key:

V1  new key                    -> insert, valid_from = run_ts, valid_to NULL
V2  a check column differs     -> close the open row at run_ts, insert new
    (null-safe comparison)
V3  key gone from the source   -> close the open row at run_ts (hard deletes)
V4  no check column differs    -> keep the old row unchanged, even when an
                                  unchecked column changed
V5  key back after a delete    -> insert (no open row exists: same as V1)
V6  surrogate_key = md5(key '|' updated_at)
V7  columns exposed as surrogate_key, valid_from, valid_to, is_current,
    updated_at

Each joined row emits up to two versions through one ``explode``, so the
join runs once.  Closed history rows are passed through without a shuffle.
Keys are unique on both sides of the join (the source is reduced to its
latest row per key first), so there is no skew in it.

``scd2_history`` gives the state after any number of runs in one pass, for
backfills and missed runs: all extracts are one stream of (key, run), and the
versions of a key are its islands -- runs without a gap and without a change of
a check column.  One shuffle by key serves every step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.functions.columns import any_changed, version_id
from chainyard.operators.dedupe import latest_per_key

SCD_COLS = ("surrogate_key", "valid_from", "valid_to", "is_current", "updated_at")


def _ts(value: str) -> F.Column:
    return F.lit(value).cast("timestamp_ntz")


def initial_snapshot(source: DataFrame, key: str, run_ts: str,
                     initial_valid_from: str | None = None) -> DataFrame:
    """First run: every source row opens a version."""
    return source.select(
        *source.columns,
        version_id(F.col(key), _ts(run_ts)).alias("surrogate_key"),
        _ts(initial_valid_from or run_ts).alias("valid_from"),
        F.lit(None).cast(T.TimestampNTZType()).alias("valid_to"),
        F.lit(True).alias("is_current"),
        _ts(run_ts).alias("updated_at"),
    )


def scd2_snapshot(current: DataFrame | None, source: DataFrame, key: str, check_cols,
                  run_ts: str, hard_deletes: bool = True,
                  initial_valid_from: str | None = None,
                  dedupe_order=("_ingestion_timestamp",)) -> DataFrame:
    """Next snapshot state from ``current`` (None on the first run) and
    ``source``.  ``run_ts`` is 'yyyy-MM-dd HH:mm:ss' (UTC, no zone)."""
    source = source.filter(F.col(key).isNotNull())
    if dedupe_order:
        order = [c for c in dedupe_order if c in source.columns]
        source = latest_per_key(source, [key], order, null_keys=False) if order else source
    if current is None:
        return initial_snapshot(source, key, run_ts, initial_valid_from)

    src_schema = source.schema
    data_cols = [f.name for f in src_schema.fields]
    types = {f.name: f.dataType for f in src_schema.fields}
    cur_cols = set(current.columns)
    history = current.filter(F.col("valid_to").isNotNull())
    open_rows = current.filter(F.col("valid_to").isNull())
    t, s = open_rows.alias("t"), source.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")

    t_exists = F.col(f"t.{key}").isNotNull()
    s_exists = F.col(f"s.{key}").isNotNull()
    changed = t_exists & s_exists & any_changed(check_cols, "t", "s")
    close = (changed | (~s_exists)) if hard_deletes else changed
    now = _ts(run_ts)

    def old_col(c):
        return F.col(f"t.{c}").cast(types[c]) if c in cur_cols else F.lit(None).cast(types[c])

    old_row = F.when(t_exists, F.struct(
        *[old_col(c).alias(c) for c in data_cols],
        F.col("t.surrogate_key").alias("surrogate_key"),
        F.col("t.valid_from").alias("valid_from"),
        F.when(close, now).otherwise(F.col("t.valid_to")).alias("valid_to"),
        F.col("t.updated_at").alias("updated_at"),
    ))
    new_row = F.when(s_exists & (~t_exists | changed), F.struct(
        *[F.col(f"s.{c}").alias(c) for c in data_cols],
        version_id(F.col(f"s.{key}"), now).alias("surrogate_key"),
        now.alias("valid_from"),
        F.lit(None).cast(T.TimestampNTZType()).alias("valid_to"),
        now.alias("updated_at"),
    ))
    versions = (joined
                .select(F.explode(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull()))
                        .alias("v"))
                .select("v.*"))
    out_cols = [*data_cols, "surrogate_key", "valid_from", "valid_to", "updated_at"]
    hist = history.select(*[_hist_col(c, cur_cols, types) for c in out_cols])
    return (versions.unionByName(hist)
                    .withColumn("is_current", F.col("valid_to").isNull())
                    .select(*data_cols, *SCD_COLS))


def _hist_col(c: str, have: set, types: dict) -> F.Column:
    if c not in types:
        return F.col(c)
    if c in have:
        return F.col(c).cast(types[c]).alias(c)
    return F.lit(None).cast(types[c]).alias(c)


def as_of(snapshot: DataFrame, instant: str) -> DataFrame:
    """Versions valid at ``instant`` (one per key)."""
    t = _ts(instant)
    return snapshot.filter((F.col("valid_from") <= t) &
                           (F.col("valid_to").isNull() | (t < F.col("valid_to"))))


def current_rows(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter(F.col("is_current"))


def scd2_history(extracts: list[tuple[DataFrame, str]], key: str, check_cols,
                 current: DataFrame | None = None, hard_deletes: bool = True,
                 initial_valid_from: str | None = None,
                 dedupe_order=("_ingestion_timestamp",)) -> DataFrame:
    """The state that successive ``scd2_snapshot`` runs would reach over
    ``extracts`` (source, run_ts) in order of time, from ``current`` or from nothing.

    The open versions of ``current`` take part as a run before the first, and
    keep their ids and instants; its closed ones are passed through."""
    if not extracts:
        raise ValueError("no extracts")
    runs = [ts for _, ts in extracts]
    if runs != sorted(set(runs)):
        raise ValueError("extracts must be in order of time, one for each instant")
    schema = extracts[-1][0].schema
    data_cols, types = schema.names, {f.name: f.dataType for f in schema.fields}
    kept = [c for c in SCD_COLS if c not in ("valid_to", "is_current")]
    at = F.array(*[_ts(r) for r in runs])

    def stream(df: DataFrame, run: int, version) -> DataFrame:
        row = F.struct(*[_hist_col(c, set(df.columns), types) for c in data_cols])
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).cast(types[key]).alias("__k"), F.lit(run).alias("__run"), row.alias("__row"),
            version.alias("__own"))

    no_version = F.lit(None).cast(
        "struct<surrogate_key string, valid_from timestamp_ntz, updated_at timestamp_ntz>")
    parts = [stream(df, run, no_version) for run, (df, _) in enumerate(extracts)]
    if current is not None:
        open_rows = current.filter(F.col("valid_to").isNull())
        parts.append(stream(open_rows, -1, F.struct(*kept)))
    rows = reduce(DataFrame.unionByName, parts).repartition("__k")

    # the latest row of a key in each run; partitioned by key already
    order = F.struct(*[F.col(f"__row.{c}").alias(c) for c in dedupe_order if c in data_cols],
                     F.col("__row").alias("__all"))
    latest = rows.groupBy("__k", "__run").agg(F.max_by(F.struct("__row", "__own"), order).alias("v"))
    latest = latest.select("__k", "__run", "v.*")

    by_run = W.partitionBy("__k").orderBy("__run")
    check = F.struct(*[F.col(f"__row.{c}").alias(c) for c in check_cols])
    changed = ~F.lag("__check").over(by_run).eqNullSafe(F.col("__check"))
    last_run = F.lag("__run").over(by_run)
    starts = last_run.isNull() | changed
    if hard_deletes:
        starts = starts | (last_run < F.col("__run") - 1)
    islands = (latest.withColumn("__check", check)
               .withColumn("__starts", starts.cast("int"))
               .withColumn("__island", F.sum("__starts").over(by_run)))
    versions = islands.groupBy("__k", "__island").agg(
        F.min("__run").alias("__first"), F.max("__run").alias("__last"),
        F.min_by(F.struct("__row", "__own"), "__run").alias("v"))
    # a version ends with the run after its last one, or (without deletes) with the next version
    ended = (F.col("__last") + 1 if hard_deletes else
             F.lead("__first").over(W.partitionBy("__k").orderBy("__island")))
    opened = F.get(at, F.col("__first"))
    begin = opened
    if current is None and initial_valid_from:
        begin = F.when(F.col("__first") == 0, _ts(initial_valid_from)).otherwise(opened)
    out = versions.withColumn("__ended", ended).select(
        *[F.col(f"v.__row.{c}").alias(c) for c in data_cols],
        F.coalesce("v.__own.surrogate_key", version_id(F.col("__k"), opened)).alias("surrogate_key"),
        F.coalesce("v.__own.valid_from", begin).alias("valid_from"),
        F.get(at, F.col("__ended")).alias("valid_to"),
        F.coalesce("v.__own.updated_at", opened).alias("updated_at"))
    if current is not None:
        history = current.filter(F.col("valid_to").isNotNull())
        out_cols = [*data_cols, "surrogate_key", "valid_from", "valid_to", "updated_at"]
        out = out.unionByName(history.select(*[_hist_col(c, set(current.columns), types)
                                               for c in out_cols]))
    return out.withColumn("is_current", F.col("valid_to").isNull()).select(*data_cols, *SCD_COLS)
