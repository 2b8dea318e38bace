"""Incremental keyed merge (upsert) without a transactional table format.

``merge_incremental`` = target rows whose key is not in the batch, plus the
batch (deduplicated to its latest row per key).  It is what ``MERGE ... WHEN
MATCHED UPDATE ALL WHEN NOT MATCHED INSERT ALL`` produces, expressed as one
``left_anti`` join and a union, so it runs on plain Parquet.  The result is
written as a *new* version of the table (see ``store``); a Parquet path
is never overwritten while it is being read.

Rows whose key is NULL never match (SQL equality), so they are kept as
they are and are kept out of the join: they would all hash to one shuffle
partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.operators.dedupe import any_null, duplicate_keys, latest_of_stored, latest_per_key
from chainyard.operators.joins import checked_broadcast, keys_held
from chainyard.operators.key_index import parts_with
from chainyard.session import shuffles_dropped


class DuplicateKeyError(ValueError):
    pass


def high_watermark(target: DataFrame | None, col: str = "_ingestion_timestamp"):
    """Greatest ``col`` of the target, or None (no target / empty target)."""
    if target is None or col not in target.columns:
        return None
    return target.select(F.max(col)).first()[0]


def new_since(staged: DataFrame, target: DataFrame | None,
              col: str = "_ingestion_timestamp", empty_target: str = "all",
              mark: str | None = None) -> DataFrame:
    """Rows of ``staged`` ingested strictly after the target's watermark:
    ``mark``, if the caller knows it, else the greatest ``col`` of the target.

    The watermark is computed once and applied as a literal, so the filter
    reaches the Parquet scan.  A row stamped *equal* to the watermark is
    skipped (strict ``>``).  An existing but empty target has no
    watermark: ``empty_target="all"`` then takes every row, ``"none"``
    takes none (the plain SQL ``col > NULL`` behaviour).
    """
    if target is None:
        return staged
    mark = mark or high_watermark(target, col)
    if mark is None:
        return staged if empty_target == "all" else staged.filter(F.lit(False))
    return staged.filter(F.col(col) > F.lit(mark))


def align_to(df: DataFrame, schema, drop_extra: bool = True) -> DataFrame:
    """Give ``df`` the columns (names, order and types) of ``schema``:
    missing columns become typed NULLs, vanished ones are dropped."""
    have = set(df.columns)
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    if not drop_extra:
        cols += [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols)


def merge_incremental(target: DataFrame | None, batch: DataFrame, key,
                      order_by=("_ingestion_timestamp",), sync_columns: bool = True,
                      strict: bool = False, stored: bool = False) -> DataFrame:
    """Upsert ``batch`` into ``target`` on ``key`` (a column or a list).

    * ``order_by``: which batch row wins for a repeated key (greatest wins,
      the whole row breaks ties).
    * ``strict``: raise ``DuplicateKeyError`` instead of deduplicating.
    * ``sync_columns``: the result takes the batch's columns -- new ones are
      NULL on old rows, vanished ones are dropped (``sync_all_columns``);
      otherwise the batch is aligned to the target's columns.
    * ``stored``: both are read from storage, so that repeated and matching keys are
      looked up by their hashes first and only the rows of those are shuffled.
    """
    kept, latest, _ = _merge_parts(target, batch, key, order_by, sync_columns, strict, stored)
    return latest if kept is None else kept.unionByName(latest)


def _merge_parts(target, batch, key, order_by=("_ingestion_timestamp",), sync_columns=True,
                 strict=False, stored=False) -> tuple[DataFrame | None, DataFrame, bool]:
    """(target rows that stay, batch rows, whether the former are filtered where they lie)."""
    keys = [key] if isinstance(key, str) else list(key)
    order_by = [c for c in ([order_by] if isinstance(order_by, str) else order_by)
                if c in batch.columns]
    if strict:
        dup = duplicate_keys(batch, keys).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"batch repeats key {dup[0].asDict()}")
        latest = batch
    else:
        pick = latest_of_stored if stored else latest_per_key
        latest = pick(batch, keys, order_by) if order_by else batch
    if target is None:
        return None, latest, True
    if sync_columns:
        target = align_to(target, latest.schema)
    else:
        latest = align_to(latest, target.schema)
    # a small batch's keys are broadcast (checked count), so the target is
    # filtered in place without a shuffle; a large batch takes the
    # key-partitioned join
    old = target.filter(~any_null(keys))
    batch_keys, small = checked_broadcast(
        (batch if stored else latest).filter(~any_null(keys)).select(*keys))
    if stored and not small:
        found = keys_held(align_to(batch_keys, old.select(*keys).schema), old, keys)
        batch_keys, small = (batch_keys, False) if found is None else (found, True)
    kept = old.join(batch_keys, keys, "left_anti")
    null_keyed = target.filter(any_null(keys))
    return kept.unionByName(null_keyed), latest.select(*target.columns), small


def merge_into_partitions(store, name: str, batch: DataFrame, key, part_expr,
                          layer: str | None = None, index: bool = False, **merge_kw) -> int:
    """Upsert ``batch`` into a partition-laid-out table of ``store``,
    rewriting only the partitions the batch touches; returns the staged
    version (publish it with the run).

    The batch is set aside until the version is written, so it is computed once.  Touched are its
    own partitions and those that hold an older row of one of its keys: a key
    whose partition has changed leaves the old one.  The touched values are
    collected (bounded by the number of partitions, e.g. months), and the
    target is read pruned to them.

    To find older rows, the key columns of every partition are read, or, with
    ``index`` (``key_index``, written with each version), those of the partitions
    alone that the index names.  ``store.last_merge[name]`` tells what was read.
    """
    with shuffles_dropped(store.spark):
        return _merge_into(store, name, batch, key, part_expr, layer, index, merge_kw)


def _merge_into(store, name: str, batch: DataFrame, key, part_expr, layer: str | None,
                index: bool, merge_kw: dict) -> int:
    keys = [key] if isinstance(key, str) else list(key)
    batch = store.set_aside(name, batch)
    part = F.coalesce(part_expr.cast("string"), F.lit("none")).alias("part")
    touched = {r.part for r in batch.select(part).distinct().collect()}
    held = store.read(name, layer, keep_part=True)
    if held is not None:
        own = batch.filter(~any_null(keys)).select(*keys)
        # equal values have equal hashes only where their types agree
        alike = all(held.schema[k].dataType == own.schema[k].dataType for k in keys)
        known = store.key_index(name, layer) if index and alike else None
        named = None if known is None else parts_with(known, own, keys)
        if named is not None:
            named = sorted(set(named) - touched)
            held = store.read(name, layer, partitions=named, keep_part=True)
        moved = set()
        if named is None or named:
            old = held.select(*keys, F.substring("__part", 2, 100).alias("part"))
            asked, small = checked_broadcast(own)
            if alike and not small:
                found = keys_held(own, old.filter(~any_null(keys)), keys)
                asked = own if found is None else found
            moved = {r.part for r in old.join(asked, keys, "left_semi")
                     .select("part").distinct().collect()}
        store.last_merge[name] = {
            "indexed": named is not None, "named": named, "own": sorted(touched),
            "moved": sorted(moved - touched),
            "false_hits": None if named is None else len(set(named) - moved)}
        touched |= moved
    target = store.read(name, layer, partitions=sorted(touched))
    kept, latest, in_place = _merge_parts(target, batch, key, stored=True, **merge_kw)
    if kept is not None and not in_place:
        kept, latest = None, kept.unionByName(latest)
    v = store.stage(name, latest, layer, part_expr=part_expr, laid=kept,
                    partitions=None if target is None else sorted(touched),
                    index_keys=keys if index else None)
    store.release(name)
    return v
