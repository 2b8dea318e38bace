"""Latest row per key, computed as a partial aggregate.

``max(struct(order..., row))`` is an ordinary aggregate: every map task
first keeps only its own latest row per key, so a key holding a third of
all rows is reduced before the shuffle instead of being sorted in a single
task (which ``row_number() over (partition by key ...)`` would do).  Ties
on the ordering columns fall to the whole row, so the pick is
deterministic regardless of partitioning.  Spark plans the aggregate over
structs as a sort aggregate, so rows are sorted by key on both sides of the
shuffle; for keys that are nearly unique that sort is its cost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.operators.joins import BROADCAST_MAX_ROWS, repeated_hashes


def any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def latest_per_key(df: DataFrame, keys, order_by=("_ingestion_timestamp",),
                   null_keys: bool = True) -> DataFrame:
    """One row per non-null key: the greatest by ``order_by`` (then by row).

    Rows with a NULL in any key column never match anything (SQL equality),
    so they are passed through as they are rather than collapsed together;
    ``null_keys=False`` promises that there are none, which saves their scan.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                      F.struct(*payload).alias("__row"))
    latest = (df.filter(~any_null(keys))
                .groupBy(*keys)
                .agg(F.max(packed).alias("__m"))
                .select(*keys, *[F.col(f"__m.__row.{c}").alias(c) for c in payload]))
    if not null_keys:
        return latest.select(*df.columns)
    passthrough = df.filter(any_null(keys))
    return latest.select(*df.columns).unionByName(passthrough)


def latest_of_stored(df: DataFrame, keys, order_by=("_ingestion_timestamp",)) -> DataFrame:
    """As ``latest_per_key``, for rows read from storage whose keys seldom repeat: a
    look-up by hash finds the repeated ones, and only their rows are aggregated."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    repeated = repeated_hashes(df.filter(~any_null(keys)), keys)
    n = repeated.count()
    if n == 0:
        return df
    if n > BROADCAST_MAX_ROWS:
        return latest_per_key(df, keys, order_by)
    mine = F.xxhash64(*keys) == repeated["__h"]
    once = df.join(F.broadcast(repeated), mine, "left_anti")
    return once.unionByName(latest_per_key(df.join(F.broadcast(repeated), mine, "left_semi"),
                                           keys, order_by))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once (NULL keys ignored), with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.filter(~any_null(keys)).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
