"""Broadcast only behind a size check.

``broadcast_if_small`` counts the rows of a join side (for a stored table
this is answered from Parquet footers) and hints a broadcast only when
the side is within ``max_rows``; beyond that the side is left to the
key-partitioned sort-merge join.  Deciding before planning matters: if the
choice is left to runtime re-planning, the large side has usually been
shuffled already by the time the small side turns out to be small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default bound: narrow version rows (~100 bytes) -> at most ~50 MB shipped
# to each executor.
BROADCAST_MAX_ROWS = 500_000


def checked_broadcast(df: DataFrame, max_rows: int | None = BROADCAST_MAX_ROWS
                      ) -> tuple[DataFrame, bool]:
    """(``broadcast(df)``, True) if ``df`` has at most ``max_rows`` rows,
    else (``df``, False).  See ``broadcast_if_small``."""
    if max_rows is None or max_rows <= 0:
        return df, False
    small = df.count() <= max_rows
    return (F.broadcast(df), True) if small else (df, False)


def broadcast_if_small(df: DataFrame, max_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    A plain count: one partial aggregate whose columns are pruned (a stored
    table answers from its footers), nothing is cached.
    """
    return checked_broadcast(df, max_rows)[0]


def repeated_hashes(rows: DataFrame, keys) -> DataFrame:
    """``__h``: the key hashes that rows have more than once, written down.

    ``rows`` is best read from storage: this pass, before that of the caller, shuffles
    a hash of each row in place of the row.  Equal keys have equal hashes; few others share one."""
    counts = rows.groupBy(F.xxhash64(*keys).alias("__h")).agg(F.count(F.lit(1)).alias("n"))
    return _noted(counts.filter("n > 1").select("__h"), "repeated")


def keys_held(own: DataFrame, held: DataFrame, keys,
              max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame | None:
    """The keys of ``own`` that ``held`` may hold (all that it does, and few others by
    their hash), to be broadcast; None if there are more than ``max_rows``.

    Both are read from storage, without NULL keys and with columns of the same
    types; the look-up shuffles a hash of each row in place of the row."""
    h = F.xxhash64(*keys).alias("__h")
    hits = _noted(own.select(h).distinct().join(held.select(h), "__h", "left_semi"), "held")
    if hits.count() > max_rows:
        return None
    mine = own.select(*keys).join(F.broadcast(hits), F.xxhash64(*keys) == hits["__h"], "left_semi")
    return F.broadcast(mine.distinct())


def distinct_hashes(rows: DataFrame, keys, max_rows: int) -> DataFrame | None:
    """``__h``: the hashes of the keys of ``rows``, written down; None if there are more
    than ``max_rows``."""
    hashes = _noted(rows.select(F.xxhash64(*keys).alias("__h")).distinct(), "hashes")
    return hashes if hashes.count() <= max_rows else None


def _noted(hashes: DataFrame, name: str) -> DataFrame:
    from chainyard.session import shared_dir, shuffles_dropped
    path = shared_dir(hashes.sparkSession, name)
    with shuffles_dropped(hashes.sparkSession):
        hashes.write.parquet(path)
    return hashes.sparkSession.read.schema("__h bigint").parquet(path)


def spread(keys, *others: str) -> Column:
    """0, or a number of the row's own where a key is NULL.

    Such a row matches nothing, so it may be joined anywhere: with this as a
    further join column (``unspread`` on the other side) the rows without a key
    do not meet in one task, and the keys are compared as they are."""
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(lacking, F.xxhash64(*others)).otherwise(F.lit(0).cast("bigint"))


def unspread(key: str) -> Column:
    """0, computed from a column so that it stays a join column."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("bigint")
