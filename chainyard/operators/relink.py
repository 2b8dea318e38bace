"""Re-linking facts after a late dimension change.

A fact is linked to the dimension version valid at its instant when it is
built.  If the history of the dimension changes afterwards (a snapshot run
closes versions back in time, a backfill inserts some), only facts whose key
and instant lie where the two histories differ are linked wrongly:

* ``interval_changes`` compares two histories and gives those intervals: of a
  version that only one of them has, its whole validity; of one whose end has
  moved, the time between both ends.
* ``relink_partitions`` looks up (columns of key and instant alone) which
  months hold such facts, reads those months, links their facts in question
  again and writes a version of the table with those months only.  Hashes of the
  changed keys are broadcast, if they are not too many, so that facts of other keys
  are not shuffled: they are written from where they lie.

The fact's key is compared as the point-in-time join compares it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.operators.joins import broadcast_if_small, distinct_hashes
from chainyard.operators.temporal import pit_join
from chainyard.session import shuffles_dropped

#: Hashes of changed keys up to which they are broadcast: one number each.
MAX_HASHES = 2_000_000


def interval_changes(old: DataFrame, new: DataFrame, key: str, payload, valid_from: str = "valid_from",
                     valid_to: str = "valid_to") -> DataFrame:
    """key, since and until (NULL: open) of the times at which the two histories
    give a key different ``payload``; intervals of one key may overlap."""
    payload = [payload] if isinstance(payload, str) else list(payload)

    def side(df: DataFrame, to: str) -> DataFrame:
        return df.filter(F.col(key).isNotNull()).select(
            F.col(key).alias("k"), F.col(valid_from).alias("since"),
            F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)]).alias("p"),
            F.col(valid_to).alias(to), F.lit(True).alias(f"has_{to}"))

    a, b = side(old, "a"), side(new, "b")
    same = reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in ("k", "since", "p")])
    both = a.join(b, same, "full_outer")
    in_both = F.col("has_a").isNotNull() & F.col("has_b").isNotNull()
    first, last = F.least("a", "b"), F.when(F.col("a").isNotNull() & F.col("b").isNotNull(),
                                            F.greatest("a", "b"))
    moved = in_both & ~F.col("a").eqNullSafe(F.col("b"))
    since = F.coalesce(a["since"], b["since"])
    return (both.filter(~in_both | moved)
            .select(F.coalesce(a["k"], b["k"]).alias(key),
                    F.when(moved, first).otherwise(since).alias("since"),
                    F.when(moved, last).otherwise(F.coalesce("a", "b")).alias("until"))
            .filter(F.col("until").isNull() | (F.col("since") < F.col("until"))))


def _within(fact: DataFrame, changes: DataFrame, key: str, ts: str, as_date: bool) -> DataFrame:
    """``fact`` rows whose key and instant lie in a change."""
    c = broadcast_if_small(changes.select(F.col(key).alias("__ck"), "since", "until"))
    t, since, until = F.col(ts), F.col("since"), F.col("until")
    inside = (t >= since) & (until.isNull() | (t < until))
    if as_date:
        # a day takes what opened last on it: both ends may matter to their own day
        t, since, until = (x.cast("date") for x in (t, since, until))
        inside = (t >= since) & (until.isNull() | (t <= until))
    return fact.join(c, (F.col(key) == F.col("__ck")) & inside, "left_semi")


def relink_partitions(store, name: str, changes: DataFrame, versions: DataFrame, key: str, ts: str,
                      row_key: str, part_expr, layer: str | None = None, as_date: bool = False,
                      join=pit_join, **options) -> int | None:
    """Link the facts of ``name`` that lie in ``changes`` to ``versions`` (key,
    valid_from, valid_to and columns of the fact) again; returns the staged
    version, which holds the months with such facts alone, or None if there are
    none.  ``row_key`` identifies a fact."""
    held = store.read(name, layer, keep_part=True)
    if held is None:
        return None
    changes = store.set_aside(f"{name}-changes", changes)
    # equal keys have equal hashes only where their types agree
    alike = held.schema[key].dataType == changes.schema[key].dataType
    asked = distinct_hashes(changes, [key], MAX_HASHES) if alike else None

    def of_changed_keys(df: DataFrame, how: str = "left_semi") -> DataFrame:
        return df.join(F.broadcast(asked), F.xxhash64(key) == asked["__h"], how)

    places = held.select(key, ts, F.substring("__part", 2, 100).alias("part"))
    found = _within(places if asked is None else of_changed_keys(places), changes, key, ts, as_date)
    with shuffles_dropped(store.spark):
        # as many values as there are months
        touched = sorted(r.part for r in found.select("part").distinct().collect())
    if not touched:
        store.release(f"{name}-changes")
        return None
    rows = store.read(name, layer, partitions=touched)
    mine, others = rows, None
    if asked is not None:
        mine, others = of_changed_keys(rows), of_changed_keys(rows, "left_anti")
    linked = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    wrong = _within(mine, changes, key, ts, as_date)
    again = join(wrong.drop(*linked), versions, key, ts, as_date=as_date, **options)
    again = store.set_aside(f"{name}-relinked", again.select(*rows.columns))
    kept = mine.join(broadcast_if_small(again.select(row_key)), row_key, "left_anti")
    v = store.stage(name, kept.unionByName(again), layer, part_expr=part_expr,
                    partitions=touched, laid=others)
    for aside in ("changes", "relinked"):
        store.release(f"{name}-{aside}")
    return v
