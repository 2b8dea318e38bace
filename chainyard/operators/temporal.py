"""Point-in-time (temporal) left join of facts to versioned dimensions.

``pit_join`` attaches, to every fact row, the dimension version whose
half-open validity ``[valid_from, valid_to)`` contains the fact's instant
(an open end is NULL).  It is one equi-join on the natural key with the
range as a join residual, so Catalyst picks the physical join:

* broadcast hash join when the version table has at most
  ``broadcast_max_rows`` rows (counted first -- a checked size, never a
  blind hint), so the fact side is not shuffled at all;
* otherwise a sort-merge join on the key.  AQE's skew-join splits an
  oversized fact partition (one product holding a third of all sales)
  into several tasks that each read the small matching version range.

``skew_buckets`` adds explicit salting when the versions are too large to
broadcast and AQE cannot split (e.g. the skewed side is not directly under
a shuffle): hot keys are found
with a bounded aggregate, their fact rows are spread over N salts and their
(few) versions are replicated N times; cold keys are not replicated.
Versions of one key never overlap, so the join keeps the fact row count.

``asof_join`` gives the same result by one sort and without a range residual,
for dimensions too large to broadcast whose keys have many versions.  Facts
and version starts are one stream in order of time for each key, and the last
version seen is carried forward to the facts.  A key with a large share of the
facts is cut into ranges of time of about as many facts each; what version is
open where a range begins comes from an aggregate of the key's versions by range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.operators.joins import BROADCAST_MAX_ROWS, checked_broadcast, spread, unspread


def hot_keys(df: DataFrame, keys: list[str], min_share: float = 0.01) -> DataFrame:
    """Keys holding at least ``min_share`` of all rows.

    At most ``1 / min_share`` keys can qualify, so the result has a proven
    size bound and may be broadcast.  Counting is a partial (map-side)
    aggregate, so a hot key never gathers its rows in one task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("__n") >= total * F.lit(min_share)).select(*keys)


def pit_join(fact: DataFrame, versions: DataFrame, keys, ts: str,
             valid_from: str = "valid_from", valid_to: str = "valid_to",
             as_date: bool = False, skew_buckets: int | None = None,
             hot_share: float = 0.01,
             broadcast_max_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """Left-join ``versions`` (keys, valid_from, valid_to, payload...) to
    ``fact`` at instant ``fact[ts]``; returns fact columns + payload.

    ``as_date`` compares on calendar dates (``cast(valid_from as date)``):
    two versions starting the same day leave the earlier with an empty
    interval, the later one wins.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in versions.columns if c not in (*keys, valid_from, valid_to)]
    kcols = [f"__pk{i}" for i in range(len(keys))]
    v = versions.select(*[F.col(k).alias(a) for k, a in zip(keys, kcols)],
                        F.col(valid_from).alias("__vf"), F.col(valid_to).alias("__vt"),
                        *payload)
    f = fact
    fact_cols = fact.columns
    join_keys = list(zip(keys, kcols))

    v, broadcast = checked_broadcast(v, broadcast_max_rows)
    salted = bool(skew_buckets and skew_buckets > 1 and not broadcast)
    if salted:
        hot = F.broadcast(hot_keys(fact, keys, hot_share).withColumn("__hot", F.lit(True)))
        salt = F.pmod(F.xxhash64(*fact_cols), F.lit(skew_buckets)).cast("int")
        f = (fact.join(hot, keys, "left")
                 .withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0)))
                 .drop("__hot"))
        hot_v = hot.select(*[F.col(k).alias(a) for k, a in zip(keys, kcols)], "__hot")
        v = (v.join(hot_v, kcols, "left")
              .withColumn("__salt", F.explode(
                  F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(skew_buckets - 1)))
                   .otherwise(F.array(F.lit(0)))))
              .drop("__hot"))
        v = v.withColumnRenamed("__salt", "__vsalt")

    # both plans compare the keys as they are, so they agree for any types
    conds = [f[k] == v[a] for k, a in join_keys]
    if not broadcast:
        f = f.withColumn("__spread", spread(keys, *fact_cols))
        v = v.withColumn("__unspread", unspread(kcols[0]))
        conds = [f[k] == v[a] for k, a in join_keys] + [f["__spread"] == v["__unspread"]]
    t, vf, vt = f[ts], v["__vf"], v["__vt"]
    if as_date:
        t, vf, vt = t.cast("date"), vf.cast("date"), vt.cast("date")
    if salted:
        conds.append(f["__salt"] == v["__vsalt"])
    cond = reduce(lambda a, b: a & b, conds) & (t >= vf) & ((t < vt) | vt.isNull())
    out = f.join(v, cond, "left")
    return out.select(*[f[c] for c in fact_cols], *[v[c] for c in payload])


def common_type(a: DataFrame, key_a: str, b: DataFrame, key_b: str):
    """The type in which Spark compares two columns."""
    both = a.sparkSession.createDataFrame([], T.StructType([
        T.StructField("a", a.schema[key_a].dataType), T.StructField("b", b.schema[key_b].dataType)]))
    return both.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType


def _time_cuts(fact: DataFrame, keys: list[str], ts: str, min_share: float, pieces: int
               ) -> DataFrame | None:
    """keys and __cuts: for each hot key, at most ``pieces - 1`` instants that cut
    its facts into about equal parts.  At most ``1 / min_share`` rows, found before
    the join is planned; None if no key is hot."""
    spark = fact.sparkSession
    hot = hot_keys(fact, keys, min_share)
    found = hot.collect()
    if not found:
        return None
    own = fact.join(F.broadcast(spark.createDataFrame(found, hot.schema)), keys, "left_semi")
    shares = [i / pieces for i in range(1, pieces)]
    cuts = own.groupBy(*keys).agg(F.array_sort(F.array_distinct(
        F.percentile_approx(ts, shares, 1000))).alias("__cuts"))
    return F.broadcast(spark.createDataFrame(cuts.collect(), cuts.schema))


def asof_join(fact: DataFrame, versions: DataFrame, keys, ts: str,
              valid_from: str = "valid_from", valid_to: str = "valid_to", as_date: bool = False,
              hot_share: float = 0.01, pieces: int = 64) -> DataFrame:
    """As ``pit_join``, by one sort of facts and versions together.

    Keys with ``hot_share`` of the facts or more (at most ``1 / hot_share`` keys)
    are cut into ``pieces`` ranges of time.  Facts without a key or an instant
    match nothing and are not sorted."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = fact.columns
    payload = [c for c in versions.columns if c not in (*keys, valid_from, valid_to)]
    at = (lambda c: F.col(c).cast("date")) if as_date else F.col
    # instants of either type of timestamp, and dates, in one order
    instant = lambda c: F.unix_micros(at(c).cast("timestamp_ltz"))
    kinds = [common_type(fact, k, versions, k) for k in keys]
    kcols = [f"__k{i}" for i in range(len(keys))]
    key_cols = [F.col(k).cast(t).alias(a) for k, t, a in zip(keys, kinds, kcols)]
    row = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(names)])
    own = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(payload)], instant(valid_to).alias("to"))
    facts = fact.select(*key_cols, instant(ts).alias("__t"), row.alias("__fact"))
    sound = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*kcols, "__t")])
    starts = (versions.select(*key_cols, instant(valid_from).alias("__t"), own.alias("__own"))
              .filter(sound)
              # a version of no length holds no fact
              .filter(F.col("__own.to").isNull() | (F.col("__own.to") > F.col("__t"))))

    cuts = _time_cuts(facts.filter(sound).select(*kcols, "__t"), kcols, "__t", hot_share, pieces)
    ranged = F.lit(0) if cuts is None else F.coalesce(
        F.size(F.filter("__cuts", lambda c: c <= F.col("__t"))), F.lit(0))
    place = lambda df: (df if cuts is None else df.join(cuts, kcols, "left")).withColumn(
        "__range", ranged)
    starts = place(starts)

    no_fact = F.lit(None).cast(facts.schema["__fact"].dataType).alias("__fact")
    no_own = F.lit(None).cast(starts.schema["__own"].dataType).alias("__own")
    stream = (place(facts.filter(sound)).select(*kcols, "__range", "__t", F.lit(2).alias("__kind"),
                                                "__fact", no_own)
              .unionByName(starts.select(*kcols, "__range", "__t", F.lit(1).alias("__kind"), no_fact,
                                         "__own")))
    if cuts is not None:
        # the last version that starts in each range of a hot key, handed on to the
        # ranges after it; as many rows as hot keys times pieces
        last = (starts.filter("__cuts IS NOT NULL").groupBy(*kcols, "__range")
                .agg(F.max_by("__own", "__t").alias("__last")))
        ranges = cuts.select(*kcols, F.explode(F.sequence(F.lit(0), F.size("__cuts"))).alias("__range"))
        before = W.partitionBy(*kcols).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
        opening = (ranges.join(last, [*kcols, "__range"], "left")
                   .withColumn("__own", F.last("__last", ignorenulls=True).over(before))
                   .filter("__own IS NOT NULL"))
        stream = stream.unionByName(opening.select(
            *kcols, "__range", F.lit(None).cast("bigint").alias("__t"), F.lit(0).alias("__kind"),
            no_fact, "__own"))
    # NULL instants, of what is open, come first; a start comes before a fact of its instant
    so_far = (W.partitionBy(*kcols, "__range").orderBy("__t", "__kind")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    found = (stream.withColumn("__open", F.last("__own", ignorenulls=True).over(so_far))
             .filter("__kind = 2"))
    holds = F.col("__open.to").isNull() | (F.col("__t") < F.col("__open.to"))
    out = found.select("__fact", F.when(holds, F.col("__open")).alias("__open"))
    rest = facts.filter(~F.coalesce(sound, F.lit(False))).select("__fact", no_own.alias("__open"))
    return out.unionByName(rest).select(
        *[F.col(f"__fact.f{i}").alias(c) for i, c in enumerate(names)],
        *[F.col(f"__open.p{i}").alias(c) for i, c in enumerate(payload)])
