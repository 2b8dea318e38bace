"""Which months of a table may hold some keys, without reading the table.

Beside each version of a month-partitioned table lies an index of its keys:
for each month a bitmap with ``BITS`` to ``2 * BITS`` bits a key, in which
every key sets ``PROBES`` bits by its hash, in buckets of 32,768 bits
(``bitmap_construct_agg``).  A month whose bitmap lacks one of a key's bits
does not hold the key; one that has them all holds it but for a false hit, about
one in 100,000 for each key and month.  A merge reads the keys of the months
alone that its batch hits (and its own), so false hits cost reading, never
results.

The index takes 8 to 16 bytes a key, mostly zeros before compression, and is
built from the written months, so a merge writes that of its own months only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.operators.joins import broadcast_if_small

#: Bits of a bitmap for each of its keys, at least, and bits that a key sets.
BITS, PROBES = 64, 4
#: Bits of the smallest bitmap: one bucket.
LEAST = 1 << 15

SCHEMA = "part string, space bigint, bucket bigint, bits binary"


def _hashes(keys) -> list[Column]:
    """Two numbers whose sums do not leave the range of long."""
    bound = F.lit(1 << 56)
    return [F.pmod(F.xxhash64(*keys), bound).alias("h1"),
            F.pmod(F.xxhash64(F.lit(1), *keys), bound).alias("h2")]


def _place() -> Column:
    """The bit (from 1) of probe ``i``."""
    return F.pmod(F.col("h1") + F.col("i") * F.col("h2"), F.col("space")) + 1


def build(rows: DataFrame, keys, part: str) -> DataFrame:
    """The index of ``rows`` by the values of ``part``; NULL keys are in none."""
    keyed = rows.select(F.col(part).alias("part"), *keys).dropna(subset=list(keys))
    # as many rows as months; the sizes differ, so bitmaps do too
    sizes = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    power = F.ceil(F.log2(F.col("n") * F.lit(float(BITS)))).cast("int")
    space = F.greatest(F.pow(F.lit(2.0), power).cast("bigint"), F.lit(LEAST).cast("bigint"))
    sizes = F.broadcast(sizes.select("part", space.alias("space")))
    probes = F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))).alias("i")
    hashed = keyed.select("part", *_hashes(keys)).join(sizes, "part").select("*", probes)
    placed = hashed.select("part", "space", _place().alias("at"))
    return placed.groupBy("part", "space", F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def _is_set(bits: str, position: Column) -> Column:
    """Whether a bitmap has the bit: the lowest of a byte comes first."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("bigint"), (position % 8).cast("int")) == 1


def parts_with(index: DataFrame, rows: DataFrame, keys) -> list[str]:
    """The values of ``part`` (as many as months at most) that may hold a key of
    ``rows``, in order."""
    # powers of two: some thirty at most
    spaces = [r.space for r in index.select("space").distinct().collect()]
    if not spaces:
        return []
    asked = rows.select(*keys).dropna().select(*_hashes(keys)).distinct()
    probes = (asked.withColumn("space", F.explode(F.array(*[F.lit(s).cast("bigint") for s in spaces])))
              .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(PROBES - 1))))
              .select("h1", "h2", "space", F.bitmap_bucket_number(_place()).alias("bucket"),
                      F.bitmap_bit_position(_place()).alias("at")))
    hits = index.join(broadcast_if_small(probes), ["space", "bucket"])
    hits = hits.filter(_is_set("bits", F.col("at"))).groupBy("part", "h1", "h2").count()
    found = hits.filter(F.col("count") == PROBES).select("part").distinct().collect()
    return sorted(r.part for r in found)
