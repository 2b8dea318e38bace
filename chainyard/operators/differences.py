"""Which rows of a copy differ from its source (A4, Q12).

``compare_copies`` tells that a copy differs; this module names the rows.  Both
sides are summarised as a tree of commutative checksums: a row belongs to a part
(its month, say) and, by the hash of its contents, to one of ``buckets`` buckets,
and each has a row count and a sum of row hashes.  Equal rows meet in the same
bucket, so only buckets whose sums differ are read again and compared row by row:
d differing rows touch 2d buckets at most, whatever the size of the tables.

The first pass shuffles one row for each bucket and task; the second shuffles
the rows of differing buckets alone.  Buckets go by contents, not by key: no hot
key fills one, and copies of one row are counted before they are shuffled.

Defined results: rows are compared as multisets, NULL equals NULL, so a row that
was landed twice is found ("extra", copies 1); a changed row is "missing" as it
was and "extra" as it is; empty tables and rows without a part take part like
others.  Lineage columns are left out.  Sides whose data columns differ in name
or type raise: ``compare_copies`` reports those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.operators.joins import broadcast_if_small
from chainyard.operators.validate import data_columns, row_hash
from chainyard.schemas import METADATA_COLS
from chainyard.session import shared_dir

#: Buckets of a part; about two in so many rows are read for each differing row.
BUCKETS = 4096
#: The part of rows that have none.
NO_PART = "(none)"


def _columns(source: DataFrame, copy: DataFrame, exclude) -> list[str]:
    sides = [{c: df.schema[c].dataType for c in data_columns(df, exclude)} for df in (source, copy)]
    if sides[0] != sides[1]:
        odd = sorted(c for c in {**sides[0], **sides[1]} if sides[0].get(c) != sides[1].get(c))
        raise ValueError(f"columns differ in name or type: {', '.join(odd)}")
    return sorted(sides[0])


def _placed(df: DataFrame, cols: list[str], part, buckets: int) -> DataFrame:
    """The data columns and each row's ``_part``, ``_hash`` and ``_bucket``."""
    own = F.lit(NO_PART) if part is None else F.coalesce(F.expr(part).cast("string"), F.lit(NO_PART))
    return df.select(*cols, own.alias("_part"), row_hash(df, cols).alias("_hash")).withColumn(
        "_bucket", F.pmod("_hash", F.lit(buckets)))


def checksum_tree(df: DataFrame, part: str | None = None, buckets: int = BUCKETS,
                  exclude=METADATA_COLS) -> DataFrame:
    """part, bucket, n_rows and checksum (a decimal) of each bucket that has rows;
    ``part`` is an SQL expression over the table's columns."""
    return _leaves(_placed(df, sorted(data_columns(df, exclude)), part, buckets))


def _leaves(placed: DataFrame) -> DataFrame:
    return placed.groupBy(F.col("_part").alias("part"), F.col("_bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("_hash").cast("decimal(38,0)")).alias("checksum"))


def _compared(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Both trees' leaves: part, bucket, rows_source, rows_copy, differs."""
    both = _leaves(source).alias("s").join(_leaves(copy).alias("d"), ["part", "bucket"], "full_outer")
    same = (F.col("s.n_rows").eqNullSafe(F.col("d.n_rows"))
            & F.col("s.checksum").eqNullSafe(F.col("d.checksum")))
    return both.select("part", "bucket", F.coalesce("s.n_rows", F.lit(0)).alias("rows_source"),
                       F.coalesce("d.n_rows", F.lit(0)).alias("rows_copy"), (~same).alias("differs"))


def differing_parts(source: DataFrame, copy: DataFrame, part: str | None = None,
                    buckets: int = BUCKETS, exclude=METADATA_COLS) -> DataFrame:
    """Parts that differ: part, rows_source, rows_copy, buckets_differing."""
    cols = _columns(source, copy, exclude)
    leaves = _compared(_placed(source, cols, part, buckets), _placed(copy, cols, part, buckets))
    return leaves.groupBy("part").agg(
        F.sum("rows_source").alias("rows_source"), F.sum("rows_copy").alias("rows_copy"),
        F.count_if("differs").alias("buckets_differing")).filter("buckets_differing > 0")


def differing_rows(source: DataFrame, copy: DataFrame, part: str | None = None,
                   buckets: int = BUCKETS, exclude=METADATA_COLS) -> DataFrame:
    """The rows that one side has more often than the other: ``finding`` ("missing"
    from the copy, or "extra" there), ``copies`` (how many more), the data columns."""
    cols = _columns(source, copy, exclude)
    sides = [_placed(df, cols, part, buckets) for df in (source, copy)]
    found = _differing(*sides)
    return _surplus([side.join(found, ["_part", "_bucket"], "left_semi") for side in sides], cols)


def _differing(source: DataFrame, copy: DataFrame) -> DataFrame:
    """The differing leaves, written down once; both sides are then filtered by them."""
    spark, path = source.sparkSession, shared_dir(source.sparkSession, "differences")
    _compared(source, copy).filter("differs").select(
        F.col("part").alias("_part"), F.col("bucket").alias("_bucket")).write.parquet(path)
    return broadcast_if_small(spark.read.schema("_part string, _bucket bigint").parquet(path))


def _surplus(sides: list[DataFrame], cols: list[str]) -> DataFrame:
    signed = [df.select(*cols, F.lit(sign).cast("bigint").alias("_side"))
              for df, sign in zip(sides, (1, -1))]
    left = signed[0].unionByName(signed[1]).groupBy(*cols).agg(F.sum("_side").alias("_left"))
    return left.filter("_left <> 0").select(
        F.when(F.col("_left") > 0, "missing").otherwise("extra").alias("finding"),
        F.abs("_left").alias("copies"), *cols)
