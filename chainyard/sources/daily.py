"""Daily sales tables: discovery by name, landing by year/month, and the
union of all of them (S4, S9, S10, K2, U1, O1).

A day's table ``sales_YYYY_MM_DD`` lands in ``<root>/yyyy=YYYY/mm=MM/``
with ``_source_table`` set, so the union of every table is ONE scan of the
landing root (partition pruning by year/month comes free), not a chain of
N per-table reads.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Daily table names (catalog LIKE prefix, then a strict pattern).
TABLE_LIKE = "sales%"
TABLE_PATTERN = r"^sales[_/](\d{4})[_/](\d{2})[_/](\d{2})$"
_RX = re.compile(TABLE_PATTERN)


def discover_names(names) -> list[str]:
    """Daily table names among ``names``, in name order (= date order)."""
    return sorted(n for n in names if n.lower().startswith("sales") and _RX.match(n))


def table_date_parts(col: str | Column = "_source_table") -> dict[str, Column]:
    c = F.col(col) if isinstance(col, str) else col
    return {"yyyy": F.regexp_extract(c, TABLE_PATTERN, 1),
            "mm": F.regexp_extract(c, TABLE_PATTERN, 2),
            "dd": F.regexp_extract(c, TABLE_PATTERN, 3)}


def discover(tables: DataFrame, col: str = "table_name") -> DataFrame:
    """Catalog rows whose name is a daily sales table, with the parsed
    date parts; ordered by name."""
    parts = table_date_parts(col)
    return (tables.filter(F.col(col).like(TABLE_LIKE) & F.col(col).rlike(TABLE_PATTERN))
                  .withColumns(parts).orderBy(col))


def land_daily(df: DataFrame, root: str, table_col: str = "_source_table",
               mode: str = "append") -> None:
    """Write rows of many daily tables at once, partitioned by the year and
    month parsed from the table name.  Rows are clustered by partition
    first so each task writes few files; the rebalance hint lets AQE split
    a month holding a large share of the rows over several tasks."""
    parts = table_date_parts(table_col)
    (df.withColumns({"yyyy": parts["yyyy"], "mm": parts["mm"]})
       .hint("rebalance", "yyyy", "mm")
       .write.mode(mode).option("compression", "snappy")
       .partitionBy("yyyy", "mm").parquet(root))


def read_daily(spark: SparkSession, root: str, table_col: str = "_source_table") -> DataFrame:
    """Union of every landed daily table (one scan), columns of all runs merged
    by name.  The run and year/month folder columns only serve pruning; dates
    come from the table name."""
    df = spark.read.option("mergeSchema", "true").parquet(root)
    return df.filter(F.col(table_col).rlike(TABLE_PATTERN)).drop("run", "yyyy", "mm")


def union_all(frames: list[DataFrame]) -> DataFrame | None:
    """UNION ALL by column name; None (with a message) for no input."""
    if not frames:
        print("No sales tables found - skipping union.")
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)



def unseen(tables: DataFrame, seen: DataFrame, col: str = "table_name") -> DataFrame:
    """Tables not yet ingested (seen-set watermark, I6)."""
    return tables.join(seen.select(col), col, "left_anti")
