"""Relational source: daily tables read over JDBC (S4, S5).

The table list comes from the database catalog with a LIKE prefix and is
then filtered by the strict daily pattern.  A table is read by a
partitioned scan (``numPartitions`` range splits of a numeric column), so
it is never materialised on one machine; ``fetchsize`` bounds each
round trip.  Requires the database's JDBC driver on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainyard.sources.daily import TABLE_LIKE, discover_names

# Rows per JDBC round trip.
FETCH_SIZE = 50_000


def list_tables(spark: SparkSession, url: str, schema: str, props: dict | None = None,
                catalog_query: str | None = None) -> list[str]:
    """Daily table names in ``schema``, in name order."""
    q = catalog_query or (
        "select table_name from information_schema.tables "
        f"where table_schema = '{schema}' and table_type = 'BASE TABLE' "
        f"and table_name like '{TABLE_LIKE}'")
    names = spark.read.jdbc(url, f"({q}) catalog", properties=props or {})
    return discover_names(r[0] for r in names.collect())


def read_table(spark: SparkSession, url: str, table: str, props: dict | None = None,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None,
               fetchsize: int = FETCH_SIZE, require_rows: bool = True) -> DataFrame:
    props = dict(props or {})
    props.setdefault("fetchsize", str(fetchsize))
    if partition_column:
        df = spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                             upperBound=upper, numPartitions=num_partitions,
                             properties=props)
    else:
        df = spark.read.jdbc(url, table, properties=props)
    if require_rows and df.isEmpty():
        raise ValueError(f"Table '{table}' has no rows.")
    return df


def read_jdbc_table(spark: SparkSession, url: str, table: str, part_col: str | None = None,
                    bounds: tuple[int, int] | None = None, n: int | None = None,
                    props: dict | None = None) -> DataFrame:
    """``read_table`` with the partitioning given as (column, (low, high), n)."""
    low, high = bounds if bounds else (None, None)
    return read_table(spark, url, table, props, part_col, low, high, n)
