"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainyard.session import configure, shared_dir

#: Rows of one Arrow batch: bounds a Python worker's memory with long texts.
BATCH_ROWS = 1000


def prepared(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    """The session with the library's conventions and bounded Arrow batches."""
    configure(spark)
    # where workers share the driver's files, they import this package from there
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(batch_rows):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts lineage: a lost executor cannot lose the result, and a frame that
    several branches read is computed once.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores, such that ``df`` has no such
    column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
