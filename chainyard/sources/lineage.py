"""Lineage columns stamped on every ingested row (I1-I3).

The ingestion timestamp and run id are computed once on the driver and
added as literals -- never ``current_timestamp()`` inside the plan, which
would differ between a job and its retry.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.schemas import INGESTED_BY, SOURCE_LABEL


def now_iso() -> str:
    """UTC ISO-8601 text with a fixed '+00:00' offset: text order = time order."""
    return dt.datetime.now(dt.timezone.utc).isoformat()


def new_run_id() -> str:
    return str(uuid.uuid4())


def add_lineage(df: DataFrame, kind: str, ingestion_ts: str, run_id: str,
                source_bucket: str | None = None, source_table: str | F.Column | None = None,
                ) -> DataFrame:
    """Stamp lineage by ingestor ``kind``: 'files' (folder drops), 'sales'
    (daily tables), 'sheet' (sheet exports)."""
    cols = {"_ingestion_timestamp": F.lit(ingestion_ts), "_run_id": F.lit(run_id)}
    if kind == "files":
        cols["_source_bucket"] = F.lit(source_bucket)
    else:
        cols["_source"] = F.lit(SOURCE_LABEL[kind])
    if kind == "sales":
        cols["_source_table"] = (source_table if isinstance(source_table, F.Column)
                                 else F.lit(source_table))
    cols["_ingested_by"] = F.lit(INGESTED_BY[kind])
    return df.withColumns(cols)


def key_as_string(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Force the key column to text before landing (I3)."""
    return df.withColumn(key, F.col(key).cast("string")) if key in df.columns else df
