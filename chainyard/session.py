"""Session setup and the shared scratch location.

Every model assumes UTC, timestamp-without-time-zone literals and ANSI
casts (a bad integer or date raises instead of silently turning NULL).
``configure`` applies these as runtime SQL confs, so it also works on a
session somebody else built (the driver's, a notebook's).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL confs the models depend on for correct results.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions (a hot product on the fact side of a point-in-time
    # join), and turn a sort-merge join into a broadcast join only when the
    # *measured* size of one side is under the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Parquet source/landing files keep datetimes as written.
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs the library relies on; idempotent."""
    for key, value in SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "chainyard",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or get) a session with the library's conventions.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the input (roughly
    input bytes / 128 MiB), AQE coalesces what turns out too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SQL_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from the session (``spark.checkpoint.dir`` or the
    context's checkpoint dir).  Only when neither is set and the master is
    local -- a test session -- is a private temporary folder created and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` works there
    too; on a cluster that is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="chainyard-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    leaf = "-".join(parts) if parts else "scratch"
    return f"{base.rstrip('/')}/chainyard/{leaf}-{uuid.uuid4().hex[:12]}"



@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries run inside delete their shuffle files as soon as they end.

    Otherwise these stay on the executors' disks until the driver's next garbage
    collection, so that a run of many writes holds the shuffles of all of them.
    A frame made inside that is run twice shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its filesystem (local, HDFS, object store).

    Used to skip reading state or logs that were never written, instead of
    letting a read fail (a failed read is logged as an error by Spark's
    own query listeners even when the caller handles it)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files on its filesystem."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)
