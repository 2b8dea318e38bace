"""Versioned Parquet tables with publish-after-check (K1, K7, K8, K12).

Without a transactional table format, a table is a folder of immutable
versions plus an append-only commit log:

    <root>/<LAYER>.<table>/v=00000001/part-*.parquet
    <root>/<LAYER>.<table>/v=00000002/...
    <root>/_commits/part-*.json      {table, version, path, published_at}

* ``stage`` writes the next version into a *new* folder -- a merge reads
  version N and writes N+1, so a path is never overwritten while it is
  being read (overwriting in place destroys the input mid-job).
* ``publish`` appends the versions of a whole run to the log in ONE
  write, so a run's tables become visible together; readers only ever see
  published versions.  A run that fails (or fails its quality gate) after
  staging leaves every table at its previous version.
* One writer (one active run), as the scheduler guarantees; the store
  remembers what it published, so the log is read once per store.
* Partition-scoped versions: a table laid out by a partition expression
  (e.g. the event month) can publish a version holding only the partitions
  it rewrote; the log records them, and a read takes every partition from
  the newest version that wrote it.  A daily merge then costs the months
  its batch touches, not the whole table.
* The log keeps each version's schema, so an empty version can be read and a
  table takes the columns of its newest version (older rows have NULL for
  new columns), and the greatest ingestion time, so that finding what is new
  needs no scan of the table.

Lineage cuts: a published version is a table on shared storage, so a
downstream plan reading it does not recompute (or re-read) its inputs,
and an executor lost later only re-reads Parquet.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.operators import key_index
from chainyard.operators.merge import align_to
from chainyard.session import path_exists, remove_path, shuffles_dropped

LOG_SCHEMA = ("table string, version long, path string, published_at string, "
              "partitions array<string>, schema string, watermark string, key_index string")
PART = "__part"  # layout column of partitioned tables, not shown to readers
CODEC = "zstd"  # of versions and of what is set aside: a quarter to a third smaller than snappy
STAMP = "_ingestion_timestamp"  # its greatest value is a version's watermark


def _pv(value: str) -> str:
    """Physical partition value: prefixed so Spark never infers a number."""
    return f"p{value}"


def schema_name(layer: str | None, default: str = "PUBLIC") -> str:
    """Layer names are used trimmed and upper-cased (custom schema name)."""
    return default if layer is None else layer.strip().upper()


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._known: dict[str, list] | None = None
        self._pending: dict[tuple, tuple] = {}
        self._aside: dict[str, list[str]] = {}
        self.last_merge: dict[str, dict] = {}  # what the latest merge of a table read

    def _id(self, name: str, layer: str | None = None) -> str:
        return f"{schema_name(layer)}.{name}"

    def log(self) -> DataFrame:
        """The commit log (every published version of every table)."""
        log = f"{self.root}/_commits"
        if not path_exists(self.spark, log):  # nothing published yet
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(log)

    def _entries(self) -> dict[str, list]:
        """table -> [(version, partitions or None, schema, watermark, key index)] in order."""
        if self._known is None:
            rows = self.log().select("table", "version", "partitions", "schema",
                                     "watermark", "key_index").collect()
            known: dict[str, list] = {}
            for r in sorted(rows, key=lambda r: (r.table, r.version)):
                known.setdefault(r.table, []).append(tuple(r)[1:])
            self._known = known
        return self._known

    def watermark(self, name: str, layer: str | None = None) -> str | None:
        """Greatest ingestion time of all published versions, or None."""
        marks = [e[3] for e in self._entries().get(self._id(name, layer), []) if e[3]]
        return max(marks, default=None)

    def refresh(self) -> None:
        """Forget cached versions (another writer may have published)."""
        self._known = None

    def version(self, name: str, layer: str | None = None) -> int | None:
        """Latest published version, or None."""
        e = self._entries().get(self._id(name, layer))
        return e[-1][0] if e else None

    def path(self, name: str, version: int, layer: str | None = None) -> str:
        return f"{self.root}/{self._id(name, layer)}/v={version:08d}"

    def read(self, name: str, layer: str | None = None, version: int | None = None,
             partitions: list[str] | None = None, keep_part: bool = False) -> DataFrame | None:
        """The table as of ``version`` (default: latest published).

        ``partitions`` restricts a partitioned table to those partition
        values (pruned at the scan); ``keep_part`` keeps the layout column."""
        entries = self._entries().get(self._id(name, layer), [])
        if version is not None and not any(e[0] == version for e in entries):
            entries = entries + [(version, *self._pending[(name, layer, version)])]
        entries = [e for e in entries if version is None or e[0] <= version]
        if not entries:
            return None
        full, owner = self._owners(entries)
        newest = T.StructType.fromJson(json.loads(entries[-1][2]))
        frames = []
        for i, (v, _, schema, *_) in enumerate(entries[full:], start=full):
            own = T.StructType.fromJson(json.loads(schema))
            df = self.spark.read.schema(own).parquet(self.path(name, v, layer))
            if PART in own.names:
                # the base gives what no later version owns, a later one what it owns
                mine = [_pv(p) for p, k in owner.items() if k == i]
                later = [_pv(p) for p, k in owner.items() if k != i]
                if i > full:
                    if not mine:
                        continue
                    df = df.filter(F.col(PART).isin(mine))
                elif later:
                    df = df.filter(~F.col(PART).isin(later))
                if partitions is not None:
                    df = df.filter(F.col(PART).isin([_pv(p) for p in partitions]))
            frames.append(align_to(df, newest))
        out = reduce(DataFrame.unionByName, frames)
        return out if keep_part else out.drop(PART)

    @staticmethod
    def _owners(entries: list) -> tuple[int, dict[str, int]]:
        """The last full version and, of partitions written since, the newest."""
        full = max((i for i, e in enumerate(entries) if e[1] is None), default=0)
        owner: dict[str, int] = {}
        for i, e in enumerate(entries[full + 1:], start=full + 1):
            owner.update(dict.fromkeys(e[1], i))
        return full, owner

    def key_index(self, name: str, layer: str | None = None) -> DataFrame | None:
        """The key index of the published table (see ``operators.key_index``), or
        None if a version that holds some of its partitions has none."""
        entries = self._entries().get(self._id(name, layer), [])
        if not entries:
            return None
        full, owner = self._owners(entries)
        frames = []
        for i, e in enumerate(entries[full:], start=full):
            mine = [p for p, k in owner.items() if k == i]
            if i > full and not mine:
                continue
            if not e[4]:
                return None
            df = self.spark.read.schema(key_index.SCHEMA).parquet(e[4])
            frames.append(df.filter(F.col("part").isin(mine) if i > full else
                                    ~F.col("part").isin([p for p, k in owner.items() if k != i])))
        return reduce(DataFrame.unionByName, frames)

    def set_aside(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once to a folder of its own and read back: what several
        plans of a run use is computed once and survives lost executors.
        ``release`` deletes it."""
        path = f"{self.root}/_aside/{name}-{uuid.uuid4().hex[:12]}"
        with shuffles_dropped(self.spark):
            df.write.option("compression", CODEC).parquet(path)
        self._aside.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, name: str) -> None:
        """Delete what was set aside as ``name``, once nothing reads it any more."""
        for path in self._aside.pop(name, []):
            remove_path(self.spark, path)

    def history(self, name: str, layer: str | None = None) -> DataFrame:
        return self.log().filter(F.col("table") == self._id(name, layer)).orderBy("version")

    def stage(self, name: str, df: DataFrame, layer: str | None = None,
              partition_by: list[str] | None = None, part_expr=None,
              partitions: list[str] | None = None, index_keys: list[str] | None = None,
              laid: DataFrame | None = None) -> int:
        """Write ``df`` as the next (unpublished) version; returns it.

        ``part_expr`` lays the table out by that expression's value;
        ``partitions`` then declares that this version holds only those
        partition values (the rest are taken from earlier versions).
        ``index_keys`` writes an index of these columns by partition beside it.
        ``laid`` are further rows that an earlier version holds in this layout: each
        task reads few partitions of them, so they are written without a shuffle."""
        v = (self.version(name, layer) or 0) + 1
        if part_expr is not None:
            own = F.concat(F.lit(_pv("")), F.coalesce(part_expr.cast("string"), F.lit("none")))
            df = df.withColumn(PART, own)
            partition_by = [PART]
            # cluster rows by partition so each task writes few files; AQE
            # splits a partition holding a large share of the rows
            df = df.hint("rebalance", PART)
            if laid is not None:
                df = df.unionByName(laid.withColumn(PART, own))
        if partition_by and PART in partition_by:
            # the layout column comes last, as it is read back
            df = df.select(*[c for c in df.columns if c != PART], PART)
        schema, seen = df.schema.json(), None
        if STAMP in df.columns:
            seen = Observation(f"watermark-{name}-{v}")
            df = df.observe(seen, F.max(F.col(STAMP).cast("string")).alias("mark"))
        w = df.write.mode("overwrite").option("compression", CODEC)
        if partition_by:
            w = w.partitionBy(*partition_by)
        # the folder of an unpublished version may hold a failed attempt's
        # leftovers: overwriting it is safe, nothing reads it
        with shuffles_dropped(self.spark):
            w.parquet(self.path(name, v, layer))
        index = None
        if index_keys and PART in df.columns:
            index = f"{self.root}/{self._id(name, layer)}/_keys/v={v:08d}"
            own = self.spark.read.schema(df.schema).parquet(self.path(name, v, layer))
            part = F.substring(PART, 2, 100).alias("part")
            with shuffles_dropped(self.spark):
                (key_index.build(own.select(*index_keys, part), index_keys, "part")
                 .write.mode("overwrite").parquet(index))
        self._pending[(name, layer, v)] = (
            sorted(partitions) if partitions is not None else None, schema,
            seen.get.get("mark") if seen is not None else None, index)
        return v

    def publish(self, versions: dict[tuple[str, str | None], int]) -> None:
        """Publish staged versions ``{(name, layer): version}`` together."""
        if not versions:
            return
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        rows = [(self._id(n, l), v, self.path(n, v, l), now, *self._pending[(n, l, v)])
                for (n, l), v in versions.items()]
        (self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)
             .write.mode("append").json(f"{self.root}/_commits"))
        known = self._entries()
        for (n, l), v in versions.items():
            known.setdefault(self._id(n, l), []).append((v, *self._pending.pop((n, l, v))))

    def commit(self, name: str, df: DataFrame, layer: str | None = None,
               partition_by: list[str] | None = None, part_expr=None,
               partitions: list[str] | None = None) -> int:
        """Stage and publish at once (no check in between)."""
        v = self.stage(name, df, layer, partition_by, part_expr, partitions)
        self.publish({(name, layer): v})
        return v

    def compact(self, name: str, part_expr, layer: str | None = None) -> int:
        """Rewrite a month-scoped table as one full version (same layout),
        so reads no longer assemble months from many versions.  Staged and
        published at once; earlier versions stay readable."""
        current = self.read(name, layer)
        if current is None:
            raise ValueError(f"{self._id(name, layer)} has no published version")
        return self.commit(name, current, layer, part_expr=part_expr)
