"""File sources: CSV/TXT with header, JSON (array or lines), with
incremental selection by modification time (S1-S3, S7).

Listing goes through Spark's ``binaryFile`` source with only the metadata
columns selected (path, modificationTime, length), so no file content is
read to list a folder; ``modifiedAfter`` is Spark's own strict ``>``.
A new file's first lines tell how to read it: a CSV's header, a JSON file's
layout; they are looked at on the executors (``heads``).  Files alike are read by
ONE multi-file scan.

* CSV columns are matched by header name: Spark maps a declared schema by
  position, so each distinct header gets a schema in its own order.  Columns
  that are not declared are kept as text; a file that lacks a declared column
  is refused.
* A file may be compressed (``.json.gz``): Spark and ``heads`` go by its name.
* JSON: a file is one value over several lines only if its first line opens an
  array or an object that the second line goes on with.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainyard.sources.heads import file_layouts

CSV_EXT = (".csv", ".txt")
JSON_EXT = (".json",)


@dataclass
class Batch:
    """Accepted rows of a read plus the files that were refused, and --
    when a corrupt-record column was requested -- the malformed rows."""
    data: DataFrame | None
    files: list[str] = field(default_factory=list)
    rejected: list[tuple[str, str]] = field(default_factory=list)
    corrupt: DataFrame | None = None
    keys: DataFrame | None = None  # the file of every row, sound or not
    marked: DataFrame | None = None  # all rows, with the corrupt-record column


def list_files(spark: SparkSession, path: str, modified_after: str | None = None,
               glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length) of the files under ``path``.

    ``modified_after`` is 'yyyy-MM-ddTHH:mm:ss' in UTC; strictly later
    files only.
    """
    from chainyard.session import path_exists
    empty = "path string, modificationTime timestamp, length long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], empty)
    r = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
         .option("timeZone", "UTC"))
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        df = r.load(path)
    except Exception as exc:  # noqa: BLE001 - an absent or empty folder lists nothing
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) or \
                "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return spark.createDataFrame([], empty)
        raise
    return df.select("path", "modificationTime", "length")


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Zero-byte files under ``path``, which Spark's listing leaves out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    out, listing = [], fs.listFiles(root, True)
    while listing.hasNext():
        f = listing.next()
        name = f.getPath().getName()
        if f.getLen() == 0 and not name.startswith(("_", ".")):
            out.append(f.getPath().toString())
    return sorted(out)


def _ext(path: str) -> str:
    name = path.rsplit("/", 1)[-1].removesuffix(".gz")
    return ("." + name.rsplit(".", 1)[-1].lower()) if "." in name else ""


def _norm(path: str) -> str:
    return path if path.startswith("file:") or "://" in path else "file:" + path


def read_json(spark: SparkSession, files: list[str], schema: T.StructType | None,
              corrupt_col: str | None = None, layout: str = "lines") -> DataFrame:
    r = spark.read.option("multiLine", str(layout == "multiline").lower()) \
                  .option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        r = r.schema(_with_corrupt(schema, corrupt_col))
    return _keyed(r.json(files))


def read_csv(spark: SparkSession, files: list[str], schema: T.StructType | None,
             corrupt_col: str | None = None, header: tuple[str, ...] = ()) -> DataFrame:
    """CSV files with the same ``header``, their columns matched by name."""
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is None:
        return _keyed(r.option("inferSchema", "true").csv(files))
    declared = {f.name.lower(): f for f in schema.fields}
    own = T.StructType([declared.get(c.lower(), T.StructField(c, T.StringType()))
                        for c in header])
    return _keyed(r.schema(_with_corrupt(own, corrupt_col)).csv(files))


def _with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    """A copy of ``schema`` with the corrupt-record column (never mutates it)."""
    if not corrupt_col:
        return schema
    return T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)])


def _keyed(df: DataFrame) -> DataFrame:
    """Tag rows with their file (must be taken per scan, before any union)."""
    return df.withColumn("_source_key", F.col("_metadata.file_path"))


def read_paths(spark: SparkSession, files: list[str], schema: T.StructType | None = None,
               corrupt_col: str | None = None) -> Batch:
    """Read the given files, alike ones by one scan.

    Refused (reported, not raised): unknown extension, a CSV that lacks a
    declared column or repeats one.  With ``corrupt_col`` the raw text of a
    malformed row is kept in that column and split off into
    ``Batch.corrupt`` (to be quarantined): a bad row neither fails the batch
    nor loads as a row of NULLs.
    """
    rejected, groups = [], {}
    asked = [(p, "json" if _ext(p) in JSON_EXT else "csv") for p in files
             if _ext(p) in JSON_EXT or (_ext(p) in CSV_EXT and schema is not None)]
    layouts = file_layouts(spark, asked)
    for path in files:
        ext = _ext(path)
        if ext not in CSV_EXT + JSON_EXT:
            rejected.append((path, f"unsupported extension '{ext}'"))
        elif ext in JSON_EXT:
            groups.setdefault(("json", layouts[path][0]), []).append(path)
        elif schema is None:
            groups.setdefault(("csv", ()), []).append(path)
        else:
            header = layouts[path][1]
            low = [c.lower() for c in header]
            lacking = [f.name for f in schema.fields if f.name.lower() not in low]
            if lacking:
                rejected.append((path, f"no column {', '.join(lacking)}"))
            elif len(set(low)) < len(low):
                rejected.append((path, "a column is repeated"))
            else:
                groups.setdefault(("csv", header), []).append(path)
    readers = {"csv": read_csv, "json": read_json}
    parts = [readers[kind](spark, group, schema, corrupt_col, detail)
             for (kind, detail), group in groups.items()]
    if not parts:
        return Batch(None, [], rejected)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    accepted = [f for group in groups.values() for f in group]
    keys = df.select("_source_key")
    if corrupt_col:
        bad = F.col(corrupt_col).isNotNull()
        return Batch(df.filter(~bad).drop(corrupt_col), accepted, rejected, df.filter(bad), keys, df)
    return Batch(df, accepted, rejected, None, keys)


def read_batch(spark: SparkSession, path: str, schema: T.StructType | None = None,
               modified_after: str | None = None, reject_empty: bool = True,
               corrupt_col: str | None = None) -> Batch:
    """Read every new CSV/TXT/JSON file under ``path`` (see ``read_paths``).

    Also refused: zero-byte files and -- with ``reject_empty`` -- a file that
    parses to no rows (e.g. a header-only CSV).  ``_source_key`` carries each
    row's file.
    """
    listing = list_files(spark, path, modified_after).select("path").collect()
    batch = read_paths(spark, [r.path for r in listing], schema, corrupt_col)
    batch.rejected += [(f, "file is empty") for f in empty_files(spark, path)]
    if batch.data is not None and reject_empty:
        seen = {r[0] for r in batch.keys.distinct().collect()}
        empty = [f for f in batch.files if _norm(f) not in seen and f not in seen]
        batch.rejected += [(f, "file has no rows") for f in empty]
        batch.files = [f for f in batch.files if f not in empty]
        if not batch.files:
            return Batch(None, [], batch.rejected)
    return batch
