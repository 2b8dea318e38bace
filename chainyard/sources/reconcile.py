"""Landed files and loads whose columns differ in type, read as one table.

Files are grouped by their own schema, each column takes the narrowest type
that holds every value of all its groups exactly, and each group is one scan
with its casts; the scans are united.  So a day landed as int, the next as
long and another as decimal load together, and nothing is rewritten.

The type of a column follows from the *set* of its types, not from their order:

* whole numbers and decimals: the widest whole number, else a decimal with the
  most digits before and after the point; text beyond 38 digits;
* with float or double: double if all others have at most 15 digits, else text;
* date and timestamp without zone: that timestamp;
* numbers, booleans, dates or that timestamp with text: text;
* anything else that differs (nested types, binary, timestamps with zone, a
  boolean with a number, a date with a number): no type, so the later group is
  refused, and named with its column and types.

Names are compared without case, as Spark resolves them; a column that a group
lacks is NULL there.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal digits of each whole-number type, narrowest first (fixed values).
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
#: Decimal digits that a double holds exactly (fixed value).
DOUBLE_DIGITS = 15
MAX_DIGITS = 38


@dataclass(frozen=True)
class Group:
    """Files, or folders, that one scan can read with one schema."""
    schema: T.StructType
    paths: tuple[str, ...]

    def types(self) -> dict[str, T.DataType]:
        return {f.name.lower(): f.dataType for f in self.schema}


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE[t], 0)


def common_type(types: Iterable[T.DataType]) -> T.DataType | None:
    """The narrowest type that holds the values of all ``types``; None if there is none."""
    kinds = set(types)
    if len(kinds) == 1:
        return kinds.pop()
    exact = {t for t in kinds if t in WHOLE or isinstance(t, T.DecimalType)}
    floating = {t for t in kinds if isinstance(t, (T.FloatType, T.DoubleType))}
    dates = {t for t in kinds if isinstance(t, (T.DateType, T.TimestampNTZType))}
    texts = {t for t in kinds if isinstance(t, (T.StringType, T.BooleanType))}
    if kinds - exact - floating - dates - texts:
        return None
    if T.StringType() in kinds:
        return T.StringType()
    if kinds == dates:
        return T.TimestampNTZType()
    if kinds != exact | floating:
        return None
    before = max((_digits(t)[0] for t in exact), default=0)
    after = max((_digits(t)[1] for t in exact), default=0)
    if floating:
        return T.DoubleType() if before + after <= DOUBLE_DIGITS else T.StringType()
    if exact <= set(WHOLE):
        return max(exact, key=WHOLE.get)
    return T.DecimalType(before + after, after) if before + after <= MAX_DIGITS else T.StringType()


def _merged_schema(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """The schema of files whose columns agree in type, from one job over their
    footers; None if they do not agree.  Unreadable footers are left out."""
    try:
        return (spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true")
                .parquet(*paths).schema)
    except (PySparkException, Py4JJavaError) as exc:  # a failed merge reaches Python unconverted
        if "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return T.StructType([])
        if "CANNOT_MERGE_SCHEMAS" in str(exc):
            return None
        raise


def schema_groups(spark: SparkSession, paths: list[str]) -> list[Group]:
    """The files grouped by schema, in the order of their paths.

    Halves of the sorted paths are tried until each agrees in itself: a drop's
    files lie together, so there are some log2(files) jobs over footers for each
    change of schema along the paths, and one job where all agree.
    """
    ordered = sorted(paths)
    if not ordered:
        return []
    schema = _merged_schema(spark, ordered)
    if schema is not None:
        return [Group(schema, tuple(ordered))]
    half = len(ordered) // 2
    if not half:  # one file whose own columns clash
        raise ValueError(f"the schema of {ordered[0]} cannot be read")
    return together(schema_groups(spark, ordered[:half]) + schema_groups(spark, ordered[half:]))


def together(groups: Iterable[Group]) -> list[Group]:
    """Groups whose common columns have equal types, joined to one."""
    out: list[Group] = []
    for g in groups:
        mine = g.types()
        for k, other in enumerate(out):
            theirs = other.types()
            if all(theirs.get(c, t) == t for c, t in mine.items()):
                extra = [f for f in g.schema if f.name.lower() not in theirs]
                out[k] = Group(T.StructType(list(other.schema) + extra), other.paths + g.paths)
                break
        else:
            out.append(g)
    return out


def agreed(groups: list[Group], known: Iterable[T.StructType] = ()
           ) -> tuple[T.StructType, list[Group], dict[str, str]]:
    """(schema, groups that it holds, refused path -> reason).

    ``known`` are schemas already in the table: they are never refused.
    """
    names: dict[str, str] = {}
    types: dict[str, set[T.DataType]] = {}

    def add(schema: T.StructType) -> None:
        for f in schema:
            names.setdefault(f.name.lower(), f.name)
            types.setdefault(f.name.lower(), set()).add(f.dataType)

    for schema in known:
        add(schema)
    held, refused = [], {}
    for g in groups:
        clashes = [(f.name, f.dataType, types[f.name.lower()]) for f in g.schema
                   if common_type(types.get(f.name.lower(), set()) | {f.dataType}) is None]
        if clashes:
            why = "; ".join(
                f"column {name}: {t.simpleString()} does not go with "
                f"{', '.join(sorted(o.simpleString() for o in others))}" for name, t, others in clashes)
            refused.update(dict.fromkeys(g.paths, why))
        else:
            add(g.schema)
            held.append(g)
    return T.StructType([T.StructField(names[c], common_type(types[c])) for c in names]), held, refused


def read_groups(spark: SparkSession, groups: list[Group], schema: T.StructType) -> DataFrame:
    """The rows of all groups with the types of ``schema``: a scan for each set of
    groups that needs the same casts, so one where the types agree."""
    parts = None
    for g in together(groups):
        own = g.types()
        df = spark.read.schema(g.schema).parquet(*g.paths)
        cast = df.select([
            (F.col(f"`{f.name}`") if f.name.lower() in own else F.lit(None))
            .cast(f.dataType).alias(f.name) for f in schema])
        parts = cast if parts is None else parts.unionByName(cast)
    return parts if parts is not None else spark.createDataFrame([], schema)
