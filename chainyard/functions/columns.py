"""Column-level functions shared by the models.

All are compositions of built-in expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands in for NULL inside a surrogate key, the key
# separator, and the allowed status values.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
STOCK_LEVELS = ("IN_STOCK", "LOW_STOCK", "OUT_OF_STOCK")
DELIVERY_STATUSES = ("ON_TIME", "LATE", "PENDING")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the '-'-joined text of ``cols``; NULL parts become a marker.

    Same value as the SQL ``md5(concat_ws('-', coalesce(cast(c as varchar),
    marker), ...))``, so keys agree across engines.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def version_id(key: str | Column, updated_at: str | Column) -> Column:
    """Id of one SCD2 version: md5(key '|' updated_at), NULLs as ''."""
    return F.md5(F.concat_ws(
        "|",
        F.coalesce(_c(key).cast("string"), F.lit("")),
        F.coalesce(_c(updated_at).cast("string"), F.lit("")),
    ))


def any_changed(cols, left: str = "t", right: str = "s") -> Column:
    """True when any of ``cols`` differs between two aliases, null-safely."""
    diffs = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, diffs) if diffs else F.lit(False)


def stock_level(quantity: str | Column = "quantity_available",
                threshold: str | Column = "reorder_threshold") -> Column:
    """OUT_OF_STOCK at 0, LOW_STOCK at or under the threshold, else IN_STOCK.

    Evaluated on the raw values.  A NULL quantity, or a NULL threshold with a
    non-zero quantity, falls through to IN_STOCK (SQL CASE semantics).
    """
    q, t = _c(quantity), _c(threshold)
    return (F.when(q == 0, F.lit(STOCK_LEVELS[2]))
             .when(q <= t, F.lit(STOCK_LEVELS[1]))
             .otherwise(F.lit(STOCK_LEVELS[0])))


def delivery_status(actual: str | Column = "actual_delivery_date",
                    expected: str | Column = "expected_delivery_date") -> Column:
    """PENDING without an actual date, ON_TIME if not later than expected,
    else LATE (also LATE when only the expected date is missing)."""
    a, e = _c(actual), _c(expected)
    return (F.when(a.isNull(), F.lit(DELIVERY_STATUSES[2]))
             .when(a <= e, F.lit(DELIVERY_STATUSES[0]))
             .otherwise(F.lit(DELIVERY_STATUSES[1])))


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Days from ``start`` to ``end`` (SQL ``datediff('day', start, end)``).

    Spark's ``datediff`` takes (end, start); both sides are cast to date
    first so a timestamp pair counts calendar-day changes.
    """
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def date_id(d: str | Column) -> Column:
    """yyyymmdd as an integer."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def day_of_week0(d: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def iso_to_timestamp(text: str | Column, default: str = "1970-01-01 00:00:00") -> Column:
    """Parse an ISO-8601 text timestamp (offset dropped after UTC shift),
    defaulting to the epoch when NULL or empty."""
    t = _c(text)
    parsed = F.to_timestamp_ntz(F.regexp_replace(t, r"(\+00:00|Z)$", ""))
    return F.coalesce(F.when(F.length(t) > 0, parsed), F.lit(default).cast("timestamp_ntz"))


def file_extension(path: str | Column) -> Column:
    """Lower-cased extension including the dot ('' when none)."""
    return F.lower(F.regexp_extract(_c(path), r"(\.[^./]+)$", 1))
