"""Ingestion progress state and run cadence (I4-I7, I10).

State is a small key/value table per service (JSON, read and written by
Spark, so it lives on the same shared storage as the data).  Each save
writes a new numbered folder and never touches the previous one; the
newest complete folder is the current state, so a crash mid-save leaves
the last good state in place.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

# First-run default, static-source refresh period.
EPOCH = "1970-01-01T00:00:00+00:00"
STATIC_REFRESH_DAYS = 30
#: Key of the marker row of each saved state.
SAVED = "__saved"


def _versions(spark: SparkSession, path: str) -> list[int]:
    from chainyard.sources.files import list_files
    files = list_files(spark, path, glob="*.json").select("path").collect()
    out = set()
    for r in files:
        seg = [s for s in r.path.split("/") if s.startswith("v=")]
        if seg:
            out.add(int(seg[-1][2:]))
    return sorted(out)


def load_state(spark: SparkSession, path: str) -> dict[str, str]:
    """Latest saved state of a service; ``{}`` on the first run."""
    versions = _versions(spark, path)
    if not versions:
        return {}
    rows = spark.read.schema("key string, value string").json(
        f"{path}/v={versions[-1]:08d}").collect()
    return {r.key: r.value for r in rows if r.key != SAVED}


def save_state(spark: SparkSession, path: str, state: dict[str, str]) -> int:
    versions = _versions(spark, path)
    nxt = (versions[-1] + 1) if versions else 1
    # an empty state is a version too: its marker row makes the folder count
    rows = [(SAVED, str(nxt)), *sorted(state.items())]
    (spark.createDataFrame(rows, "key string, value string")
          .coalesce(1).write.mode("errorifexists").json(f"{path}/v={nxt:08d}"))
    return nxt


def parse_iso(text: str | None) -> dt.datetime:
    """ISO-8601 text to an aware UTC datetime; epoch when missing."""
    return dt.datetime.fromisoformat(text or EPOCH).astimezone(dt.timezone.utc)


def modified_after_option(text: str | None) -> str | None:
    """Watermark text -> the file source's ``modifiedAfter`` form: UTC, whole
    seconds, one second *before* the watermark's own, since the source's
    comparison is strict.  Files of that second are listed again and dropped
    by the log of loaded files."""
    if not text:
        return None
    t = parse_iso(text).replace(microsecond=0) - dt.timedelta(seconds=1)
    return t.strftime("%Y-%m-%dT%H:%M:%S")


def refresh_due(last_sync: str | None, now: dt.datetime | None = None,
                every_days: int = STATIC_REFRESH_DAYS) -> bool:
    """Full refresh of a static source is due unless the last sync is
    strictly within ``every_days`` of ``now``."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return not (parse_iso(last_sync) > now - dt.timedelta(days=every_days))


def weekday_due(now: dt.datetime | None = None, weekday: int | None = 0) -> bool:
    """Run only on ``weekday`` (0 = Monday); ``None`` = every day."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return weekday is None or now.weekday() == weekday


def due(last: str | None, every_days: int | None = STATIC_REFRESH_DAYS,
        weekday: int | None = None, now: dt.datetime | None = None) -> bool:
    """A source runs when both its refresh period has elapsed (or is None)
    and today is its weekday (or weekday is None)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    period_ok = every_days is None or refresh_due(last, now, every_days)
    return period_ok and weekday_due(now, weekday)


def unseen_names(all_names, state: dict[str, str]) -> list[str]:
    """Names not yet in the seen-set, in order."""
    return [n for n in all_names if n not in state]
