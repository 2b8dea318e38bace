"""How to read dropped files, judged on the executors from their first lines.

A task opens its files and reads on until it can tell, however long a line is:

* CSV: the first line, to its line feed, is the header.
* JSON: records end at line feeds alone (a string may hold U+2028 and the
  like).  A first line that is a value of its own means a value on each line.  If
  it opens a value that the second line goes on with, the file is one value
  over several lines; whatever else it is (junk, a record cut short) is one broken
  record of a file with a value on each line, which costs no other record.

Files are opened by their address; those in a store that only Spark reads are
judged from the content that Spark hands to the task.
"""

from __future__ import annotations

import csv
import gzip
import io
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Bytes that are read of a file at once.
CHUNK = 1 << 16
#: Bytes up to which a line is parsed; a longer one is judged by its ends.
LONG_LINE = 1 << 22
#: Files of a task, about.
FILES = 64

SCHEMA = "path string, layout string, header array<string>, error string"


class Lines:
    """The first lines of a file that are not blank: whole up to ``LONG_LINE``,
    else their first and last bytes."""

    def __init__(self, stream):
        self.stream, self.rest, self.ended = stream, b"", False

    def _more(self) -> bytes:
        data = self.stream.read(CHUNK)
        self.ended = not data
        return data

    def next(self, blank: bool = False) -> tuple[bytes, bool]:
        """(line, whether it is whole); an empty line at the end of the file."""
        while True:
            parts, size = [], 0
            while True:
                data = self.rest or self._more()
                self.rest = b""
                at = data.find(b"\n")
                if at >= 0:
                    data, self.rest = data[:at], data[at + 1:]
                parts.append(data)
                size += len(data)
                if size > LONG_LINE and len(parts) > 3:
                    parts = [parts[0], b"".join(parts[1:])[-CHUNK:]]
                if at >= 0 or self.ended:
                    break
            line = b"".join(parts)
            if line.strip() or self.ended or blank:
                return line, size <= LONG_LINE


def goes_on(text: str) -> bool | None:
    """Whether more must follow ``text`` to make a JSON value: None if it is one,
    False if nothing can."""
    try:
        json.loads(text)
        return None
    except ValueError as exc:
        return text.lstrip()[:1] in ("{", "[") and exc.pos >= len(text.rstrip())
    except RecursionError:
        return None


def json_layout(lines: Lines) -> str:
    first, whole = lines.next()
    first = first.removeprefix(b"\xef\xbb\xbf").strip()
    second = lines.next()[0].strip()
    if not second:
        return "lines"  # one line
    if not whole:
        # too long to parse: does it end as it begins?
        closed = {b"[": b"]", b"{": b"}"}.get(first[:1])
        cut_short = first[:1] == b"{" and second[:1] == b"{" and first[-1:] not in b",:["
        return "lines" if closed is None or first.endswith(closed) or cut_short else "multiline"
    try:
        a = first.decode()
    except UnicodeDecodeError:
        return "lines"
    if not goes_on(a):
        return "lines"
    b = second[:LONG_LINE].decode("utf-8", "ignore")
    # the second line continues the value, to its end or at least to the line's
    follows = goes_on(f"{a}\n{b}")
    return "multiline" if follows is None or follows else "lines"


def csv_header(lines: Lines) -> list[str]:
    line = lines.next(blank=True)[0].removeprefix(b"\xef\xbb\xbf").decode("utf-8", "replace")
    first = next(csv.reader([line.rstrip("\r")]), [])
    return [c.strip() for c in first]


def judge(kind: str, stream) -> tuple[str | None, list[str] | None]:
    """(layout, header) of a file of that kind ('json' or 'csv')."""
    csv.field_size_limit(1 << 30)
    lines = Lines(stream)
    return (json_layout(lines), None) if kind == "json" else (None, csv_header(lines))


def opened(path: str):
    """A file by its address, through pyarrow, which undoes a ``.gz``."""
    from pyarrow import fs
    if path.startswith("file:") or "://" not in path:
        local = path.removeprefix("file:")
        return fs.LocalFileSystem().open_input_stream("/" + local.lstrip("/"))
    scheme, rest = path.split("://", 1)
    store, place = fs.FileSystem.from_uri(f"{'s3' if scheme.startswith('s3') else scheme}://{rest}")
    return store.open_input_stream(place)


def file_layouts(spark: SparkSession, files: list[tuple[str, str]]) -> dict[str, tuple]:
    """path -> (layout, header, error) of (path, kind) files, none of which the
    driver opens.  The answer has a row for each file."""
    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, kind in zip(f["path"], f["kind"]):
                try:
                    with opened(path) as stream:
                        rows.append((path, *judge(kind, stream), None))
                except Exception as exc:  # noqa: BLE001 - such a file is asked of Spark
                    rows.append((path, None, None, f"{type(exc).__name__}: {exc}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "layout", "header", "error"])

    def look_inside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(path, *judge(kinds[_plain(path)], gzip.open(io.BytesIO(data))
                                  if path.endswith(".gz") else io.BytesIO(data)), None)
                    for path, data in zip(f["path"], f["content"])]
            yield pd.DataFrame(rows, columns=["path", "layout", "header", "error"])

    if not files:
        return {}
    asked = spark.createDataFrame(files, "path string, kind string")
    found = _answers(asked.repartition(-(-len(files) // FILES)).mapInPandas(look, SCHEMA))
    closed = {_plain(p): (p, kind) for p, kind in files if found[p][2]}
    if closed:
        kinds = {name: kind for name, (_, kind) in closed.items()}
        content = spark.read.format("binaryFile").load([p for p, _ in closed.values()])
        for p, answer in _answers(content.select("path", "content")
                                  .mapInPandas(look_inside, SCHEMA)).items():
            found[closed[_plain(p)][0]] = answer
    return found


def _plain(path: str) -> str:
    """An address, however its scheme is written."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _answers(df: DataFrame) -> dict[str, tuple]:
    return {r.path: (r.layout, tuple(r.header) if r.header is not None else None, r.error)
            for r in df.collect()}
