"""Operator 6: metadata and plain-text records derived from WARC responses.

Method: each response record gives a ``metadata`` record (title, language,
character set, outgoing links and the source's own headers as warc-fields)
and a ``conversion`` record (its plain text).  Both name their source in
WARC-Refers-To, WARC-Refers-To-Target-URI and WARC-Refers-To-Date, the
conversion is concurrent to the metadata, the source's payload digest is
kept, and each has a digest of its own block.  Identifiers follow from the
source's, so a repeated task writes the same records.

The work is a map over rows: no shuffle, so no host or group of copies can
be hot.  ``write_warc`` writes one gzip member for each record, in files
that a manifest names once their tasks have ended; ``read_warc`` reads them
back record by record and verifies lengths and digests.

Defined results: NULL or empty markup gives an empty payload, whose
conversion has an empty block; a NULL address is empty; repeated rows give
repeated records with equal identifiers; an empty table gives an empty
result; other columns are ignored.  Markup is never cut.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainyard.llm.common import text_or_empty
from chainyard.llm.token_records import _filesystem

#: Name space of the identifiers that are derived from others.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:chainyard:warc")

RESPONSE = "key long, record_id string, target_uri string, date string, headers string, payload binary"
DERIVED = ("key long, type string, record_id string, refers_to string, target_uri string, "
           "date string, header string, block binary")
READ = ("key long, type string, record_id string, refers_to string, target_uri string, "
        "payload_digest string, block_digest string, n_bytes long, sound boolean")
MANIFEST = "file string, n_records long"

#: Elements whose content is not shown, and those that begin or end a line.
HIDDEN = {"script", "style", "noscript", "template"}
BREAKS = set("address article aside blockquote body br dd div dl dt fieldset figure footer form "
             "h1 h2 h3 h4 h5 h6 head header hr li main nav ol p pre section table td th title tr "
             "ul".split())
NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*(?:[-:.][A-Za-z0-9]+)*)|<[/!?]")
#: A tag without quotes and such.
PLAIN = re.compile(NAME.pattern.partition("|<[")[0] + "[^<>\"']*>")
STOPS = re.compile("[\"'>]")
HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LANGUAGE = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?([\w-]+)", re.I)


def _tag_end(markup: str, at: int, quotes: bool) -> int:
    """The place after a tag's '>', which may also stand in quotes; 0 if none."""
    while True:
        found = STOPS.search(markup, at) if quotes else None
        at = found.start() if found else (-1 if quotes else markup.find(">", at))
        if at < 0:
            return 0
        if markup[at] == ">":
            return at + 1
        at = markup.find(markup[at], at + 1) + 1
        if not at:
            return 0


def scanned(markup: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, source) of a page's parts in order: text, open, close, other
    (a declaration) and hidden ones (comments, and elements that are not shown).

    One pass forward: whatever is left open, no part is looked at again.  Once
    a tag's quotes do not close, quotes count no more; without a '>' to come, the
    rest is text."""
    at, quotes, n = 0, True, len(markup)
    while at < n:
        start = markup.find("<", at)
        if start < 0:
            yield "text", "", markup[at:]
            return
        if start > at:
            yield "text", "", markup[at:start]
        if markup.startswith("<!--", start):
            end = markup.find("-->", start + 4)
            at = n if end < 0 else end + 3
            yield "hidden", "", ""
            continue
        whole = PLAIN.match(markup, start)
        if whole is not None and whole[2].lower() not in HIDDEN:
            yield "close" if whole[1] else "open", whole[2].lower(), whole[0]
            at = whole.end()
            continue
        name = NAME.match(markup, start)
        if name is None:
            yield "text", "", "<"
            at = start + 1
            continue
        end = _tag_end(markup, name.end(), quotes)
        if not end and quotes:
            quotes, end = False, _tag_end(markup, name.end(), False)
        kind = (name[2] or "").lower()
        if kind in HIDDEN and not name[1]:
            close = re.compile(rf"</{kind}\s*>", re.I).search(markup, end or n)
            at = close.end() if close else n
            yield "hidden", kind, ""
            continue
        if not end:
            yield "text", "", markup[start:]
            return
        yield ("other" if not kind else "close" if name[1] else "open"), kind, markup[start:end]
        at = end


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind} {source}')}>"


def plain_text(markup: str, parts: list | None = None) -> str:
    """Visible text, a line for each block (of the page's ``parts``, if known)."""
    shown = []
    for kind, name, source in scanned(markup) if parts is None else parts:
        if kind in ("text", "hidden"):
            shown.append(source if kind == "text" else " ")
        elif name in BREAKS:
            shown.append("\n")
    lines = (" ".join(line.split()) for line in html.unescape("".join(shown)).split("\n"))
    return "\n".join(line for line in lines if line)


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


def metadata(markup: str, headers: str, payload_digest: str, parts: list | None = None) -> str:
    """Fields of a metadata record, with the source's headers."""
    found, links, title = {}, [], None
    for kind, name, source in scanned(markup) if parts is None else parts:
        if name == "title" and "title" not in found:
            if kind == "close" and title is not None:
                found["title"] = _clean("".join(title))
            elif kind == "open" and title is None:
                title = []
        elif kind in ("text", "hidden") and title is not None and "title" not in found:
            title.append(source or " ")
        elif kind == "open" and name == "a":
            link = HREF.search(source)
            if link:
                links.append(_clean(link[1] or link[2] or link[3] or ""))
        elif kind == "open" and name in ("html", "meta"):
            field, pattern = ("language", LANGUAGE) if name == "html" else ("charset", CHARSET)
            value = pattern.search(source)
            if value and field not in found:
                found[field] = value[1]
    fields = [(n, found[n]) for n in ("title", "language", "charset") if n in found]
    fields += [("outlink", link) for link in links]
    fields += [("source-payload-digest", payload_digest)]
    fields += [("source-header", line) for line in headers.split("\r\n") if line]
    return "".join(f"{n}: {v}\r\n" for n, v in fields)


def decoded(payload: bytes, headers: str) -> str:
    """A payload's text by the character set that its headers name, else UTF-8;
    what a page says of itself comes after its headers and is only reported."""
    named = CHARSET.search(headers)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except (LookupError, ValueError):
        return payload.decode("utf-8", "replace")


def warc_header(fields: list[tuple[str, str]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in fields) + "\r\n"


def responses(pages: DataFrame, date: str, key: str = "page_id", url: str = "url",
              markup: str = "html") -> DataFrame:
    """Response records of fetched pages: key, record_id, target_uri, date,
    the HTTP headers and the payload."""
    payload = F.encode(text_or_empty(markup), "UTF-8")
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                             "Content-Length: "), F.length(payload).cast("string"), F.lit("\r\n"))
    # an address with line ends would break the header's lines
    uri = F.replace(F.replace(text_or_empty(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = F.sha2(F.concat_ws("\n", F.col(key).cast("string"), uri), 256)
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    record = F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))
    return pages.select(F.col(key).cast("bigint").alias("key"), record.alias("record_id"),
                        uri.alias("target_uri"), F.lit(date).alias("date"),
                        headers.alias("headers"), payload.alias("payload"))


def derive_row(row: dict) -> list[dict]:
    """The metadata and the conversion record of a response."""
    source, payload = row["record_id"], row["payload"] or b""
    markup, own = decoded(payload, row["headers"] or ""), digest(payload)
    parts = list(scanned(markup))
    meta = metadata(markup, row["headers"] or "", own, parts).encode()
    text = plain_text(markup, parts).encode()
    ids = {k: derived_id(k, source) for k in ("metadata", "conversion")}
    out = []
    for kind, block, content in (("metadata", meta, "application/warc-fields"),
                                 ("conversion", text, "text/plain; charset=utf-8")):
        fields = [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", row["date"]),
                  ("WARC-Target-URI", row["target_uri"]), ("WARC-Refers-To", source),
                  ("WARC-Refers-To-Target-URI", row["target_uri"]),
                  ("WARC-Refers-To-Date", row["date"])]
        if kind == "conversion":
            fields += [("WARC-Concurrent-To", ids["metadata"]), ("X-Source-Payload-Digest", own)]
        fields += [("X-Source-Key", "" if row["key"] is None else str(row["key"])),
                   ("WARC-Block-Digest", digest(block)), ("Content-Type", content),
                   ("Content-Length", str(len(block)))]
        out.append({"key": row["key"], "type": kind, "record_id": ids[kind], "refers_to": source,
                    "target_uri": row["target_uri"], "date": row["date"],
                    "header": warc_header(fields), "block": block})
    return out


def derivatives(source: DataFrame) -> DataFrame:
    """Two records for each response: key, type, record_id, refers_to,
    target_uri, date, header, block."""

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                rows = [r for x in batch.slice(a, 200).to_pylist() for r in derive_row(x)]
                kinds = pa.schema([(n, pa.int64() if n == "key" else pa.binary() if n == "block"
                                    else pa.string()) for n in rows[0]])
                yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return source.mapInArrow(derive, DERIVED)


def write_warc(records: DataFrame, path: str, level: int = 6) -> DataFrame:
    """Write records (header, block) below ``path``, one gzip member each;
    returns the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _filesystem(path)
        out, name, n = None, None, 0
        for batch in batches:
            heads, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for header, block in zip(heads, blocks):
                if out is None:
                    files.create_dir(folder, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{folder}/{name}", compression=None)
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(member.compress(header.encode() + block + b"\r\n\r\n") + member.flush())
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n]})

    (records.select("header", "block").mapInArrow(write, MANIFEST)
     .write.parquet(f"{path}/manifest"))
    return records.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _members(stream, at_once: int = 1 << 20) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one after another."""
    rest, member, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(at_once)
        if not data:
            return
        parts.append(member.decompress(data))
        rest = member.unused_data
        if member.eof:
            yield b"".join(parts)
            member, parts = zlib.decompressobj(31), []


def parse_record(data: bytes) -> dict:
    """A record's fields; ``sound`` if length, digest and end are as stated."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in lines[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    sound = (lines[0] == "WARC/1.1" and len(block) == n and rest[n:] == b"\r\n\r\n"
             and digest(block) == fields["WARC-Block-Digest"])
    return {"fields": fields, "block": block, "sound": sound}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """key, type, record_id, refers_to, target_uri, payload_digest (the
    source's), block_digest, n_bytes and sound of each record in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _filesystem(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with files.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for data in _members(stream):
                        rows.append(_row(parse_record(data)))
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=KINDS)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=KINDS)

    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    return manifest.repartitionByRange(max(1, manifest.count()), "file").mapInArrow(read, READ)


KINDS = pa.schema([("key", pa.int64()), ("type", pa.string()), ("record_id", pa.string()),
                   ("refers_to", pa.string()), ("target_uri", pa.string()),
                   ("payload_digest", pa.string()), ("block_digest", pa.string()),
                   ("n_bytes", pa.int64()), ("sound", pa.bool_())])
SOURCE_DIGEST = re.compile(rb"^source-payload-digest: (\S+)\r$", re.M)


def _row(record: dict) -> dict:
    fields, block = record["fields"], record["block"]
    source = fields.get("X-Source-Payload-Digest")
    if source is None:
        found = SOURCE_DIGEST.search(block)
        source = found[1].decode() if found else None
    key = fields.get("X-Source-Key")
    return {"key": int(key) if key else None, "type": fields["WARC-Type"],
            "record_id": fields["WARC-Record-ID"], "refers_to": fields.get("WARC-Refers-To"),
            "target_uri": fields["WARC-Target-URI"], "payload_digest": source,
            "block_digest": fields["WARC-Block-Digest"], "n_bytes": len(block),
            "sound": record["sound"]}
