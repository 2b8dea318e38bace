"""Operator 8: token ids as length-delimited binary records.

Method: each sequence is serialized and framed as

    length (u64) | masked CRC-32C of length (u32) | payload | masked CRC-32C of payload (u32)

all little-endian, and every record file has a separate index file with the
offset (u64) of each frame and of the end, so that a reader can fetch
records in any order.  A payload is a flag byte, the document's key (i64)
and the ids (u16, or u32 for vocabularies over 65,536).

Files are numbered in ascending key order (rows without a key first), from
a range partitioning.  A task writes under a name of its own attempt; the
manifest that Spark's committer publishes names the files that count, so
lost executors and repeated attempts leave at most unnamed files.

Defined results: a NULL text is empty and keeps its end id; repeated keys
keep one record each, ordered by text; an empty table gives a manifest
without files; other columns are ignored.  Texts are never cut.

Reads are in order (``read_token_records``), by place (``fetch_token_records``)
or in an order drawn from a seed (``read_shuffled``); the last two fetch single
records by the index files.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainyard.llm.chunk_tokens import encoder
from chainyard.llm.common import text_or_empty
from chainyard.llm.crc32c import crc32c, ids_crc32, masked

#: Flag bits of a payload.
NO_KEY, WIDE = 1, 2
HEAD = struct.Struct("<Bq")
#: Bytes that a reader holds of a record file at once, at least one record.
READ_BYTES = 8 << 20

MANIFEST = "shard long, records string, offsets string, n_records long, n_ids long"
FETCHED = "shard long, record long, {key} long, n_tokens long, ids binary"
READ_BACK = ("shard long, record long, {key} long, start long, n_tokens long, ids_crc32 long, "
             "ids binary")


def _filesystem(path: str):
    """The file system and the path within it of a folder's address."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def serialize(key: int | None, ids: np.ndarray) -> bytes:
    flags = (NO_KEY if key is None else 0) | (WIDE if ids.dtype.itemsize == 4 else 0)
    return HEAD.pack(flags, key or 0) + ids.tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, key = HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=HEAD.size)
    return None if flags & NO_KEY else key, ids


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    a, b = masked(crc32c(lengths)), masked(crc32c(payloads))
    return [n + x.tobytes() + p + y.tobytes() for n, x, p, y in zip(lengths, a, payloads, b)]


def unframe(data: bytes, offsets: np.ndarray) -> list[bytes]:
    """Payloads of the frames at ``offsets`` (the last is the end) of ``data``;
    a wrong length or checksum raises."""
    lengths, payloads, sums = [], [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        lengths.append(data[a:a + 8])
        payloads.append(data[a + 12:b - 4])
        sums.append(data[a + 8:a + 12] + data[b - 4:b])
    want = np.frombuffer(b"".join(sums), "<u4").reshape(-1, 2)
    found = np.stack([masked(crc32c(lengths)), masked(crc32c(payloads))], axis=1)
    sizes = np.frombuffer(b"".join(lengths), "<u8")
    if not np.array_equal(want, found) or [len(p) for p in payloads] != sizes.tolist():
        raise ValueError("a record's length or checksum does not match its frame")
    return payloads


def write_token_records(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                        key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every text, each with ``end_id``, below ``path``;
    returns the manifest: a row for each record file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        out, name, offsets, n_ids, at = None, None, [0], 0, 0
        files, folder = _filesystem(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(folder, recursive=True)
                name = f"{shard:06d}-{uuid.uuid4().hex[:12]}"
                out = files.open_output_stream(f"{folder}/{name}.rec")
            found = encoder(tokenizer).encode(batch.column(1))
            ids = [np.append(x, x.dtype.type(end_id)) for x in found]
            for frame in frames(list(map(serialize, batch.column(0).to_pylist(), ids))):
                out.write(frame)
                at += len(frame)
                offsets.append(at)
            n_ids += sum(map(len, ids))
        if out is not None:
            out.close()
            with files.open_output_stream(f"{folder}/{name}.idx") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "shard": [shard], "records": [f"{name}.rec"], "offsets": [f"{name}.idx"],
                "n_records": [len(offsets) - 1], "n_ids": [n_ids]})

    # the text's hash orders repeated keys, so that ranges can split them
    rows = docs.select(F.col(key).cast("bigint").alias("k"), text_or_empty(text).alias("t"))
    ranged = rows.repartitionByRange("k", F.xxhash64("t"))
    ordered = ranged.sortWithinPartitions("k", F.xxhash64("t"), "t")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return manifest(docs.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_records(spark: SparkSession, path: str, key: str = "doc_id",
                       with_ids: bool = True) -> DataFrame:
    """Read all records back and verify them: shard, record (its place there),
    key, start (the ids of all records before it), n_tokens, ids_crc32 and the
    ids as little-endian bytes (or NULL).

    Files follow one another in key order, so a file's start is a running sum
    over the manifest, which has a row for each file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_stream(f"{folder}/{row['offsets']}") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                with files.open_input_file(f"{folder}/{row['records']}") as f:
                    first, start = 0, row["start"]
                    while first < len(offsets) - 1:
                        after = np.searchsorted(offsets, offsets[first] + READ_BYTES, "right") - 1
                        after = max(int(after), first + 1)
                        own = offsets[first:after + 1]
                        f.seek(int(own[0]))
                        data = f.read(int(own[-1] - own[0]))
                        got = [parse(p) for p in unframe(data, own - own[0])]
                        sizes = np.array([len(x) for _, x in got], np.int64)
                        ends = start + np.cumsum(sizes)
                        yield pa.RecordBatch.from_pydict({
                            "shard": pa.array([row["shard"]] * len(got), pa.int64()),
                            "record": pa.array(range(first, after), pa.int64()),
                            key: pa.array([k for k, _ in got], pa.int64()),
                            "start": pa.array(ends - sizes), "n_tokens": pa.array(sizes),
                            "ids_crc32": pa.array([ids_crc32(x) for _, x in got], pa.int64()),
                            "ids": pa.array([x.tobytes() if with_ids else None for _, x in got],
                                            pa.binary())})
                        first, start = after, int(ends[-1])

    before = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    shards = manifest(spark, path).withColumn("start", F.coalesce(before, F.lit(0)))
    # a shard's row is tiny, its file is not: a partition for each of the files
    return (shards.repartitionByRange(max(1, shards.count()), "shard")
            .mapInArrow(read, READ_BACK.format(key=key)))


def fetch_token_records(pairs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The records at the places (shard, record) of ``pairs``, verified: shard,
    record, key, n_tokens and the ids as little-endian bytes.

    A place that is asked for twice is returned twice; other columns are ignored.
    A place that holds no record, or is NULL, raises.
    """
    files = manifest(pairs.sparkSession, path).select("shard", "records", "offsets", "n_records")
    asked = pairs.select(F.col("shard").cast("bigint").alias("shard"),
                         F.col("record").cast("bigint").alias("record"))
    return asked.join(files, "shard", "left").mapInArrow(_fetcher(path, key),
                                                         FETCHED.format(key=key))


def read_shuffled(spark: SparkSession, path: str, seed: int, key: str = "doc_id") -> DataFrame:
    """Every record once, as ``fetch_token_records``, in an order drawn from the
    seed: partitions are ranges of a hash of seed and place, rows within follow it."""
    places = manifest(spark, path).withColumn(
        "record", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_records") - 1)))
    draw = F.xxhash64(F.lit(seed).cast("bigint"), "shard", "record")
    drawn = places.repartitionByRange(draw, "shard", "record").sortWithinPartitions(
        draw, "shard", "record")
    return drawn.select("shard", "record", "records", "offsets", "n_records").mapInArrow(
        _fetcher(path, key), FETCHED.format(key=key))


def _fetcher(path: str, key: str):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _filesystem(path)

        def read(names: list[str], at: np.ndarray, size: np.ndarray) -> list[bytes]:
            """A stretch of each named file; a file is opened once."""
            out: list[bytes] = [b""] * len(names)
            by_name: dict[str, list[int]] = {}
            for i, name in enumerate(names):
                by_name.setdefault(name, []).append(i)
            for name, own in by_name.items():
                with files.open_input_file(f"{folder}/{name}") as f:
                    for i in own:
                        out[i] = f.read_at(int(size[i]), int(at[i]))
            return out

        for batch in batches:
            rows = batch.to_pydict()
            for shard, record, n in zip(rows["shard"], rows["record"], rows["n_records"]):
                if n is None or record is None or not 0 <= record < n:
                    raise ValueError(f"no record {record} in shard {shard}")
            if not batch.num_rows:
                continue
            place = np.array(rows["record"], np.int64) * 8
            ends = read(rows["offsets"], place, np.full(len(place), 16))
            ends = np.frombuffer(b"".join(ends), "<u8").astype(np.int64).reshape(-1, 2)
            size = ends[:, 1] - ends[:, 0]
            first = 0
            while first < len(size):
                after = first + max(1, int(np.searchsorted(np.cumsum(size[first:]), READ_BYTES, "right")))
                part = slice(first, after)
                data = read(rows["records"][part], ends[part, 0], size[part])
                got = [parse(p) for p in unframe(b"".join(data), np.append(0, np.cumsum(size[part])))]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(rows["shard"][part], pa.int64()),
                    "record": pa.array(rows["record"][part], pa.int64()),
                    key: pa.array([k for k, _ in got], pa.int64()),
                    "n_tokens": pa.array([len(x) for _, x in got], pa.int64()),
                    "ids": pa.array([x.tobytes() for _, x in got], pa.binary())})
                first = after

    return fetch
