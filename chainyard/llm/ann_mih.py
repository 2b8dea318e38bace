"""Operator 3: approximate nearest neighbours by multi-index hashing.

Method: vectors get binary codes of ``BITS`` bits from learned rotations
(principal axes, then iterative quantization from two starts).  A code is
split into ``SUBSTRINGS`` substrings and each block of rows has an index of
every substring's values.  If two codes differ in r bits or fewer, then by
the pigeonhole principle some substring differs in its share of r or fewer;
probing each substring's index with that share therefore retrieves every
code within the radius.  Candidates are verified on the whole code and
reranked by the inner product of the original vectors in double precision.

Largest inner product is turned into an angle: a vector gets one component
more, which fills its length up to the longest, a query's is zero.

The rotations are learned on at most ``SAMPLE`` vectors (those with the
smallest hash).  The radius comes from at most ``TRIALS`` queries (likewise)
whose exact neighbours among *all* rows are found first: it covers the share
``TARGET`` of their code distances.  Every row is indexed.  A query that
finds fewer than k rows within the radius is searched again over all codes.

Queries meet rows in blocks of bounded size, and a block pair returns k rows
for each query at most.  Defined results: vectors that are NULL, zero, of
another length than most, or hold NULL or non-finite components take no
part, nor do rows without an id; a query's own id is no candidate; equal
scores go by the smaller id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainyard.llm.common import stored

BITS, SUBSTRINGS = 128, 4
SAMPLE, TRIALS, TARGET = 4096, 128, 0.96
#: Rows and queries of a block, on average.
ROWS, QUERIES = 4096, 1024
#: Queries that are compared at once.
AT_ONCE = 64

FOUND = "query_id long, vec_id long, score double"


class Rotations:
    """Codes of vectors: signs along learned rotations of the principal axes."""

    def __init__(self, sample: np.ndarray, longest: float):
        self.longest = longest
        rows = self.lifted(sample)
        self.mean = rows.mean(axis=0)
        centred = rows - self.mean
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :64]
        own = centred @ axes
        turns = []
        for seed in range(-(-BITS // axes.shape[1])):
            rng = np.random.default_rng(seed)
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(20):
                u, _, v = np.linalg.svd(np.where(own @ turn > 0, 1.0, -1.0).T @ own)
                turn = (u @ v).T
            turns.append(axes @ turn)
        self.turn = np.concatenate(turns, axis=1)[:, :BITS]

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes all equally long."""
        rows = rows / self.longest
        rest = np.sqrt(np.maximum(1 - np.square(rows).sum(axis=1, keepdims=True), 0))
        return np.concatenate([rows, rest], axis=1)

    def codes(self, lifted: np.ndarray) -> np.ndarray:
        """Packed codes, 16 bytes each."""
        return np.packbits((lifted - self.mean) @ self.turn > 0, axis=1)

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        return self.codes(self.lifted(rows))

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        return self.codes(np.concatenate([unit, np.zeros((len(rows), 1))], axis=1))


class SubstringIndex:
    """A block's codes by the values of each substring."""

    def __init__(self, codes: np.ndarray):
        self.whole = np.ascontiguousarray(codes).view("<u8")
        parts = np.ascontiguousarray(codes).view("<u4")
        self.values, self.holders = zip(*[np.unique(parts[:, j], return_inverse=True)
                                          for j in range(SUBSTRINGS)])

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of every pair that differs in ``radius`` bits or fewer."""
        queries = np.ascontiguousarray(queries)
        parts, whole = queries.view("<u4"), queries.view("<u8")
        share, more = divmod(radius, SUBSTRINGS)
        candidate = np.zeros((len(queries), len(self.whole)), bool)
        for j in range(SUBSTRINGS):
            # the first substrings take one bit of the remainder each
            most = share if j <= more else share - 1
            if most >= 0:
                near = np.bitwise_count(parts[:, j, None] ^ self.values[j][None, :]) <= most
                candidate |= near[:, self.holders[j]]
        q, row = np.nonzero(candidate)
        bits = np.bitwise_count(whole[q] ^ self.whole[row]).sum(axis=1)
        inside = bits <= radius
        return q[inside], row[inside]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, each summed in the same order."""
    return (a * b).sum(axis=1)


def best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k largest scores, ties by the smaller id."""
    order = np.lexsort((ids, -scores, q))
    q = q[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else q
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, v (doubles) of the rows that take part."""
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    return (vectors.select(F.col(key).cast("bigint").alias("vec_id"),
                           F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & sound & nonzero))


def _block(n: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")


def _coded(rows: DataFrame, model, queries: bool) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column(1))
                own = model.value.of_queries(m) if queries else model.value.of_rows(m)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(list(map(bytes, own)), pa.binary())],
                    names=["vec_id", "v", "code"])
    return rows.mapInArrow(code, "vec_id long, v array<double>, code binary")


def _trial_radius(rows: DataFrame, queries: DataFrame, k: int) -> int:
    """The radius that covers the share TARGET of the trial queries' exact neighbours."""
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRIALS).toArrow()
    ids, vectors = chosen["vec_id"].to_numpy(), _matrix(chosen["v"])
    codes = _bytes(chosen["code"])
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors, codes))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own, own_codes = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            there, m = batch.column(0).to_numpy(), _matrix(batch.column(1))
            score = own @ m.T
            score[own_ids[:, None] == there[None, :]] = -np.inf
            few = min(k, len(there))
            near = np.argpartition(-score, few - 1, axis=1)[:, :few]
            q = np.repeat(np.arange(len(own_ids)), few)
            bits = np.bitwise_count(own_codes[q] ^ _bytes(batch.column(2))[near.ravel()]).sum(axis=1)
            got = score[q, near.ravel()]
            on = np.isfinite(got)
            yield pa.RecordBatch.from_pydict({"q": own_ids[q][on], "score": got[on],
                                              "bits": bits[on].astype(np.int64)})

    found = rows.mapInArrow(exact, "q long, score double, bits long")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))
    nearest = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    radius = nearest.agg(F.percentile("bits", F.lit(TARGET))).first()[0]
    return BITS if radius is None else int(np.ceil(radius))


def _search(rows: DataFrame, queries: DataFrame, radius: int, k: int, n: int, n_queries: int
            ) -> DataFrame:
    """query_id, vec_id, score: each query's k best within the radius in each
    block of rows."""
    row_blocks, query_blocks = max(1, -(-n // ROWS)), max(1, -(-n_queries // QUERIES))
    left = (rows.withColumn("rb", _block(row_blocks))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.withColumn("qb", _block(query_blocks))
             .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))))

    def match(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if block.num_rows and asked.num_rows:
            ids, own_ids = block["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
            vectors, own = _matrix(block["v"]), _matrix(asked["v"])
            index, codes = SubstringIndex(_bytes(block["code"])), _bytes(asked["code"])
            for a in range(0, len(own_ids), AT_ONCE):
                q, row = index.within(codes[a:a + AT_ONCE], radius)
                other = own_ids[a + q] != ids[row]
                q, row = q[other] + a, row[other]
                score = np.concatenate([np.zeros(0)] + [
                    inner(vectors[row[b:b + 16384]], own[q[b:b + 16384]])
                    for b in range(0, len(row), 16384)])
                at = best(q, ids[row], score, k)
                out["query_id"].append(own_ids[q[at]])
                out["vec_id"].append(ids[row[at]])
                out["score"].append(score[at])
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(v) if v else [], kinds[c])
                         for c, v in out.items()})

    keys = ["rb", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(match, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest found."""
    spark = vectors.sparkSession
    usable = stored(_usable(vectors, key, vector), "mih-usable")
    size = F.size("v")
    lengths = usable.groupBy(size.alias("n")).agg(F.count(F.lit(1)).alias("c"))
    most = lengths.orderBy(F.desc("c"), "n").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.filter(size == most.n)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    longest = usable.agg(F.max(norm)).first()[0]
    sample = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    model = spark.sparkContext.broadcast(Rotations(_matrix(sample["v"]), longest))

    rows = stored(_coded(usable, model, False), "mih-rows")
    asked = stored(_coded(usable.filter(is_query), model, True), "mih-queries")
    n_queries = asked.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    radius = _trial_radius(rows, asked, k)
    found = stored(_ranked(_search(rows, asked, radius, k, most.c, n_queries), k), "mih-found")
    # a query with fewer rows within the radius is searched over all codes
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("c"))
    full = full.filter(F.col("c") >= min(k, most.c - 1)).select(F.col("query_id").alias("vec_id"))
    short = stored(asked.join(full, "vec_id", "left_anti"), "mih-short")
    n_short = short.count()
    if n_short:
        again = _ranked(_search(rows, short, BITS, k, most.c, n_short), k)
        kept = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
        found = kept.unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
