"""Operator 11: embedding whitening by spectrum slicing.

Method: the covariance of all usable vectors is factorized at shifts; the
inertia of each factorization counts the eigenvalues above the shift, until
an interval holds one; Rayleigh quotient iteration converges cubically from
inside, and counts on both sides certify the number (``spectrum``).  Vectors
are then projected on the leading components, each over its standard
deviation.

Vectors become whole numbers first, x = floor(``scale`` * c) + ``shift``.
Counts, sums and the products of what each vector differs by from a whole
number nearest the mean are added exactly, so the covariance does not depend
on the order of rows or on repeated tasks.  Three passes over the vectors:
sums, products, projections; only numbers by dimension and pair of
dimensions reach the driver.  A fourth pass, on request, measures the
covariance of the whitened vectors.

Defined results: vectors that are NULL, empty, of another length than most
or hold NULL or non-finite entries take no part; zero vectors do.  Entries
whose whole number lies beyond 2^45 are taken as that.  Rows are whitened
each, repeated rows and rows without a key too.  Components whose variance is
under 1e-12 of the whole have none, so equal vectors give no components, and
an empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.spectrum import leading
from chainyard.llm.vectors import filled, finite, matrix, usual_length

#: Whole numbers beyond this are taken as this.
BOUND = 1 << 45
#: Sums of squares beyond 38 digits have no value.
DIGITS = 10 ** 38


@dataclass
class Whitening:
    """What is known of the fit list: its count, sums, and components as columns."""

    scale: int
    shift: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = np.floor(self.scale * rows)
        return np.clip(x, -BOUND, BOUND).astype(np.int64) + self.shift

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n times each number less its sum, exactly."""
        x = self.numbers(rows)
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(float) / self.n @ (self.vectors / np.sqrt(self.values))


def squares(centred: np.ndarray) -> list[int]:
    """Each row's exact sum of squares."""
    d, most = centred.shape[1], int(np.abs(centred).max(initial=0))
    if d * most * most < 1 << 62:
        return np.square(centred).sum(axis=1).tolist()
    return np.square(centred.astype(object)).sum(axis=1).tolist()


def products(y: np.ndarray) -> np.ndarray:
    """The exact sums of products of the columns of whole numbers ``y``."""
    most = len(y) * int(np.abs(y).max(initial=0)) ** 2
    if most < 1 << 53:  # every partial sum is exact in doubles
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64)
    return y.T @ y if most < 1 << 62 else y.T.astype(object) @ y.astype(object)


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    return (vectors.filter(finite(vector) & (F.size(vector) > 0))
            .select(F.col(vector).cast("array<double>").alias("v")))


def _exact(numbers) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in numbers], pa.decimal128(38, 0))


def _moments(rows: DataFrame, model: Whitening, d: int, second: bool) -> np.ndarray:
    """Exact sums by dimension, or of products by pair of dimensions, less the
    model's sums, which are then the nearest whole numbers to the means."""
    at = np.arange(d * d) if second else np.arange(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((d, d) if second else d, object), 0
        for batch in filled(batches):
            x = model.numbers(matrix(batch.column(0)))
            x = x - np.array(model.sums, np.int64)
            total = total + (products(x) if second else x.astype(object).sum(axis=0))
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1)), _exact([*total.ravel(), n])], names=["at", "s"])

    found = rows.mapInArrow(add, "at long, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s"))
    out = np.zeros(len(at) + 1, object)
    for r in found.collect():  # as many rows as dimensions, or pairs of them
        out[r["at"]] = int(r["s"])
    return out


def fit_whitening(vectors: DataFrame, components: int = 32, scale: int = 64,
                  shift: int = 1_000_000, vector: str = "embedding") -> Whitening:
    """The covariance's leading components over all usable vectors."""
    rows = _usable(vectors, vector)
    d = usual_length(rows, "v")
    rows = rows.filter(F.size("v") == d)
    model = Whitening(scale, shift, 0, [0] * d, np.zeros(0), np.zeros((d, 0)), 0.0)
    if not d:
        return model
    *sums, n = _moments(rows, model, d, False).tolist()
    middle = [(2 * s + n) // (2 * n) for s in sums]
    model.sums = middle
    *second, _ = _moments(rows, model, d, True).tolist()
    rest = [s - n * c for s, c in zip(sums, middle)]
    # whole numbers over n squared: correctly rounded, as Python divides
    covariance = np.array([[(n * second[i * d + j] - rest[i] * rest[j]) / (n * n)
                            for j in range(d)] for i in range(d)])
    values, axes = leading(covariance, components)
    return Whitening(scale, shift, n, sums, values, axes, float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding"
           ) -> DataFrame:
    """key, deviation (the exact sum of squares of n times each number less its
    sum; NULL beyond 38 digits) and whitened (one number a component)."""
    kind = vectors.schema[key].dataType.simpleString()
    d = len(model.sums)
    rows = (vectors.filter(finite(vector) & (F.size(vector) == d) & (F.size(vector) > 0))
            .select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")))
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            own = shared.value.centred(matrix(batch.column(1)))
            far = [Decimal(int(s)) if s < DIGITS else None for s in squares(own)]
            z = shared.value.whitened(own)
            ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(far, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(ends, pa.array(z.ravel()))],
                names=["k", "deviation", "whitened"])

    out = rows.mapInArrow(project, f"k {kind}, deviation decimal(38,0), whitened array<double>")
    return out.withColumnRenamed("k", key)


def identity_error(whitened: DataFrame, model: Whitening, column: str = "whitened") -> float:
    """The largest entry by which the covariance of the whitened vectors differs
    from the identity, measured over all of them; 0 without components."""
    k = len(model.values)
    if not k:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k + 1, k)), 0
        for batch in filled(batches):
            z = matrix(batch.column(0))
            total += np.vstack([z.T @ z, z.sum(axis=0)])
            n += len(z)
        if n:
            yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "s": total.ravel()})

    found = whitened.select(column).mapInArrow(add, "at long, s double")
    total = np.zeros((k + 1) * k)
    for r in found.groupBy("at").agg(F.sum("s").alias("s")).collect():
        total[r["at"]] = r["s"]
    total = total.reshape(k + 1, k) / model.n
    # the vectors are centred already: their means are rounding errors
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max())
