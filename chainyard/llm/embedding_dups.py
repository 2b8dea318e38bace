"""Operator 13: near-duplicate vectors by collision-counting projections.

Method: unit vectors are projected on many random directions.  Each
projection is sorted; a vector collides with those that lie in the window
around its own place.  Pairs that collide in enough projections are verified
by their cosine in double precision.

So that no vector meets all others, vectors are compared within buckets: a
table cuts some of the projections near their medians, and vectors on the
same sides share its bucket.  A pair is judged in the first table that puts
both in one bucket.  Three numbers are calibrated on pairs made from a sample
of vectors, each with another at the very limit of similarity: the count
that the share ``TARGET`` of them reach, and the number of tables in which
as many meet.  Tables cut more projections as the input grows, so buckets stay small.

Nothing is emitted by pair: a bucket returns each vector's number of links,
and links that span each of its components.

Equal vectors are one, with a weight.  Crowds of unequal near-copies are
counted by the triangle inequality: the largest buckets give pivots (the mean
direction of a bucket, trimmed and
merged), each vector has its angle to the nearest
one, and two vectors of a pivot whose angles add up to no more than the
limit's are linked without being compared.  How many those are follows from
a histogram of angles for each pivot.  Only vectors near the rim meet the rest; buckets with more
than ``BLOCK`` vectors are compared by pairs of blocks.

Defined results: vectors that are NULL, zero, empty, of another length than
most, or hold NULL or non-finite components link with nothing and stand
alone.  Repeated rows of one id each count as a vector and come out as one
row each; rows without an id come out alone and count for nobody.  An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import stored
from chainyard.llm.components import components
from chainyard.llm.vectors import filled, finite, matrix, usual_length

#: Projections that tables cut, and those of them whose collisions are counted;
#: the window's half width in standard deviations of the difference that two
#: vectors at the limit have along a direction.
PROJECTIONS, COUNTED, WINDOW = 64, 32, 1.2
#: Vectors of a bucket where all are alike, and share of pairs at the limit
#: that tables, and counts, must find.
BUCKET, TARGET = 256, 0.999
#: Vectors the cuts come from, pairs the numbers are calibrated on, most tables.
SAMPLE, TRIALS, TABLES = 4096, 4096, 512
#: Vectors of a block; buckets with more give pivots, of the most crowded of them.
BLOCK, PIVOTS = 4096, 256
#: Steps of an angle up to the limit's in the histograms.
STEPS = 1024
#: Vectors that are compared with a block at once.
AT_ONCE = 256
#: Hot buckets up to which their list (three numbers each) is broadcast.
HOT_LIST = 100_000
#: What angles from rounded cosines are off by, at most.
SLACK = 1e-6


@dataclass
class Projections:
    """Directions, cuts, window, tables and pivots that all tasks share."""

    directions: np.ndarray
    cuts: np.ndarray
    window: float
    least: int
    cosine: float
    tables: list[np.ndarray]
    pivots: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def of(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.directions

    def codes(self, projected: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        sides = (projected >= self.cuts).astype(np.int64)
        out = np.zeros((len(sides), len(self.tables)), np.int64)
        for t, cut in enumerate(self.tables):
            out[:, t] = sides[:, cut] @ (1 << np.arange(len(cut), dtype=np.int64))
        return out

    def places(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot within the limit's angle (-1: none) and the
        angle's step, rounded up, out of ``STEPS`` for the limit."""
        none = np.full(len(unit), -1), np.full(len(unit), STEPS + 1)
        if not len(self.pivots):
            return none
        near = unit @ self.pivots.T
        crowd = near.argmax(axis=1)
        angle = np.arccos(np.clip(near[np.arange(len(unit)), crowd], -1, 1)) + SLACK
        step = np.ceil(angle * (STEPS / math.acos(self.cosine))).astype(np.int64)
        off = step > STEPS
        return np.where(off, -1, crowd), np.where(off, STEPS + 1, step)


def pairs_at_limit(unit: np.ndarray, cosine: float, rng) -> np.ndarray:
    """For each row another unit vector at exactly that cosine."""
    aside = rng.standard_normal(unit.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    other = cosine * unit + math.sqrt(1 - cosine * cosine) * aside
    return other / np.linalg.norm(other, axis=1, keepdims=True)


def cuts(projected: np.ndarray, width: float) -> np.ndarray:
    """Of each projection the value near the median with the fewest rows within
    ``width``, so that a crowd is seldom cut through."""
    places = np.quantile(projected, np.linspace(0.35, 0.65, 31), axis=0)
    out = []
    for line, at in zip(np.sort(projected, axis=0).T, places.T):
        near = np.searchsorted(line, at + width) - np.searchsorted(line, at - width)
        best = np.flatnonzero(near == near.min())
        out.append(at[best[np.abs(best - 15).argmin()]])
    return np.array(out)


def calibrated(sample: np.ndarray, n: int, cosine: float) -> Projections:
    """Directions, count and tables for ``n`` vectors like the sample's."""
    rng = np.random.default_rng(13)
    d = sample.shape[1]
    directions = rng.standard_normal((d, PROJECTIONS))
    directions /= np.linalg.norm(directions, axis=0)
    places = cuts(sample @ directions, math.sqrt(2 - 2 * cosine) / math.sqrt(d))
    own = sample[rng.integers(0, len(sample), TRIALS)]
    a, b = own @ directions, pairs_at_limit(own, cosine, rng) @ directions
    window = WINDOW * float(np.sqrt(np.square(a - b).mean()))
    counts = (np.abs(a - b) <= window)[:, :COUNTED].sum(axis=1)
    least = int(np.quantile(counts, 1 - TARGET, method="lower"))
    found = Projections(directions, places, window, least, cosine, [])
    bits = min(48, max(0, math.ceil(math.log2(max(1, n / BUCKET)))))
    together = (a >= places) == (b >= places)
    met = np.zeros(TRIALS, bool)
    while met.mean() < TARGET and len(found.tables) < TABLES:
        found.tables.append(np.sort(rng.choice(PROJECTIONS, bits, replace=False)))
        met |= together[:, found.tables[-1]].all(axis=1)
    return found


def colliding(projected: np.ndarray, asked: np.ndarray, window: float) -> np.ndarray:
    """The number of projections in which each row lies in the window of each
    of the ``asked`` rows (asked x rows)."""
    counts = np.zeros((len(asked), len(projected)), np.uint8)
    flat = counts.reshape(-1)
    for j in range(projected.shape[1]):
        order = np.argsort(projected[:, j], kind="stable")
        line = projected[order, j]
        low = np.searchsorted(line, asked[:, j] - window, "left")
        size = np.searchsorted(line, asked[:, j] + window, "right") - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        flat[order[at] + np.repeat(np.arange(len(asked)) * len(projected), size)] += 1
    return counts


class Group:
    """Vectors that are compared with each other: those of a bucket, or of two
    of its blocks."""

    def __init__(self, model: Projections, ids: np.ndarray, unit: np.ndarray):
        self.model, self.ids, self.unit = model, ids, unit
        self.projected = model.of(unit)
        self.codes = model.codes(self.projected)
        self.crowd, self.step = model.places(unit)

    def certain(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs that the triangle inequality links."""
        return ((self.crowd[a] == self.crowd[b]) & (self.crowd[a] >= 0)
                & (self.step[a] + self.step[b] <= STEPS))

    def links(self, asked: np.ndarray, table: int, allowed) -> tuple[np.ndarray, np.ndarray]:
        """Verified pairs of ``asked`` places and others: each in the first
        table that has both in one bucket, none that is certain."""
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        counted = self.projected[:, :COUNTED]
        for at in range(0, len(asked), AT_ONCE):
            own = asked[at:at + AT_ONCE]
            counts = colliding(counted, counted[own], self.model.window)
            q, row = np.nonzero(counts >= self.model.least)
            q = own[q]
            on = allowed(q, row)
            q, row = q[on], row[on]
            on = ~self.certain(q, row)
            on &= (self.codes[q, :table] != self.codes[row, :table]).all(axis=1)
            q, row = q[on], row[on]
            for c in range(0, len(q), 65536):
                x, y = q[c:c + 65536], row[c:c + 65536]
                near = (self.unit[x] * self.unit[y]).sum(axis=1) >= self.model.cosine
                a.append(x[near])
                b.append(y[near])
        return np.concatenate(a), np.concatenate(b)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place linked to each place."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _distinct(rows: DataFrame) -> DataFrame:
    """id (a number), v, w (how many) and least (the smallest key) of each
    distinct vector of ``rows`` (k, v)."""
    return (rows.groupBy("v").agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("w"))
            .withColumn("id", F.monotonically_increasing_id()))


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors at length one; scaled first, so that no square leaves the range of doubles."""
    rows = matrix(column)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _apart(centres: np.ndarray, cosine: float) -> np.ndarray:
    """``centres`` without those that lie as near to an earlier one."""
    kept = centres[:0]
    for c in centres:
        if not len(kept) or (kept @ c).max() < cosine:
            kept = np.vstack([kept, c])
    return kept


def _pivots(units: DataFrame, model: Projections) -> np.ndarray:
    """Mean directions of the most crowded buckets of the first table, moved
    twice to the mean of all vectors within half the limit's angle; one of
    those that move together."""
    context, d = units.sparkSession.sparkContext, len(model.directions)
    half = math.cos(math.acos(model.cosine) / 2)
    first = Projections(model.directions, model.cuts, 0, 0, model.cosine, model.tables[:1])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            unit = unit_rows(batch.column(0))
            yield pa.RecordBatch.from_pydict({"code": first.codes(first.of(unit))[:, 0]})

    sizes = units.select("v").mapInArrow(coded, "code long").groupBy("code").count()
    hot = (sizes.filter(F.col("count") > BLOCK).orderBy(F.desc("count"), "code").limit(PIVOTS)
           .toArrow()["code"].to_numpy())
    centres = None
    for _ in range(3 if len(hot) else 0):
        known = context.broadcast((hot, centres))

        def add(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            codes, near = known.value
            total = np.zeros((len(codes) if near is None else len(near), d))
            for batch in filled(batches):
                unit = unit_rows(batch.column(0))
                if near is None:
                    same = first.codes(first.of(unit))[:, 0][:, None] == codes
                    at, on = same.argmax(axis=1), same.any(axis=1)
                else:
                    score = unit @ near.T
                    at, on = score.argmax(axis=1), score.max(axis=1) >= half
                np.add.at(total, at[on], unit[on])
            yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "s": total.ravel()})

        found = units.select("v").mapInArrow(add, "at long, s double")
        sums = np.zeros((len(hot) if centres is None else len(centres)) * d)
        for r in found.groupBy("at").agg(F.sum("s").alias("s")).collect():  # pivots x dimensions
            sums[r["at"]] = r["s"]
        sums = sums.reshape(-1, d)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = _apart((sums / np.maximum(norm, 1e-9))[norm[:, 0] > 1e-9], half)
        if not len(centres):
            break
    return np.zeros((0, d)) if centres is None else centres


def _routed(units: DataFrame, model) -> DataFrame:
    """A row for each vector and table: t, code, core (its pairs with other
    core vectors of the bucket's crowd are certain), id, w, v."""
    kind = units.schema["v"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        n = len(m.tables)
        for batch in filled(batches):
            unit = unit_rows(batch.column(2))
            codes = m.codes(m.of(unit))
            crowd, step = m.places(unit)
            core = np.where(2 * step <= STEPS, crowd, -1)
            at = pa.array(np.repeat(np.arange(len(unit)), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(n, dtype=np.int32), len(unit))), pa.array(codes.ravel()),
                 pa.array(np.repeat(core, n).astype(np.int32)),
                 *[batch.column(c).take(at) for c in range(3)]],
                names=["t", "code", "core", "id", "w", "v"])
    return units.select("id", "w", "v").mapInArrow(route, f"t int, code long, core int, id long, w long, v {kind}")


def _dealt(routed: DataFrame) -> DataFrame:
    """Rows with the groups (part) in which they are compared, and whether they
    are asked there.

    A bucket within a block's size is one group.  Of a larger one, the core
    vectors of its largest crowd are dealt to blocks, and so are the others;
    each block of others is compared with itself and every block after it, and
    with the core's blocks.
    """
    sizes = stored(routed.groupBy("t", "code", "core").agg(F.count(F.lit(1)).alias("n")),
                   "collisions-sizes")
    crowd = F.when(F.col("core") >= 0, F.struct("n", "core"))
    hot = (sizes.groupBy("t", "code").agg(F.sum("n").alias("n"), F.max(crowd).alias("c"))
           .filter(F.col("n") > BLOCK)
           .select("t", "code", F.col("c.core").alias("own"),
                   F.coalesce("c.n", F.lit(0)).alias("n_core"),
                   (F.col("n") - F.coalesce("c.n", F.lit(0))).alias("n_rest")))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    hot = stored(hot.select("t", "code", "own", blocks("n_core").alias("cores"),
                            blocks("n_rest").alias("rests")), "collisions-hot")
    few = hot.count() <= HOT_LIST
    rows = routed.join(F.broadcast(hot) if few else hot, ["t", "code"], "left")
    is_core = F.col("own").isNotNull() & (F.col("core") == F.col("own"))
    block = lambda n: F.pmod(F.xxhash64("id"), F.greatest(F.col(n), F.lit(1))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(
        F.array().cast("array<int>"))
    # part: the asked block, then the block that it is compared with (cores below 0)
    part = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    core_parts = F.transform(upto("rests"), lambda i: part(i, -1 - block("cores")))
    own = block("rests")
    rest_parts = F.concat(
        F.transform(upto("rests"), lambda j: part(F.least(own, j), F.greatest(own, j))),
        F.transform(upto("cores"), lambda j: part(own, -1 - j)))
    parts = (F.when(F.col("rests").isNull(), F.array(part(F.lit(0), F.lit(0))))
             .when(is_core, core_parts).otherwise(rest_parts))
    return (rows.withColumn("block", F.when(is_core, -1 - block("cores")).otherwise(own))
            .select("t", "code", F.explode(parts).alias("part"), "block", "id", "w", "v")
            .select("t", "code", "part.*", F.coalesce("block", F.lit(0)).alias("block"),
                    "id", "w", "v"))


def _links(dealt: DataFrame, model) -> DataFrame:
    """id, links (weights of others linked to it first here) and root (an
    id it is linked to, directly or not)."""
    def compare(group: pa.Table) -> pa.Table:
        m = model.value
        group = group.combine_chunks().sort_by("id")
        ids, w = group["id"].to_numpy(), group["w"].to_numpy()
        i, j, t = (group[c][0].as_py() for c in ("i", "j", "t"))
        block = group["block"].to_numpy()
        g = Group(m, ids, unit_rows(group["v"].combine_chunks()))
        asked = np.flatnonzero(block == i)
        if i == j:  # each pair once
            a, b = g.links(asked, t, lambda q, row: row > q)
        else:
            a, b = g.links(asked, t, lambda q, row: block[row] == j)
        links = np.bincount(a, w[b], len(ids)) + np.bincount(b, w[a], len(ids))
        at = np.flatnonzero(links)
        root = _roots(len(ids), a, b)
        return pa.table({"id": pa.array(ids[at]), "links": pa.array(links[at].astype(np.int64)),
                         "root": pa.array(ids[root[at]])})
    return dealt.groupBy("t", "code", "i", "j").applyInArrow(
        compare, "id long, links long, root long")


def _certain(units: DataFrame, model) -> DataFrame:
    """id, links and root of what the triangle inequality links."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            crowd, step = model.value.places(unit_rows(batch.column(2)))
            on = pa.array(crowd >= 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(crowd), pa.array(step)],
                names=["id", "w", "crowd", "step"]).filter(on)
    placed = stored(units.select("id", "w", "v").mapInArrow(place, "id long, w long, crowd long, step long"),
                    "collisions-crowds")
    # as many rows as pivots times steps
    counts = placed.groupBy("crowd", "step").agg(F.sum("w").alias("n"),
                                                 F.min("id").alias("least")).toArrow()
    crowds, steps, n, least = (counts[c].to_numpy() for c in ("crowd", "step", "n", "least"))
    within = np.zeros((int(crowds.max(initial=-1)) + 1, STEPS + 1), np.int64)
    within[crowds, steps] = n
    within = within.cumsum(axis=1)
    inner = np.full(len(within), np.iinfo(np.int64).max)
    for c in range(len(within)):  # of the innermost step, the smallest id
        own = crowds == c
        inner[c] = least[own][steps[own].argmin()] if own.any() else -1
    first = np.array([steps[crowds == c].min(initial=STEPS + 1) for c in range(len(within))])
    known = units.sparkSession.sparkContext.broadcast((within, inner, first))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within, inner, first = known.value
        for batch in filled(batches):
            ids, w, crowd, step = (batch.column(c).to_numpy() for c in range(4))
            links = within[crowd, STEPS - step] - np.where(2 * step <= STEPS, w, 0)
            root = np.where(first[crowd] + step <= STEPS, inner[crowd], ids)
            yield pa.RecordBatch.from_pydict({"id": ids, "links": links, "root": root})
    return placed.mapInArrow(count, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """key, n_links, component_id and kept of every row."""
    every = vectors.select(F.col(key).cast("bigint").alias("k"), F.col(vector).alias("v"))
    sound = finite("v") & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    sound = sound & F.col("k").isNotNull()
    d = usual_length(every.filter(sound), "v")
    sound = sound & F.coalesce(F.size("v") == d, F.lit(False))
    alone = every.filter(~sound).select("k", F.lit(0).cast("bigint").alias("n_links"),
                                        F.col("k").alias("component_id"))
    out = alone if not d else alone.unionByName(_judged(every.filter(sound), cosine))
    return out.select(F.col("k").alias(key), "n_links", "component_id",
                      F.coalesce(F.col("k") == F.col("component_id"), F.lit(True)).alias("kept"))


def _judged(rows: DataFrame, cosine: float) -> DataFrame:
    """k, n_links and component_id of rows (k, v) with usable vectors."""
    units = stored(_distinct(rows), "collisions-vectors")
    sample = units.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"]
    model = calibrated(unit_rows(sample.combine_chunks()), units.count(), cosine)
    model.pivots = _pivots(units, model)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    found = _links(_dealt(_routed(units, shared)), shared).unionByName(_certain(units, shared))
    found = stored(found, "collisions-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    spans = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "collisions")
    classes = stored(
        units.join(links, "id", "left").join(spans.withColumnRenamed("node", "id"), "id", "left")
        .select("v", "least", F.coalesce("component", "id").alias("c"),
                (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links")),
        "collisions-classes")
    smallest = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "c").select("v", "n_links", "component_id")
    return rows.join(named, "v").select("k", "n_links", "component_id")
