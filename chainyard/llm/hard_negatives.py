"""Operator 12: hard-negative mining by angular triangle filtering.

Method: every vector stores its angles to a few reference directions.  By the
triangle inequality the angle between two vectors is at least the largest
difference of their angles to a reference, and at most the smallest sum, so
two stored rows of angles give an interval for the cosine, and with both norms
bounds for the score, widened by more than rounding can take.  Only rows whose
bounds overlap what an anchor looks for are scored, in whole numbers.

Rows lie in blocks of neighbours: by nearest reference, then by angle to
it.  A block is known by its ranges of angles, norms and labels, and an
anchor is copied to the blocks alone whose ranges can hold what it looks for:

1. An anchor's neighbours in its own block give a first floor for the score of
   its positives.
2. In each block that may reach the floor, rows of its label whose bounds do
   are scored; the best of all blocks are its positives.
3. Each positive's score gives a window of scores for its negatives.  In each
   block that overlaps one, rows of other labels whose bounds do are scored.

Rows are shuffled once to form the blocks and once for each search, whatever
the number of anchors; blocks that many anchors visit are copied to several
tasks.  Within a task a block is in memory and the anchors pass by in batches.

Vectors become whole numbers floor(``scale`` * c), taken as +-2^27 beyond that,
so that a score of up to 512 components fits a long.  Defined results: rows
whose id, label or vector is NULL, or whose vector is empty, of another length
than most or holds NULL or non-finite components, take no part.  A row is no
partner of rows with its own id; repeated rows otherwise count as a row each,
as anchors too.  Equal scores go by the smaller id.  Zero vectors score 0.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainyard.llm.ann_mih import best
from chainyard.llm.common import stored
from chainyard.llm.vectors import filled, finite, matrix, usual_length

#: Largest whole number of a component.
BOUND = 1 << 27
#: Reference directions, and vectors that they are chosen from.
REFERENCES, SAMPLE = 16, 2048
#: Rows of a block on average, until there are MOST_BLOCKS; their ranges, some
#: 150 bytes a block, are broadcast.
ROWS, MOST_BLOCKS = 16_384, 65_536
#: Neighbours on each side that give an anchor's first floor.
BESIDE = 256
#: Anchors that a copy of a block meets on average, and at once.
ASKS, AT_ONCE = 100_000, 64
#: What stored angles are off by, at most (they are single precision).
SLACK = 1e-5
#: Below every score.
NONE = -(1 << 62)

ROW = ("no long, block int, id long, label long, x array<int>, angles array<float>, norm double, "
       "anchor boolean, floor long")
PAIR = "no long, anchor_id long, positive_id long, score long"
FOUND = ("no long, anchor_id long, positive_id long, place int, positive_score long, "
         "negative_id long, negative_score long")


def whole_numbers(rows: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * rows), -BOUND, BOUND).astype(np.int32)


def references(sample: np.ndarray) -> np.ndarray:
    """Directions of the sample far from each other: each the one whose
    nearest chosen direction is farthest; one axis if all are zero."""
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    unit = unit[np.abs(unit).max(axis=1) > 0]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(REFERENCES, len(unit)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles_to(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles (single precision; of zero vectors, right ones) and norms."""
    rows = x.astype(float)
    norm = np.linalg.norm(rows, axis=1)
    cosine = rows @ refs.T / np.maximum(norm, 1e-300)[:, None]
    return np.arccos(np.clip(cosine, -1, 1)).astype(np.float32), norm


def score_bounds(nearest: np.ndarray, farthest: np.ndarray, low: np.ndarray, high: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores at angles from ``nearest`` to ``farthest`` with
    products of norms from ``low`` to ``high``, widened beyond rounding."""
    top = np.cos(np.clip(nearest - SLACK, 0, math.pi).astype(float))
    least = np.cos(np.clip(farthest + SLACK, 0, math.pi).astype(float))
    most = np.where(top >= 0, high, low) * top
    fewest = np.where(least >= 0, low, high) * least
    wide = high * 1e-9 + 1
    return fewest - wide, most + wide


def pair_angles(asked: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest angles (asked x rows) by the triangle inequality."""
    nearest = np.zeros((len(asked), len(angles)), np.float32)
    farthest = np.full_like(nearest, math.pi)
    for own, column in zip(asked.T, angles.T):
        np.maximum(nearest, np.abs(own[:, None] - column), out=nearest)
        total = own[:, None] + column
        np.minimum(farthest, np.minimum(total, np.float32(2 * math.pi) - total), out=farthest)
    return nearest, farthest


def scores(x: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Exact inner products (asked x rows) of whole numbers."""
    most = (x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(asked).max(initial=0)))
    if most < 1 << 53:  # every partial sum is exact in doubles
        return (asked.astype(float) @ x.T.astype(float)).astype(np.int64)
    return asked.astype(np.int64) @ x.T.astype(np.int64)


class Ranges:
    """What is known of each block."""

    def __init__(self, rows: list, n_refs: int):
        rows = sorted(rows, key=lambda r: r["block"])
        self.blocks = np.array([r["block"] for r in rows], np.int32)
        self.low = np.array([[r[f"a{i}"] for i in range(n_refs)] for r in rows], np.float32)
        self.high = np.array([[r[f"b{i}"] for i in range(n_refs)] for r in rows], np.float32)
        self.norms = np.array([(r["n0"], r["n1"]) for r in rows])
        self.labels = np.array([(r["l0"], r["l1"]) for r in rows], np.int64)

    def bounds(self, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of an anchor with any row of each block."""
        nearest = np.maximum(angles - self.high, self.low - angles).max(axis=1)
        farthest = np.minimum(angles + self.high, 2 * math.pi - angles - self.low).min(axis=1)
        return score_bounds(np.maximum(nearest, 0), farthest, norm * self.norms[:, 0],
                            norm * self.norms[:, 1])


class Block:
    """The rows of a block."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        self.ids, self.labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        self.x = matrix(rows["x"].combine_chunks()).astype(np.int32)
        self.angles = matrix(rows["angles"].combine_chunks()).astype(np.float32)
        self.norm = rows["norm"].to_numpy()

    def scored(self, asks: pa.RecordBatch, same: bool, low: np.ndarray, high: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ask, row, score) of rows of the ask's label, or of others, whose
        bounds overlap from ``low`` to ``high``."""
        ids, label = asks["id"].to_numpy(), asks["label"].to_numpy()
        nearest, farthest = pair_angles(matrix(asks["angles"]).astype(np.float32), self.angles)
        product = asks["norm"].to_numpy()[:, None] * self.norm
        least, most = score_bounds(nearest, farthest, product, product)
        on = (most >= low[:, None]) & (least <= high[:, None])
        on &= (label[:, None] == self.labels) == same
        on &= ids[:, None] != self.ids
        used = np.flatnonzero(on.any(axis=0))
        found = scores(self.x[used], matrix(asks["x"]).astype(np.int64))
        q, row = np.nonzero(on[:, used])
        return q, used[row], found[q, row]


def _usable(vectors: DataFrame, is_anchor: Column, key: str, label: str, vector: str) -> DataFrame:
    rows = vectors.select(F.col(key).cast("bigint").alias("id"),
                          F.col(label).cast("bigint").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite("v")
                       & (F.size("v") > 0))


def _blocks(rows: DataFrame, refs: np.ndarray, scale: int, n: int, positives: int) -> DataFrame:
    """The rows with their angles, dealt to blocks and numbered; anchors with
    the floor that neighbours of their block give."""
    shared = rows.sparkSession.sparkContext.broadcast(refs)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filled(batches):
            x = whole_numbers(matrix(batch.column(2)), scale)
            angles, norm = angles_to(x, shared.value)
            cell = angles.argmin(axis=1)
            ends = lambda m: pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(ends(x), pa.array(x.ravel())),
                 pa.ListArray.from_arrays(ends(angles), pa.array(angles.ravel())), pa.array(norm),
                 batch.column(3), pa.array(cell.astype(np.int32)),
                 pa.array(angles[np.arange(len(x)), cell])],
                names=["id", "label", "x", "angles", "norm", "anchor", "cell", "angle"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId()
        parts = list(filled(batches))
        if not parts:
            return
        own = Block(parts)
        rows = pa.Table.from_batches(parts).combine_chunks()
        floor = np.full(len(own.ids), NONE)
        for at in np.flatnonzero(rows["anchor"].to_numpy()).tolist():
            near = slice(max(0, at - BESIDE), at + BESIDE + 1)
            on = (own.labels[near] == own.labels[at]) & (own.ids[near] != own.ids[at])
            if on.sum() >= positives:
                found = scores(own.x[near][on], own.x[at:at + 1])[0]
                floor[at] = np.sort(found)[-positives]
        out = rows.select(["id", "label", "x", "angles", "norm", "anchor"])
        out = out.add_column(0, "block", pa.array(np.full(len(rows), block, np.int32)))
        out = out.add_column(0, "no", pa.array((block << 36) + np.arange(len(rows))))
        yield from out.append_column("floor", pa.array(floor)).to_batches(1000)

    kind = ("id long, label long, x array<int>, angles array<float>, norm double, anchor boolean, "
            "cell int, angle float")
    size = max(ROWS, -(-n // MOST_BLOCKS))
    place = ["cell", "angle", "id"]
    dealt = (rows.select("id", "label", "v", "anchor").mapInArrow(measure, kind)
             .repartitionByRange(max(1, -(-n // size)), *place).sortWithinPartitions(*place))
    return stored(dealt.mapInArrow(number, ROW), "angles-blocks")


def _ranges(blocks: DataFrame, n_refs: int) -> Ranges:
    of = lambda i: F.col("angles")[i]
    each = [f(of(i)).alias(f"{c}{i}") for i in range(n_refs) for f, c in ((F.min, "a"), (F.max, "b"))]
    found = blocks.groupBy("block").agg(
        *each, F.min("norm").alias("n0"), F.max("norm").alias("n1"), F.min("label").alias("l0"),
        F.max("label").alias("l1"))
    return Ranges(found.collect(), n_refs)  # MOST_BLOCKS rows at most, or one a partition


def _asks(anchors: DataFrame, ranges, same: bool, label: str) -> DataFrame:
    """A row for each anchor and block that may hold what it looks for, scores
    from one of ``low`` to the ``high`` of its place."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranges.value
        for batch in filled(batches):
            angles = matrix(batch["angles"]).astype(np.float32)
            labels, norm = batch["label"].to_numpy(), batch["norm"].to_numpy()
            low, high = batch["low"].to_pylist(), batch["high"].to_pylist()
            at, to = [], []
            for k in range(batch.num_rows):
                least, most = known.bounds(angles[k], norm[k])
                on = np.zeros(len(known.blocks), bool)
                for a, b in zip(low[k], high[k]):
                    on |= (most >= a) & (least <= b)
                if same:
                    on &= (known.labels[:, 0] <= labels[k]) & (labels[k] <= known.labels[:, 1])
                else:
                    on &= (known.labels != labels[k]).any(axis=1)
                found = known.blocks[on]
                at.append(np.full(len(found), k))
                to.append(found)
            out = batch.take(pa.array(np.concatenate(at)))
            place = batch.schema.get_field_index("block")
            yield out.set_column(place, "block", pa.array(np.concatenate(to)))
    return stored(anchors.mapInArrow(route, anchors.schema), label)


def _search(blocks: DataFrame, asks: DataFrame, match, out: str) -> DataFrame:
    """``match(block, asks)`` for batches of the asks of each block."""
    # a block that many ask is copied to several tasks; as many rows as blocks
    copies = asks.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(ASKS)).cast("int").alias("copies"))
    copies = F.broadcast(copies)
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in asks.schema
             if f.name not in blocks.columns]
    rows = (blocks.join(copies, "block").select(
        *[F.col(c) for c in blocks.columns], *empty,
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind")))
    asked = (asks.join(copies, "block").withColumn(
        "copy", F.pmod(F.xxhash64("no"), F.col("copies")).cast("int")).drop("copies")
        .withColumn("kind", F.lit(1)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in filled(batches):
            place = list(zip(batch["block"].to_pylist(), batch["copy"].to_pylist(),
                             batch["kind"].to_pylist()))
            cut = [0, *[i for i in range(1, len(place)) if place[i] != place[i - 1]], len(place)]
            for a, b in zip(cut, cut[1:]):
                own = batch.slice(a, b - a)
                if place[a][:2] != key:
                    key, parts, block = place[a][:2], [], None
                if place[a][2] == 0:
                    parts.append(own)
                elif parts:
                    block = block or Block(parts)
                    for c in range(0, own.num_rows, AT_ONCE):
                        yield from match(block, own.slice(c, AT_ONCE))

    both = rows.unionByName(asked)
    n = blocks.select("block").distinct().count()
    return (both.repartition(max(1, n), "block", "copy")
            .sortWithinPartitions("block", "copy", "kind", "no").mapInArrow(scan, out))


def _first(rows: DataFrame, keys: list[str], score: str, key: str, most: int, name: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc(score), key)
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= most)


def hard_negatives(vectors: DataFrame, is_anchor: Column, scale: int = 256, positives: int = 5,
                   negatives: int = 5, low: int = 80, high: int = 100, key: str = "vec_id",
                   label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score: for each anchor's ``positives`` best rows of its label, the
    ``negatives`` best rows of other labels with a score from ``low`` to ``high``
    percent of the positive's."""
    spark = vectors.sparkSession
    rows = stored(_usable(vectors, is_anchor, key, label, vector), "angles-usable")
    d = usual_length(rows, "v")
    rows = rows.filter(F.size("v") == d)
    columns = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
               "negative_score long")
    if not d:
        return spark.createDataFrame([], columns)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()["v"]
    refs = references(whole_numbers(matrix(sample.combine_chunks()), scale).astype(float))
    blocks = _blocks(rows, refs, scale, rows.count(), positives)
    ranges = spark.sparkContext.broadcast(_ranges(blocks, len(refs)))
    anchors = blocks.filter("anchor").withColumns({
        "low": F.array("floor"), "high": F.array(F.lit(1 << 62))})

    def near(block: Block, asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        floor = asks["floor"].to_numpy()
        q, row, score = block.scored(asks, True, floor, np.full(len(floor), 1 << 62))
        on = score >= floor[q]
        q, row, score = q[on], row[on], score[on]
        at = best(q, block.ids[row], score, positives)
        yield pa.RecordBatch.from_pydict({
            "no": asks["no"].to_numpy()[q[at]], "anchor_id": asks["id"].to_numpy()[q[at]],
            "positive_id": block.ids[row[at]], "score": score[at]})

    found = _search(blocks, _asks(anchors, ranges, True, "angles-asks"), near, PAIR)
    chosen = _first(stored(found, "angles-near"), ["no"], "score", "positive_id", positives, "place")
    # exact: decimals of two places, wider than any score
    share = lambda percent: F.col("score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    ceil, floor = F.ceil(share(low)).cast("bigint"), F.floor(share(high)).cast("bigint")
    wanted = chosen.withColumns({"a": ceil, "b": floor}).filter("a <= b")
    # each anchor's positives, as many as asked for at most
    wanted = wanted.groupBy("no").agg(F.sort_array(F.collect_list(
        F.struct("place", "positive_id", "score", "a", "b"))).alias("p"))
    seeking = (blocks.filter("anchor").join(wanted, "no").select(
        *blocks.columns, F.col("p.place").alias("places"), F.col("p.positive_id").alias("positive_ids"),
        F.col("p.score").alias("positive_scores"), F.col("p.a").alias("low"), F.col("p.b").alias("high")))

    def far(block: Block, asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = [asks[c].to_pylist() for c in ("places", "positive_ids", "positive_scores", "low", "high")]
        low_, high_ = (np.array([f(v) for v in lists[k]]) for f, k in ((min, 3), (max, 4)))
        q, row, score = block.scored(asks, False, low_, high_)
        no, ids = asks["no"].to_numpy(), asks["id"].to_numpy()
        for k in range(max(map(len, lists[0]))):
            has = np.array([len(v) > k for v in lists[0]])
            place, pid, own, a, b = (np.array([v[k] if len(v) > k else 0 for v in c]) for c in lists)
            on = has[q] & (score >= a[q]) & (score <= b[q])
            x, y, s = q[on], row[on], score[on]
            first = best(x, block.ids[y], s, negatives)
            x, y, s = x[first], y[first], s[first]
            yield pa.RecordBatch.from_pydict({
                "no": no[x], "anchor_id": ids[x], "positive_id": pid[x],
                "place": place[x].astype(np.int32), "positive_score": own[x],
                "negative_id": block.ids[y], "negative_score": s})

    found = _search(blocks, _asks(stored(seeking, "angles-seeking"), ranges, False, "angles-windows"),
                    far, FOUND)
    last = _first(found, ["no", "place"], "negative_score", "negative_id", negatives, "rank")
    return last.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                       "negative_id", "positive_score", "negative_score")
