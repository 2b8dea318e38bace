"""Operator 4: SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint takes a majority over the 64-bit hashes of its word
shingles.  Distinct fingerprints within ``max_bits`` differing bits are
linked; a class of near-duplicates is a connected component.

Method: correlated bits are grouped into ``parts`` partitions, from the bit
correlations of all distinct fingerprints.  If thresholds t_i of the
partitions (-1: not probed) satisfy sum(t_i + 1) = max_bits + 1, then any
fingerprint within max_bits differs by t_i or fewer bits in some partition
i.  For each fingerprint, dynamic programming allocates the thresholds that
cost least by the candidate counts which the partitions' histograms give.
Its probes (all values within t_i that occur) meet the fingerprints with
that partition value, and every candidate is verified on all bits.

A partition value may hold a third of all fingerprints, close copies of one
another.  So each value first links its fingerprints to three pivots of
their own, which joins such crowds to components with few links; then a
value's largest component is not compared with itself: probes of its members
meet the other fingerprints only, those of the others meet all.  No pair of
different components is lost, and no crowd is squared.

Histogram, pivots and largest components have at most one row for each
partition value (parts * 2 ** width), which bounds what is broadcast.

Defined results: a NULL text or one without words has fingerprint zero and
is linked like any other; repeated rows and keys keep a row each; a
component whose keys are all NULL has component_id NULL; an empty table
gives an empty result; other columns are ignored or, in ``keep_one``, kept.
Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import stored, text_or_empty
from chainyard.llm.components import components

SEED = 42
BITS = 64
#: Partitions up to so many distinct fingerprints; beyond, wider ones keep
#: the rows of a value few.  The result is the same for any number.
PARTS = ((1 << 23, 4), (1 << 62, 3))
#: Cost of a probe against that of a candidate.
PROBE_COST = 0.05
PIVOTS = 3


def fingerprint(text: str, size: int = 4) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: ASCII letters and blanks alone
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())],
                      "<u8")
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        block = hashes[a:a + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    most = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(most.view("<i8")[0])


def fingerprints(text: Column, size: int = 4) -> Column:
    @F.arrow_udf("bigint")
    def simhash(batch: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, size) for t in batch.to_pylist()], pa.int64())
    return simhash(text)


def bit_groups(distinct: DataFrame, parts: int) -> list[list[int]]:
    """Correlated bits grouped into ``parts`` partitions, from counts of bit
    pairs over all distinct fingerprints."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            raw = batch.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8)
            ones = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            both += ones.T @ ones
            n += len(ones)
        # the diagonal has the counts of ones; one place more has the rows
        yield pa.RecordBatch.from_pydict({"at": np.arange(BITS * BITS + 1),
                                          "n": np.append(both.ravel(), n).astype(np.int64)})

    found = distinct.select("fp").mapInArrow(pairs, "at long, n long")
    counts = np.zeros(BITS * BITS + 1)
    for row in found.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    n, both = max(counts[-1], 1), counts[:-1].reshape(BITS, BITS)
    share = np.diag(both) / n
    cov = both / n - np.outer(share, share)
    spread = np.sqrt(np.maximum(np.outer(np.diag(cov), np.diag(cov)), 1e-12))
    close = np.abs(cov / spread)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = -(-len(left) // (parts - k))
        group = [max(left, key=lambda b: (close[b, left].sum(), -b))]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (close[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def _values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """Each fingerprint's bits of ``group`` as a number."""
    u = fps.view(np.uint64)
    out = np.zeros(len(u), np.int64)
    for k, b in enumerate(group):
        out |= (((u >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)).astype(np.int64)
    return out


class Allocator:
    """Thresholds and probes of fingerprints, from the partitions' histograms."""

    def __init__(self, groups: list[list[int]], histogram: np.ndarray, max_bits: int):
        self.groups, self.max_bits = groups, max_bits
        self.width = max(map(len, groups))
        self.counts = histogram.reshape(len(groups), 1 << self.width)
        #: Largest threshold of a partition; few wide partitions still reach the sum.
        self.most = max(2, -(-(max_bits + 1) // len(groups))) if self.width > 16 else max_bits
        self.cost: list[list[np.ndarray]] | None = None

    def _prepare(self) -> None:
        """cost[i][t]: for each value of partition i, its candidates and probes
        within t bits."""
        self.cost, at = [], np.arange(1 << self.width)
        for i, group in enumerate(self.groups):
            ring = [self.counts[i].astype(np.int64)]
            ring += [np.zeros_like(ring[0]) for _ in range(self.most)]
            for b in range(len(group)):
                flipped = at ^ (1 << b)
                for t in range(self.most, 0, -1):
                    ring[t] = ring[t] + ring[t - 1][flipped]
            total, probes, costs = np.zeros_like(ring[0]), 0, []
            for t in range(self.most + 1):
                total = total + ring[t]
                probes += _choose(len(group), t)
                costs.append((total + PROBE_COST * probes).astype(np.float32))
            self.cost.append(costs)

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        """Row by row the t_i of least cost with sum(t_i + 1) = max_bits + 1."""
        if self.cost is None:
            self._prepare()
        n, need = len(values[0]), self.max_bits + 1
        best = np.full((n, need + 1), np.inf)
        best[:, 0] = 0
        choice = []
        for i, value in enumerate(values):
            own = [np.zeros(n)] + [costs[value] for costs in self.cost[i]]
            new = np.full((n, need + 1), np.inf)
            took = np.zeros((n, need + 1), np.int64)
            for s in range(need + 1):
                for a in range(min(s + 1, len(own))):
                    cost = best[:, s - a] + own[a]
                    less = cost < new[:, s]
                    new[less, s] = cost[less]
                    took[less, s] = a
            best = new
            choice.append(took)
        out, s, row = np.zeros((n, len(values)), np.int64), np.full(n, need), np.arange(n)
        for i in range(len(values) - 1, -1, -1):
            out[:, i] = choice[i][row, s] - 1
            s = s - choice[i][row, s]
        return out

    def probes(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, bucket) of every occurring value to probe."""
        values = [_values(fps, g) for g in self.groups]
        t = self.thresholds(values)
        rows, buckets = [], []
        for i, group in enumerate(self.groups):
            for most in range(self.most + 1):
                own = np.flatnonzero(t[:, i] == most)
                if not len(own):
                    continue
                masks = _masks(len(group), most)
                for a in range(0, len(own), max(1, (1 << 20) // len(masks))):
                    part = own[a:a + max(1, (1 << 20) // len(masks))]
                    near = values[i][part][:, None] ^ masks[None, :]
                    there = self.counts[i][near] > 0
                    r, c = np.nonzero(there)
                    rows.append(part[r])
                    buckets.append((i << self.width) + near[r, c])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(buckets)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _masks(width: int, most: int) -> np.ndarray:
    """All differences of ``most`` bits or fewer."""
    from itertools import combinations
    return np.array([sum(1 << b for b in c) for t in range(most + 1)
                     for c in combinations(range(width), t)], np.int64)


def _buckets(distinct: DataFrame, groups: list[list[int]]) -> DataFrame:
    """bucket for each partition of every row (fp and others)."""
    width = max(map(len, groups))
    fp = F.col("fp")
    values = []
    for i, group in enumerate(groups):
        value = F.lit(i << width)
        for k, b in enumerate(group):
            bit = F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1))
            value = value.bitwiseOR(F.shiftleft(bit.cast("int"), k))
        values.append(value)
    return distinct.withColumn("bucket", F.explode(F.array(*values)))


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def classes(distinct: DataFrame, max_bits: int = 4, parts: int | None = None,
            label: str = "simhash") -> DataFrame:
    """fp and component (the smallest linked fingerprint) for stored, distinct
    fingerprints (column fp, non-null)."""
    n = distinct.count()
    parts = parts or next(p for most, p in PARTS if n <= most)
    groups = bit_groups(distinct, parts)
    width = max(map(len, groups))
    bounded = F.broadcast if width <= 16 else (lambda df: df)  # at most parts << width rows

    index = _buckets(distinct.select("fp"), groups)
    first = [F.min_by("fp", F.xxhash64("fp", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    per_bucket = stored(index.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *first),
                        f"{label}-buckets")
    # crowds: every fingerprint against its buckets' pivots
    pivots = F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)]))
    crowd = per_bucket.filter("n > 1").select("bucket", *[f"p{k}" for k in range(PIVOTS)])
    links = (index.join(bounded(crowd), "bucket").select("fp", pivots.alias("pivot"))
             .filter((F.col("fp") != F.col("pivot")) & (_differ("fp", "pivot") <= max_bits)))
    found = components(links.select(F.col("fp").alias("a"), F.col("pivot").alias("b")),
                       f"{label}-crowd")
    joined = distinct.select("fp").join(found, F.col("fp") == F.col("node"), "left")
    named = stored(joined.select("fp", F.coalesce("component", "fp").alias("component")),
                   f"{label}-named")

    # the rest: probes by allocated thresholds, verified on all bits
    histogram = np.zeros(len(groups) << width, np.int32)
    counts = per_bucket.select("bucket", "n").toArrow()
    histogram[counts.column(0).to_numpy()] = counts.column(1).to_numpy()
    allocator = distinct.sparkSession.sparkContext.broadcast(
        Allocator(groups, histogram, max_bits))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().astype(np.int64)
            own = batch.column(1).to_numpy()
            rows, buckets = allocator.value.probes(fps)
            yield pa.RecordBatch.from_pydict({
                "fp": fps[rows], "component": own[rows], "bucket": buckets.astype(np.int32)})

    probes = named.mapInArrow(probe, "fp long, component long, bucket int")
    here = _buckets(named, groups)
    sizes = here.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = stored(sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("most")), f"{label}-largest")

    def marked(rows: DataFrame) -> DataFrame:
        return (rows.join(bounded(largest), "bucket")
                .withColumn("inside", F.col("component") == F.col("most")).drop("most"))

    # both sides are stored: each is read twice
    probes = stored(marked(probes), f"{label}-probes")
    here = stored(marked(here), f"{label}-index")
    others = here.select("bucket", F.col("fp").alias("fp2"), F.col("component").alias("component2"),
                         F.col("inside").alias("inside2"))
    near = ((F.col("fp") > F.col("fp2")) & (F.col("component") != F.col("component2"))
            & (_differ("fp", "fp2") <= max_bits))
    outside = probes.filter("not inside").join(others, "bucket").filter(near)
    inside = probes.filter("inside").join(others.filter("not inside2"), "bucket").filter(near)
    pairs = (outside.select("component", "component2")
             .unionByName(inside.select("component", "component2")))
    joins = components(pairs.select(F.col("component").alias("a"), F.col("component2").alias("b")),
                       f"{label}-joins")
    joins = joins.withColumnRenamed("component", "root")
    final = named.join(joins, named.component == joins.node, "left")
    return stored(final.select("fp", F.coalesce("root", "component").alias("component")),
                  f"{label}-classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4,
                    max_bits: int = 4, parts: int | None = None) -> DataFrame:
    """key, fingerprint and component_id (the smallest key of the class) of each row."""
    rows = stored(docs.select(F.col(key).alias("k"),
                              fingerprints(text_or_empty(text), size).alias("fp")), "simhash-rows")
    firsts = stored(rows.groupBy("fp").agg(F.min("k").alias("k")), "simhash-distinct")
    found = classes(firsts, max_bits, parts)
    smallest = firsts.join(found, "fp").select("fp", "component", "k")
    ids = stored(smallest.groupBy("component").agg(F.min("k").alias("component_id")),
                 "simhash-ids")
    by_fp = stored(found.join(ids, "component").select("fp", "component_id"), "simhash-by-fp")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(by_fp, "fp").select(F.col("k").alias(key), hexed.alias("fingerprint"),
                                         "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4,
             max_bits: int = 4) -> DataFrame:
    """One row of each class, that with the smallest key (of equal or missing
    keys, the first by place in the input), with all columns of ``docs``."""
    # a place depends on how files are split, which may change from job to job
    # with the number of cores: it is written down once, beside its row
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = stored(docs.select(row.alias("row__"),
                                  F.monotonically_increasing_id().alias("at__")), "simhash-numbered")
    rows = stored(numbered.select(
        F.col("row__")[key].alias("k"), F.col("at__").alias("at"),
        fingerprints(F.coalesce(F.col("row__")[text].cast("string"), F.lit("")), size).alias("fp")),
        "simhash-rows")
    order = F.struct(F.col("k").isNull().alias("missing"), "k", "at")
    firsts = stored(rows.groupBy("fp").agg(F.min(order).alias("one")), "simhash-distinct")
    found = classes(firsts, max_bits)
    kept = (firsts.join(found, "fp").groupBy("component").agg(F.min("one").alias("one"))
            .select(F.col("one.at").alias("at__")))
    # the kept places grow with the input: never broadcast, so that the texts
    # are shuffled once at any size
    kept = stored(kept, "simhash-kept").hint("merge")
    return numbered.join(kept, "at__", "left_semi").select("row__.*")
