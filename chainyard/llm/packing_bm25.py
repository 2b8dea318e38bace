"""Operator 5: packing documents into training sequences with their lexical
neighbours.

Method: documents that share terms are placed together, in shards of bounded
text size.  Terms are token ids, weighed by document frequencies of the whole
input.  A projection of the weighted terms meets centres learned from a sample;
the centres lie on a line on which neighbours are near, and shards are equal
stretches of that line by the exact text size at each centre.  A centre with
more text than a shard (a hot topic, a crowd of copies) is dealt over several
shards by row, so no shard grows with it.

A shard holds a BM25 inverted index over the token ids of its whole documents.
What a document has beyond full windows is its remainder; the longest unused
remainder seeds a window, the index ranks the unused documents for the
seed's terms, and their remainders fill the window in that order.  The one
that overflows is cut, and the rest of it stays unused.  So only the last
window of a shard has padding.  Neighbours that lie in different shards are
not packed together.

The tokenizer is loaded and the centres are learned in tasks: the driver has the
document frequencies by term and the finished centres alone.

Defined results: a NULL text is empty (its
end id alone is packed), repeated rows are packed each, an empty table gives
an empty result, other columns are ignored.  Texts are never cut short: each
id lies in exactly one piece.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.chunk_tokens import encoder
from chainyard.llm.common import stored, text_or_empty
from chainyard.llm.crc32c import ids_crc32

#: Characters of text in a shard, on average.
SHARD_CHARS = 2_000_000
#: BM25's saturation and length normalisation.
K1, B = 1.2, 0.75
#: Share of a shard's documents beyond which a term has a row instead of postings.
DENSE = 0.1
#: Dimensions of the projection, terms of a document that it rests on (those that
#: weigh most), documents of the sample, most ids of each that are learned from,
#: and most centres.
WIDTH, HEAVIEST, SAMPLE, SAMPLE_IDS, CENTRES = 128, 64, 4096, 4096, 1024
ROUNDS = 8
#: Ids whose terms are counted at once, at least one document's.
COUNTED_IDS = 1 << 20

PIECES = ("{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids array<long>")


def counted_terms(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document in order, one after another, their numbers of
    occurrences, and where each document's begin (and the last one's end)."""
    lens = np.array([len(ids) for ids in docs], np.int64)
    flat = np.concatenate(docs)
    narrow = flat.dtype.itemsize <= 2 and len(docs) <= 1 << 16
    kind, shift = (np.uint32, 16) if narrow else (np.uint64, 32)
    # one sort by document and term
    pairs = np.repeat(np.arange(len(docs), dtype=kind) << kind(shift), lens)
    pairs |= flat.astype(kind)
    pairs.sort()
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    pairs, times = pairs[first], np.diff(np.append(first, len(flat)))
    begins = np.searchsorted(pairs, np.arange(len(docs), dtype=kind) << kind(shift))
    return ((pairs & kind((1 << shift) - 1)).astype(np.int64), times,
            np.append(begins, len(pairs)))


def blocks_of(docs: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Runs of documents with some ``COUNTED_IDS`` ids, as their ends."""
    at, ids = 0, 0
    for k, d in enumerate(docs):
        ids += len(d)
        if ids >= COUNTED_IDS:
            yield at, k + 1
            at, ids = k + 1, 0
    if at < len(docs):
        yield at, len(docs)


class Bm25Index:
    """Inverted index of a shard: postings by term, with their BM25 weights.
    Terms of more than ``DENSE`` of the documents are rows of a matrix instead."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray | None = None,
                 mean: float | None = None):
        """``idf`` by term and ``mean`` length of the whole input, else of ``docs``."""
        n = len(docs)
        term, tf, begins = counted_terms(docs)
        self.terms = [term[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
        doc, tf = np.repeat(np.arange(n), np.diff(begins)), tf.astype(np.float64)
        length = np.array([len(ids) for ids in docs], np.float64)
        order = np.argsort(term, kind="stable")
        self.doc, term, tf = doc[order], term[order], tf[order]
        start = np.searchsorted(term, np.arange(int(term[-1]) + 2))
        df = np.diff(start)
        idf = np.log1p((n - df + 0.5) / (df + 0.5)) if idf is None else idf
        norm = K1 * (1 - B + B * length / (mean or length.mean()))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        common = df > DENSE * n
        #: The row of a common term, or -1.
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.common = np.zeros((int(common.sum()), n))
        on = common[term]
        self.common[self.row[term[on]], self.doc[on]] = weight[on]
        self.doc, self.weight = self.doc[~on], weight[~on]
        self.start = np.concatenate(([0], np.cumsum(np.where(common, 0, df))))

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document for the seed's distinct terms."""
        terms = self.terms[seed]
        row = self.row[terms]
        asked = np.zeros(len(self.common))
        asked[row[row >= 0]] = 1.0
        a, b = self.start[terms], self.start[terms + 1]
        size = b - a
        at = np.repeat(a - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        rare = np.bincount(self.doc[at], self.weight[at], len(self.terms))
        return rare + asked @ self.common


class Places:
    """Documents' places on the line of centres, by their weighted terms."""

    def __init__(self, idf: np.ndarray, sample: list[np.ndarray], most: int):
        self.squared = np.square(idf.astype(np.float32))
        self._axes = None
        x = self.vectors(sample)
        rng = np.random.default_rng(1)
        c = x[rng.permutation(len(x))[:max(1, min(most, len(x) // 4))]]
        for _ in range(ROUNDS):
            near = np.argmax(x @ c.T, axis=1)
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(norm > 0, total / np.maximum(norm, 1e-9), c)
        self.centres = c[_line(c, np.arange(len(c)))]

    def __getstate__(self):
        return self.__dict__ | {"_axes": None}

    def vectors(self, docs: list[np.ndarray]) -> np.ndarray:
        if self._axes is None:  # drawn again in each worker: the same numbers
            rng = np.random.default_rng(0)
            self._axes = rng.standard_normal((len(self.squared), WIDTH), np.float32)
        out = np.zeros((len(docs), WIDTH), np.float32)
        for first, end in blocks_of(docs):
            term, tf, begins = counted_terms(docs[first:end])
            tf = tf.astype(np.float32)
            weight = self.squared[term] * tf / (tf + np.float32(K1))
            for k, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist()), first):
                t, w = term[a:b], weight[a:b]
                if b - a > HEAVIEST:
                    most = np.argpartition(w, b - a - HEAVIEST)[b - a - HEAVIEST:]
                    t, w = t[most], w[most]
                out[k] = w @ self._axes[t]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def cells(self, docs: list[np.ndarray]) -> np.ndarray:
        return np.argmax(self.vectors(docs) @ self.centres.T, axis=1)


def _line(c: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places ``at`` in an order that halves them along their main axis."""
    if len(at) < 3:
        return at
    x = c[at] - c[at].mean(axis=0)
    main = np.linalg.eigh(x.T @ x)[1][:, -1]
    order = at[np.argsort(x @ main, kind="stable")]
    half = len(at) // 2
    return np.concatenate([_line(c, order[:half]), _line(c, order[half:])])


def _uniform(rows: np.ndarray) -> np.ndarray:
    """A number in [0, 1) from each row's number (splitmix64)."""
    z = (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def fill_windows(docs: list[np.ndarray], window: int, idf: np.ndarray | None = None,
                 mean: float | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, first id, ids) pieces that hold every id once."""
    out = []
    first = np.array([len(ids) // window * window for ids in docs])
    for d, n in enumerate(first.tolist()):
        out += [[(d, at, window)] for at in range(0, n, window)]
    left = np.array([len(ids) for ids in docs]) - first
    seeds = np.argsort(-left, kind="stable")
    index = Bm25Index(docs, idf, mean)
    for seed in seeds.tolist():
        while left[seed]:
            room, pieces = window, []
            score = index.scores(seed)
            score[seed] = np.inf
            unused = np.flatnonzero(left)
            ranked = unused[np.argsort(-score[unused], kind="stable")]
            for d in ranked.tolist():
                take = min(room, int(left[d]))
                pieces.append((d, int(first[d]), take))
                first[d] += take
                left[d] -= take
                room -= take
                if not room:
                    break
            out.append(pieces)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048,
                   key: str = "doc_id", text: str = "text", with_ids: bool = True,
                   shard_chars: int = SHARD_CHARS) -> DataFrame:
    """A row for each piece: key, start (the document's ids before it), length,
    ids_crc32, doc_tokens, sequence_id, offset within the sequence, and ids."""
    kind = docs.schema[key].dataType.simpleString()
    context = docs.sparkSession.sparkContext

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"dtype": [encoder(tokenizer).dtype.str]})

    # a tokenizer takes some 40 MB: it is loaded in workers, not in the driver
    one = docs.sparkSession.range(1, numPartitions=1)
    dtype = one.mapInArrow(kinds, "dtype string").first()["dtype"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t")
            found = encoder(tokenizer).encode(texts)
            ids = [np.append(x, x.dtype.type(end_id)).tobytes() for x in found]
            yield pa.RecordBatch.from_pydict({
                "k": batch.column("k"), "row": batch.column("row"),
                "chars": pc.add(pc.utf8_length(texts).cast(pa.int64()), 1),
                "ids": pa.array(ids, pa.binary())})

    def arrays(column) -> list[np.ndarray]:
        """Views of a binary column's values; each document has an id at least."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if not len(column):
            return []
        column = column.cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][:len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(dtype)
        ends = ((ends - ends[0]) // data.itemsize).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, sums = np.zeros(1 << 16, np.int64), (0, 0, 0)
        for batch in batches:
            docs = arrays(batch.column("ids"))
            if not docs:
                continue
            for a, b in blocks_of(docs):
                found = np.bincount(counted_terms(docs[a:b])[0], minlength=len(df))
                found[:len(df)] += df
                df = found
            chars = sum(batch.column("chars").to_pylist())
            own = (len(docs), sum(map(len, docs)), chars)
            sums = tuple(a + b for a, b in zip(sums, own))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({
            "term": np.append(at, [-1, -2, -3]).astype(np.int64),
            "n": np.append(df[at], sums).astype(np.int64)})

    numbered = docs.select(F.col(key).alias("k"), text_or_empty(text).alias("t"),
                           F.monotonically_increasing_id().alias("row"))
    coded = stored(numbered.mapInArrow(encode, f"k {kind}, row long, chars long, ids binary"),
                   "packing-ids")
    # as many rows as the vocabulary has terms
    counts = coded.select("chars", "ids").mapInArrow(count, "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).toArrow()
    term, times = (counts.column(c).to_numpy() for c in ("term", "n"))
    n, total, chars = (int(times[term == t].sum()) for t in (-1, -2, -3))
    term, times = term[term >= 0], times[term >= 0]
    df = np.zeros(int(term.max(initial=0)) + 1)
    df[term] = times
    idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)), total / max(n, 1)
    shards = max(1, -(-chars // shard_chars))
    first = np.zeros(2)
    places = None
    if shards > 1:
        width = np.dtype(dtype).itemsize
        order = F.xxhash64("row").alias("h"), F.col("row")
        sample = (coded.orderBy(*order).limit(SAMPLE)
                  .select(*order, F.substring("ids", 1, SAMPLE_IDS * width).alias("ids")))

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(list(batches)).sort_by(
                [("h", "ascending"), ("row", "ascending")])
            made = Places(idf, arrays(rows.column("ids")), min(CENTRES, 4 * shards))
            yield pa.RecordBatch.from_pydict({"places": [pickle.dumps(made)]})

        # one task takes the bounded sample; the driver gets the centres (under 1 MB)
        found = sample.coalesce(1).mapInArrow(learned, "places binary").first()
        places = context.broadcast(pickle.loads(found["places"]))

        def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_pydict({
                    "cell": places.value.cells(arrays(batch.column("ids"))).astype(np.int64),
                    "chars": batch.column("chars")})

        # as many rows as there are centres
        found = coded.select("chars", "ids").mapInArrow(sizes, "cell long, chars long")
        size = np.zeros(len(places.value.centres))
        for r in found.groupBy("cell").agg(F.sum("chars").alias("chars")).collect():
            size[r["cell"]] = r["chars"]
        first = np.append(0, np.cumsum(size)) * (shards / max(chars, 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.zeros(batch.num_rows, np.int64)
            if places is not None:
                cell = places.value.cells(arrays(batch.column("ids")))
                u = _uniform(batch.column("row").to_numpy())
                at = (first[cell] + u * (first[cell + 1] - first[cell])).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "k": batch.column("k"), "row": batch.column("row"), "ids": batch.column("ids"),
                "shard": np.minimum(at, shards - 1)})

    weights = context.broadcast(idf)

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        shard = group.column("shard")[0].as_py()
        keys, ids = group.column("k").to_pylist(), arrays(group.column("ids"))
        rows = []
        for k, pieces in enumerate(fill_windows(ids, window, weights.value, mean)):
            offset = 0
            for d, at, n in pieces:
                own = ids[d][at:at + n]
                rows.append((keys[d], at, n, ids_crc32(own), len(ids[d]),
                             (shard << 32) + k, offset, own.tolist() if with_ids else None))
                offset += n
        names = (key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
        kinds = [group.schema.field("k").type] + [pa.int64()] * 6 + [pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=list(names))

    dealt = coded.select("k", "row", "ids").mapInArrow(
        deal, f"k {kind}, row long, ids binary, shard long")
    return dealt.groupBy("shard").applyInArrow(pack, PIECES.format(key=key, kind=kind))
