"""Operator 10: quality classifier by nearest-neighbour voting.

Method: a text's terms are its hashed byte trigrams, its hashed trigrams of
character classes and its kinds of repetition.  Latent-semantic analysis
(truncated SVD of the labelled texts' weighted term matrix) projects every
text to a vector of ``DIMENSIONS``.  The labelled vectors are broadcast;
every text's exact cosines to all of them come from blocked products, and
its ``NEIGHBOURS`` nearest vote with their similarities as weights.

The labelled texts are a bounded sample: of each class the
``MAX_PER_CLASS`` documents with the smallest hash, out of all that may be
learnt from; votes count by how many documents of its class each stands for.  So model and broadcast are bounded whatever the input.
Scoring covers all rows and whole texts.

Defined results: a NULL or empty text scores the labelled share of class 1;
conflicting labels of a document, NULL labels and values other than 0 and 1
teach nothing; rows without a key are never learnt from; repeated rows score
alike; without labels every score is 1 (nothing is rejected); an empty table
gives an empty result; other columns are ignored or, in ``classifier_filter``,
kept.  Labels, language, source and key are no inputs of a score.
"""

from __future__ import annotations

import pickle
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import fresh, text_or_empty

MAX_PER_CLASS = 3000
DIMENSIONS = 48
NEIGHBOURS = 25
#: Sharpness of the similarity weights: a neighbour at cosine c weighs exp(SHARP * (c - 1)).
SHARP = 40.0
#: Score from which a text counts as class 1.
THRESHOLD = 0.3

#: Buckets of byte trigrams and of class trigrams, and kinds of repetition.
BYTES, CLASSES, KINDS = 512, 1024, 4
WIDTH = BYTES + CLASSES + KINDS
#: Bytes of a text that are hashed at once.
STRETCH = 1 << 20


def _classes() -> np.ndarray:
    """Class of each byte: case, digit, blank, line end, each ASCII sign of its
    own, and bytes of other characters."""
    out = np.zeros(256, np.uint32)
    for b in range(256):
        c = chr(b)
        out[b] = (0 if b > 127 else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit()
                  else 4 if c == "\n" else 5 if c.isspace() else b)
    return out


CLASS = _classes()


def _trigrams(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of hashed trigrams."""
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for a in range(0, max(len(codes) - 2, 1), STRETCH):
        c = codes[a:a + STRETCH + 2].astype(np.uint32)
        if len(c) > 2:
            h = ((c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:])
            out += np.bincount((h * np.uint32(2654435769)) >> shift, minlength=buckets)
    return out


def terms(text: str) -> np.ndarray:
    """Square roots of a text's term shares; zeros for an empty text."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    words = data.split()
    out = np.zeros(WIDTH, np.float32)
    if not len(words):
        return out
    for at, n, codes in ((0, BYTES, raw), (BYTES, CLASSES, CLASS[raw])):
        found = _trigrams(codes, n)
        out[at:at + n] = np.sqrt(found / max(int(found.sum()), 1))
    n, lines = len(words), [x for x in data.split(b"\n") if x.strip()]
    triples = max(n - 2, 1)
    out[BYTES + CLASSES:] = np.sqrt([
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0,
        1 - len(set(lines)) / len(lines),
        sum(map(bytes.isupper, words)) / n])
    return out


class Model:
    """Latent vectors of labelled texts, with the projection of others."""

    def __init__(self, matrix: np.ndarray, labels: np.ndarray, shares: np.ndarray | None = None):
        """``shares``: how many documents of its class each row stands for."""
        n = len(matrix)
        shares = np.ones(n) if shares is None else shares
        self.prior = float(labels @ shares / shares.sum()) if n else 1.0
        self.empty = n == 0
        if self.empty:
            return
        df = (matrix > 0).sum(axis=0)
        self.weight = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
        weighted = matrix * self.weight
        values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
        self.projection = np.ascontiguousarray(vectors[:, ::-1][:, :DIMENSIONS], np.float32)
        self.vectors, known = self._latent(weighted)
        self.vectors, self.labels = self.vectors[known], labels[known].astype(np.float64)
        self.shares = shares[known]
        self.empty = not known.any()

    def _latent(self, weighted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        latent = weighted @ self.projection
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        return latent / np.maximum(norm, 1e-12), norm[:, 0] > 1e-12

    def score(self, matrix: np.ndarray) -> np.ndarray:
        if self.empty or not len(matrix):
            return np.full(len(matrix), self.prior)
        latent, known = self._latent(matrix * self.weight)
        cosine = latent @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.exp(SHARP * (np.take_along_axis(cosine, near, 1).astype(np.float64) - 1))
        weight = weight * self.shares[near]
        vote = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.where(known, vote, self.prior)


def held_out(key: str) -> Column:
    """Rows that are never learnt from: one fifth by the key's CRC-32, and
    rows without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str
                    ) -> tuple[DataFrame, dict[int, int]]:
    """label and text of at most ``MAX_PER_CLASS`` documents of each class, and how
    many documents each class has."""
    agreed = (labels.filter(F.col(label).isin(0, 1) & ~held_out(key))
              .groupBy(F.col(key).alias("k")).agg(F.min(label).alias("y"), F.max(label).alias("z"))
              .filter("y = z").select("k", "y"))
    there = agreed.join(docs.select(F.col(key).alias("k")), "k", "left_semi")
    order = (F.xxhash64("k"), F.col("k"))
    chosen = [there.filter(F.col("y") == y).orderBy(*order).limit(MAX_PER_CLASS) for y in (0, 1)]
    both = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * MAX_PER_CLASS rows
    texts = docs.select(F.col(key).alias("k"), text_or_empty(text).alias("t"))
    # a repeated key teaches one text
    classes = {r["y"]: r["count"] for r in there.groupBy("y").count().collect()}
    return texts.join(both, "k").groupBy("k", "y").agg(F.min("t").alias("t")), classes


def _trained(batches: list[pa.RecordBatch], classes: dict[int, int]) -> Model:
    """The model of batches of key, label and terms, in the order of the keys."""
    order, found = [], []
    for b in batches:
        k, y, x = b.columns
        order += zip(k.to_pylist(), y.to_pylist(), range(len(found), len(found) + len(b)))
        found += x
    order.sort()
    matrix = np.empty((len(order), WIDTH), np.float32)
    for i, (_, _, at) in enumerate(order):
        matrix[i] = np.frombuffer(found[at].as_buffer(), np.float32)
    y = np.array([c for _, c, _ in order], np.float64)
    # each sampled text stands for as many as its class has for each of the sample,
    # so that the classes weigh alike at every size of the input
    shares = np.array([classes[int(c)] / (y == c).sum() for c in y])
    return Model(matrix, y, shares)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> Model:
    """The model of the labelled documents."""

    @F.arrow_udf("binary")
    def term_bytes(batch: pa.Array) -> pa.Array:
        return pa.array([terms(t).tobytes() for t in batch.to_pylist()], pa.binary())

    sample, classes = labelled_sample(docs, labels, key, text, label)

    def trained(batches):
        model = _trained([b for b in batches if b.num_rows], classes)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    # one task takes the bounded sample: its terms and the algebra on them (some
    # 200 MB) stay out of the driver, which gets the finished model
    rows = sample.select("k", "y", term_bytes("t").alias("x"))
    made = rows.repartition(1).mapInArrow(trained, "model binary").collect()
    return pickle.loads(made[0].model) if made else _trained([], classes)


def scores(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """The score of each row's text, with the model broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        texts = batch.to_pylist()
        found = [shared.value.score(np.stack([terms(t) for t in texts[a:a + 500]]))
                 for a in range(0, len(texts), 500)]
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return score(text_or_empty(text))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "quality") -> DataFrame:
    """key, held_out, score and predicted of each row."""
    model = fit(docs, labels, key, text, label)
    return (docs.select(F.col(key), held_out(key).alias("held_out"),
                        scores(model, docs, text).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def classifier_filter(docs: DataFrame, learn_from: DataFrame, labels: DataFrame,
                      key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted class 1, with all their columns; the
    model is learnt from ``learn_from``."""
    model, s = fit(learn_from, labels, key, text), fresh(docs, "score__")
    wide = docs.withColumn(s, scores(model, docs, text))
    return wide.filter(F.col(s) >= THRESHOLD).drop(s)
