"""Operator 9: quality rules with robust multivariate outliers.

Method: each text gives word statistics; base rules fail short and highly
repetitive texts.  For what passes, the statistics are transformed to a
vector, and minimum-covariance-determinant estimates for each language and
source give its Mahalanobis distance; a vector beyond the cutoff is
rejected.

The estimates cover all rows, as Spark aggregates: two deterministic starts
(median and MAD; correlation of tanh scores) are each improved by
concentration steps -- distances of all rows, their h-quantile, mean and
covariance of the rows within it -- and the start whose covariance has the
smaller determinant is taken.  Every variance is at least its floor, since most
clean texts have no symbols or repeated lines at all; the floors are small, so
that each component can reject a text alone.  The cutoff is the chi-square
quantile of a stated level.  A language
and source of fewer than ``MIN_ROWS`` passing rows takes its language's
estimates, a language of so few rows those of all rows.  Sums by group
combine before the shuffle, so a hot source is no hot task.  Quantiles are
Spark's approximate ones and sums are of doubles: both depend on the order in
which partial results meet, in their last digits, so a text whose distance is
that near the cutoff may be judged differently by another run.

Defined results: a NULL text has no words and fails the base rules; NULL
language or source is a group of its own; repeated rows are judged alike; an
empty table gives an empty result; other columns are ignored or, in
``quality_filter``, kept.  Texts are never cut.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import fresh, stored, text_or_empty
from chainyard.llm.text_stats import NAMES, statistics

#: Share of a group's rows that the estimates rest on.
COVERAGE = 0.75
#: Concentration steps from each start.
STEPS = 5
#: Rows a group needs for estimates of its own.
MIN_ROWS = 60
#: Share of normal vectors that are rejected.
LEVEL = 1e-6
#: Groups up to which their estimates are broadcast (about 1 kB each).
BROADCAST_GROUPS = 10_000
#: Smallest standard deviation of each component, in its own unit: 5 % of a word's
#: length, a symbol in 100 words, two repeated lines in three of these, 6 % of the
#: words repeated, a quarter more or fewer words.
FLOORS = (0.05, 0.01, 0.5, 0.06, 0.25)
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]

ESTIMATES = "g string, start int, det double, mean array<double>, precision array<double>"


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``name`` of the texts' statistics, computed once
    a row: filters on them stay above the function."""

    @F.arrow_udf(", ".join(f"{n} long" for n in NAMES))
    def stats(batch: pa.Array) -> pa.Array:
        found = np.array([statistics(t) for t in batch.to_pylist()], np.int64).reshape(-1, 5)
        return pa.StructArray.from_arrays([pa.array(c) for c in found.T], list(NAMES))

    return docs.withColumn(name, stats.asNondeterministic()(text_or_empty(text)))


def base_failed(s: str, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    words = F.col(f"{s}.n_words")
    return ((words < min_words)
            | (100 * F.col(f"{s}.n_repeat_words") > max_repeat_percent * words))


def vector(s: str) -> list[Column]:
    """Transformed statistics of a text; NULLs where it has no words."""
    words = F.nullif(F.col(f"{s}.n_words"), F.lit(0)).cast("double")
    return [F.log(F.col(f"{s}.word_chars") / words),
            F.log1p(F.col(f"{s}.n_symbols") / words),
            F.log1p(F.col(f"{s}.n_dup_lines").cast("double")),
            F.col(f"{s}.n_repeat_words") / words,
            F.log(words)]


#: Places at which the chi-square distribution of P components is tabulated.
_GRID = np.linspace(0, 100, 200_001)
_DENSITY = _GRID ** (P / 2 - 1) * np.exp(-_GRID / 2) / (2 ** (P / 2) * math.gamma(P / 2))
_STEP = float(_GRID[1] - _GRID[0])


def chi_square_cutoff(level: float) -> float:
    """The squared distance beyond which a share ``level`` of normal vectors lies."""
    beyond = np.cumsum(_DENSITY[::-1])[::-1] * _STEP
    return float(_GRID[np.argmax(beyond <= level)])


def _consistency(share: float) -> float:
    """Factor by which the covariance of a normal vector's inner ``share``
    falls short, for P components."""
    inside = _GRID <= chi_square_cutoff(1 - share)
    return share * P / float((_DENSITY * _GRID)[inside].sum() * _STEP)


def _distance(mean: str, precision: str) -> Column:
    """Squared Mahalanobis distance of x0.. from array columns of estimates."""
    d = [F.col(f"x{i}") - F.col(mean)[i] for i in range(P)]
    terms = [F.col(precision)[k] * d[i] * d[j] * (1.0 if i == j else 2.0)
             for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _moments(x: list[Column]) -> list[Column]:
    return ([F.count(F.lit(1)).alias("n")]
            + [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
            + [F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in PAIRS])


def _estimates(frame: pd.DataFrame, scale: np.ndarray, start: np.ndarray | None,
               factor: float, center: np.ndarray | None = None) -> pd.DataFrame:
    """Mean and precision of each row's moments, times ``scale`` by component."""
    n = frame["n"].to_numpy(float)[:, None]
    mean = frame[[f"s{i}" for i in range(P)]].to_numpy(float) / n
    cov = np.zeros((len(frame), P, P))
    for i, j in PAIRS:
        cov[:, i, j] = cov[:, j, i] = (frame[f"q{i}{j}"].to_numpy(float) / n[:, 0]
                                       - mean[:, i] * mean[:, j])
    cov = cov * factor * scale[:, :, None] * scale[:, None, :]
    diagonal = np.arange(P)
    cov[:, diagonal, diagonal] = np.maximum(cov[:, diagonal, diagonal], np.square(FLOORS))
    inverse = np.linalg.inv(cov)
    return pd.DataFrame({
        "g": frame["g"], "start": frame["start"] if start is None else start,
        "det": np.linalg.det(cov), "mean": list(mean if center is None else center),
        "precision": [[m[i, j] for i, j in PAIRS] for m in inverse]})


def _start_estimates(rows: DataFrame, bounded) -> DataFrame:
    """Both starts of each group: 0 from median and MAD, 1 from the correlation
    of tanh scores."""
    x = [F.col(f"x{i}") for i in range(P)]
    median = rows.groupBy("g").agg(*[F.percentile_approx(c, 0.5).alias(f"m{i}")
                                     for i, c in enumerate(x)])
    off = rows.join(bounded(median), "g")
    mad = off.groupBy("g").agg(*[
        F.greatest(F.percentile_approx(F.abs(x[i] - F.col(f"m{i}")), 0.5) * 1.4826, F.lit(FLOORS[i]))
        .alias(f"d{i}") for i in range(P)])
    score = [F.tanh((x[i] - F.col(f"m{i}")) / F.col(f"d{i}")) for i in range(P)]
    first = [F.first(f"{k}{i}").alias(f"{k}{i}") for k in "md" for i in range(P)]
    moments = off.join(bounded(mad), "g").groupBy("g").agg(*_moments(score), *first)

    def starts(frames):
        for f in frames:
            center = f[[f"m{i}" for i in range(P)]].to_numpy(float)
            scale = f[[f"d{i}" for i in range(P)]].to_numpy(float)
            alone = f.copy()
            for i, j in PAIRS:
                alone[f"q{i}{j}"] = f["n"] if i == j else 0.0
            for i in range(P):
                alone[f"s{i}"] = 0.0
            zero = np.zeros(len(f), int)
            yield _estimates(alone, scale, zero, 1.0, center)
            yield _estimates(f, scale, zero + 1, 1.0, center)

    return moments.mapInPandas(starts, ESTIMATES)


def _concentrated(rows: DataFrame, estimates: DataFrame, factor: float, bounded) -> DataFrame:
    """One concentration step for all groups and starts."""
    far = (rows.join(bounded(estimates), "g").withColumn("far", _distance("mean", "precision"))
           .select("g", "start", "far", *[f"x{i}" for i in range(P)]))
    within = far.groupBy("g", "start").agg(F.percentile_approx("far", COVERAGE).alias("reach"))
    inner = far.join(bounded(within), ["g", "start"]).filter("far <= reach")
    moments = inner.groupBy("g", "start").agg(*_moments([F.col(f"x{i}") for i in range(P)]))

    def step(frames):
        for f in frames:
            yield _estimates(f, np.ones((len(f), P)), None, factor)

    return moments.mapInPandas(step, ESTIMATES)


def group_key(lang: str, source: str) -> Column:
    """A text for each language and source, NULLs included."""
    return F.concat(F.lit("source "), F.to_json(F.struct(F.col(lang).alias("l"),
                                                         F.col(source).alias("s"))))


def fit(passing: DataFrame, label: str = "mcd") -> DataFrame:
    """Estimates (own, mean, precision) for every group ``own`` of ``passing``,
    whose rows are own, parent (the language's key) and x0..x4."""
    sizes = stored(passing.groupBy("own", "parent").agg(F.count(F.lit(1)).alias("n")),
                   f"{label}-sizes")
    parents = sizes.groupBy("parent").agg(F.sum("n").alias("of_parent"))
    used = F.when(F.col("n") >= MIN_ROWS, F.col("own")).when(
        F.col("of_parent") >= MIN_ROWS, F.col("parent")).otherwise(F.lit("all"))
    takes = stored(sizes.join(parents, "parent").select("own", used.alias("g")),
                   f"{label}-takes")
    # estimates of so few groups are broadcast, so that no hot group is joined
    # or counted in one task; those of more meet the rows by a shuffle
    few = takes.count() <= BROADCAST_GROUPS
    bounded = F.broadcast if few else (lambda df: df)
    levels = F.explode(F.array("own", "parent", F.lit("all")))
    x = [f"x{i}" for i in range(P)]
    rows = stored(passing.select(levels.alias("g"), *x)
                  .join(takes.select("g").distinct(), "g", "left_semi"), f"{label}-rows")
    factor = _consistency(COVERAGE)
    estimates = stored(_start_estimates(rows, bounded), f"{label}-start")
    for _ in range(STEPS):
        estimates = stored(_concentrated(rows, estimates, factor, bounded), f"{label}-step")
    best = estimates.groupBy("g").agg(
        F.min_by(F.struct("mean", "precision"), F.struct("det", "start")).alias("e"))
    return stored(takes.join(best, "g").select("own", "e.mean", "e.precision"), f"{label}-fit")


def _passing(rows: DataFrame, s: str, lang: str, source: str) -> DataFrame:
    named = [c.alias(f"x{i}") for i, c in enumerate(vector(s))]
    return rows.filter(~base_failed(s)).select(
        group_key(lang, source).alias("own"),
        F.concat(F.lit("lang "), F.to_json(F.struct(F.col(lang).alias("l")))).alias("parent"),
        *named)


def _judged(rows: DataFrame, estimates: DataFrame, s: str, kept: str, failed: str,
            lang: str, source: str) -> DataFrame:
    """``rows`` with the verdicts; what fails the base rules needs no estimates."""
    own, columns = fresh(rows, "own__"), rows.columns
    x = [c.alias(f"x{i}") for i, c in enumerate(vector(s))]
    all_ = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row__")
    wide = rows.select(all_, group_key(lang, source).alias(own), base_failed(s).alias("failed__"),
                       *x)
    found = wide.join(estimates.withColumnRenamed("own", own), own, "left")
    near = F.coalesce(_distance("mean", "precision") <= chi_square_cutoff(LEVEL), F.lit(False))
    return found.select("row__.*", F.col("failed__").alias(failed),
                        (~F.col("failed__") & near).alias(kept))


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  lang: str = "lang", source: str = "source") -> DataFrame:
    """key, the statistics, base_failed and kept of each row."""
    slim = docs.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(source).alias("s"),
                       F.col(text).alias("t"))
    rows = stored(with_statistics(slim, "st", "t").drop("t"), "op9-stats")
    estimates = fit(_passing(rows, "st", "l", "s"))
    judged = _judged(rows, estimates, "st", "kept", "base_failed", "l", "s")
    return judged.select(F.col("k").alias(key), "st.*", "base_failed", "kept")


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    The statistics are computed for the estimates and again for the verdicts,
    once a row each time: texts are read twice and never shuffled.
    """
    s = fresh(docs, "stats__")
    wide = with_statistics(docs, s, text)
    estimates = fit(_passing(wide.select(lang, source, s), s, lang, source))
    judged = _judged(wide, estimates, s, fresh(docs, "kept__"), fresh(docs, "failed__"),
                     lang, source)
    return judged.filter(F.col(fresh(docs, "kept__"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
