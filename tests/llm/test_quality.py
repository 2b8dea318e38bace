"""Quality rules and classifier: statistics by a plain count, estimates and
votes by numpy, verdicts on the labelled table."""

import collections
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainyard.llm import queries as Q
from chainyard.llm import quality_rules_mcd as M
from chainyard.llm.quality_knn import Model, WIDTH, classifier_filter, classify, fit, terms
from chainyard.llm.text_stats import statistics

from .conftest import SMALL, TEXTS, rows


def slow_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {t for t, n in collections.Counter(triples).items() if n > 1}
    covered = {i + k for i, t in enumerate(triples) if t in often for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_statistics():
    rng = np.random.default_rng(0)
    texts = [t or "" for t in TEXTS] + [
        "".join(rng.choice(list("ab \n#é"), rng.integers(0, 80))) for _ in range(500)]
    for t in texts:
        assert statistics(t) == slow_statistics(t), t


def test_quality_rules_of_odd_rows(spark, docs, no_docs, clashing):
    for df in (docs, clashing):
        got = M.quality_rules(df).collect()
        want = collections.Counter()
        for r in rows():
            s = slow_statistics(r[1] or "")
            want[(r[0], *s, s[0] < 50 or 100 * s[4] > 50 * s[0])] += 1
        assert collections.Counter(tuple(r)[:7] for r in got) == want
        assert not any(r.kept and r.base_failed for r in got)
        kept = M.quality_filter(df)
        assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    assert M.quality_rules(no_docs).count() == 0
    assert M.quality_filter(no_docs).count() == 0


def test_quality_rules_keep_clean_and_reject_junk(spark):
    got = Q.op9_quality_rules(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    both = got.join(labels, "doc_id").toPandas()
    passed = both[~both.base_failed]
    assert passed[passed.quality == 1].kept.all()
    assert not passed[passed.quality == 0].kept.any()


def slow_mcd(x, factor):
    """Both starts and the concentration steps of one group, by numpy."""
    def floored(cov):
        return cov + np.diag(np.maximum(np.square(M.FLOORS) - np.diag(cov), 0))

    rank = lambda v, q: np.sort(v)[max(int(np.ceil(q * len(v))) - 1, 0)]
    median = np.array([rank(c, 0.5) for c in x.T])
    scale = np.array([max(rank(abs(c - m), 0.5) * 1.4826, f)
                      for c, m, f in zip(x.T, median, M.FLOORS)])
    score = np.tanh((x - median) / scale)
    starts = [np.diag(scale ** 2),
              floored(np.cov(score.T, bias=True) * np.outer(scale, scale))]
    found = []
    for cov in starts:
        mean = median
        for _ in range(M.STEPS):
            d = ((x - mean) @ np.linalg.inv(cov) * (x - mean)).sum(axis=1)
            inner = x[d <= rank(d, M.COVERAGE)]
            mean, cov = inner.mean(axis=0), floored(np.cov(inner.T, bias=True) * factor)
        found.append((np.linalg.det(cov), mean, np.linalg.inv(cov)))
    return min(found, key=lambda f: f[0])[1:]


def test_estimates_equal_a_plain_computation_by_group(spark):
    rng = np.random.default_rng(1)
    frames = []
    for own, parent, n in (("a", "p", 300), ("b", "p", 20), ("c", "q", 10)):
        x = rng.normal(size=(n, M.P)) * [0.2, 0.1, 1, 0.3, 1] + (5 if own == "c" else 0)
        x[: n // 10] += 30  # outliers
        frames.append(pd.DataFrame(x, columns=[f"x{i}" for i in range(M.P)])
                      .assign(own=own, parent=parent))
    every = pd.concat(frames)
    got = {r.own: r for r in M.fit(spark.createDataFrame(every)).collect()}
    cols = [f"x{i}" for i in range(M.P)]
    # a has estimates of its own, b those of its language, c those of all rows
    for own, part in (("a", every[every.own == "a"]), ("b", every[every.parent == "p"]), ("c", every)):
        mean, precision = slow_mcd(part[cols].to_numpy(), M._consistency(M.COVERAGE))
        np.testing.assert_allclose(got[own]["mean"], mean, rtol=1e-6)
        np.testing.assert_allclose(got[own]["precision"], [precision[i, j] for i, j in M.PAIRS],
                                   rtol=1e-5, atol=1e-6)


def test_verdicts_equal_a_plain_computation_on_the_table(spark):
    """kept of the registered query, from numpy's estimates of every group."""
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    stats = np.array([slow_statistics(t or "") for t in frame.text], float)
    words = np.maximum(stats[:, 0], 1)
    failed = (stats[:, 0] < 50) | (100 * stats[:, 4] > 50 * stats[:, 0])
    x = np.c_[np.log(np.maximum(stats[:, 1], 1) / words), np.log1p(stats[:, 2] / words),
              np.log1p(stats[:, 3]), stats[:, 4] / words, np.log(words)]
    own = (frame.lang.fillna("none") + "/" + frame.source.fillna("none")).to_numpy()
    lang = frame.lang.fillna("none").to_numpy()
    want, far, factor = {}, {}, M._consistency(M.COVERAGE)
    for g in set(own[~failed]):
        mine = ~failed & (own == g)
        base = mine
        if base.sum() < M.MIN_ROWS:
            base = ~failed & (lang == g.split("/")[0])
        if base.sum() < M.MIN_ROWS:
            base = ~failed
        mean, precision = slow_mcd(x[base], factor)
        d = ((x[mine] - mean) @ precision * (x[mine] - mean)).sum(axis=1)
        far.update(zip(frame.doc_id[mine], d))
    cutoff = M.chi_square_cutoff(M.LEVEL)
    got = Q.op9_quality_rules(spark, SMALL).toPandas().set_index("doc_id")
    assert (got.base_failed.loc[frame.doc_id].to_numpy() == failed).all()
    clear = {k for k, d in far.items() if abs(d - cutoff) > 1e-3 * cutoff}
    assert len(clear) >= len(far) - 2
    assert all(got.kept.loc[k] == (far[k] <= cutoff) for k in clear)
    assert not got.kept.loc[frame.doc_id[failed]].any()


def test_each_component_rejects_alone(spark):
    """Texts that stand out in one statistic only, within the base limits."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(4000)]

    def plain(n):
        return list(rng.choice(vocabulary, n, replace=False))

    texts = {k: " ".join(plain(int(rng.integers(120, 320)))) for k in range(300)}
    lines = [" ".join(plain(10)) for _ in range(10)]
    planted = {
        "lines": "\n".join(lines + [w for w in plain(40) for _ in range(2)]),
        "repeats": " ".join(plain(110) + (part := plain(40)) + part),
        "symbols": " ".join(plain(180) + ["#$#"] * 1 + [f"#{w}$" for w in plain(20)]),
        "long words": " ".join(w + w for w in plain(190)),
        "length": " ".join(vocabulary),
    }
    for k, t in enumerate(planted.values()):
        texts[1000 + k] = t
        s = slow_statistics(t)
        assert s[0] >= 50 and 100 * s[4] <= 50 * s[0]
    docs = spark.createDataFrame([(k, t, "en", "a") for k, t in texts.items()],
                                 "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in M.quality_rules(docs).collect()}
    assert all(kept[k] for k in range(300))
    assert not any(kept[1000 + k] for k in range(len(planted)))


def test_cutoff_is_the_quantile_of_five_components():
    # 99.9 %, 99 % and 50 % points of the chi-square distribution, from its tables
    for level, point in ((0.001, 20.515), (0.01, 15.086), (0.5, 4.351)):
        assert abs(M.chi_square_cutoff(level) - point) < 0.002


def test_consistency_factor():
    """The inner part's variance times the factor is the whole's."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400_000, M.P))
    d = np.square(x).sum(axis=1)
    inner = x[d <= np.quantile(d, 0.75)]
    assert abs(inner.var() * M._consistency(0.75) - 1) < 0.01


def auc(good, bad):
    return np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])


def test_held_out_accuracy(spark):
    got = Q.op10_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    want = [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]
    assert got.held_out.tolist() == want
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    both = got[got.held_out].merge(labels, on="doc_id")
    good, bad = (both[both.quality == q].score.to_numpy() for q in (1, 0))
    assert len(bad) > 5 and auc(good, bad) > 0.97
    assert (good >= 0.3).mean() > 0.98


def test_votes_equal_a_plain_computation():
    rng = np.random.default_rng(0)
    x = rng.random((200, WIDTH)).astype(np.float32)
    y = (rng.random(200) > 0.3).astype(float)
    model = Model(x, y)
    q = rng.random((20, WIDTH)).astype(np.float32)
    got = model.score(q)
    latent = lambda m: (m * model.weight).astype(np.float64) @ model.projection
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    cosine = unit(latent(q)) @ unit(latent(x)).T
    for c, score in zip(cosine, got):
        near = np.argsort(-c)[:25]
        w = np.exp(40 * (c[near] - 1))
        assert abs((w * y[near]).sum() / w.sum() - score) < 1e-3
    assert model.score(np.zeros((1, WIDTH), np.float32))[0] == y.mean()


@pytest.fixture(scope="module")
def labels(spark):
    made = [(i, i % 2, 0) for i in range(16)] + [(8, 1, 0), (3, None, 0), (None, 1, 0), (5, 7, 0),
                                                  (99, 1, 0)]
    return spark.createDataFrame(made, "doc_id long, quality int, toxic int")


def test_classes_weigh_alike_whatever_the_sample(spark, monkeypatch):
    from chainyard.llm import quality_knn as K
    docs = spark.range(400).selectExpr("id as doc_id", "concat('text ', id, if(id % 8 = 0, ' ###', ' yes')) as text")
    made = spark.range(400).selectExpr("id as doc_id", "cast(id % 8 > 0 as int) as quality")
    whole = K.fit(docs, made)
    monkeypatch.setattr(K, "MAX_PER_CLASS", 20)
    part = K.fit(docs, made)
    assert len(part.labels) == 40 and abs(part.prior - whole.prior) < 1e-9
    assert abs(part.shares[part.labels == 1].sum() / part.shares.sum() - whole.labels.mean()) < 1e-9


def test_classifier_of_odd_rows(spark, docs, no_docs, clashing, labels):
    for df in (docs, clashing):
        got = classify(df, labels).collect()
        assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
        assert {r.held_out for r in got if r.doc_id is None} == {True}
        kept = classifier_filter(df, docs, labels)
        assert kept.columns == df.columns
        assert kept.count() == sum(r.predicted for r in got)
    assert classify(no_docs, labels).count() == 0
    # nothing to learn from: nothing is rejected
    assert {r.score for r in classify(docs, labels.limit(0)).collect()} == {1.0}


def test_scores_use_neither_key_nor_source(spark, docs, labels):
    model = fit(docs, labels)
    assert not np.isnan(model.score(np.stack([terms(t or "") for t in TEXTS]))).any()
    moved = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("source", F.lit("z"))
    from chainyard.llm.quality_knn import scores
    a = docs.select("text", scores(model, docs).alias("s")).collect()
    b = moved.select("text", scores(model, moved).alias("s")).collect()
    assert collections.Counter(map(tuple, a)) == collections.Counter(map(tuple, b))


def test_the_model_is_made_outside_the_driver(spark, docs, labels, monkeypatch):
    def refused(*args):
        raise AssertionError("the sample's matrix in the driver")
    monkeypatch.setattr(np.linalg, "eigh", refused)
    model = fit(docs, labels)
    assert not model.empty and len(model.labels) > 2
