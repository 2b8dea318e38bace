"""The pipeline: each stage's decisions take effect on what the last one kept."""

import corpus_pipeline as P
from chainyard.llm import queries as Q
from chainyard.llm.common import stored

from .conftest import SMALL
from .test_duplicates import slow_classes, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    whole = docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for name, stage in P.STAGES[:4]:
        docs = stored(stage(spark, docs, SMALL), "stage")
        assert docs.columns == COLUMNS
        kept.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    rules = {r.doc_id for r in Q.op9_quality_rules(spark, SMALL).filter("kept").collect()}
    assert set(kept[0]) == rules
    scores = {r.doc_id: r.predicted for r in Q.op10_quality_classifier(spark, SMALL).collect()}
    assert set(kept[1]) == {d for d in rules if scores[d]}
    ids = sorted(kept[1])
    root = slow_classes([slow_fingerprint(kept[1][d]) for d in ids])
    assert set(kept[2]) == {ids[w] for w in root}
    assert set(kept[3]) == set(kept[2])
    pieces = P.STAGES[4][1](spark, docs, SMALL).collect()
    assert {p.doc_id for p in pieces} == set(kept[3])
    # clean documents stay: every rejected labelled one is labelled bad
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    base = {r.doc_id for r in Q.op9_quality_rules(spark, SMALL).filter("base_failed").collect()}
    gone = {r.doc_id for r in whole.select("doc_id").collect()} - set(kept[1])
    assert not gone & good - base and bad <= gone


def test_run(spark):
    got = P.run(spark, SMALL)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_odd_rows(spark, docs, no_docs):
    for df in (docs, no_docs):
        rest = df
        for _, stage in P.STAGES[:4]:
            rest = stored(stage(spark, rest, SMALL), "stage")
            assert rest.columns == df.columns
        assert P.STAGES[4][1](spark, rest, SMALL).count() >= 0
