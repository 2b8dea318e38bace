"""One registered query for each operator, with its production parameters.

A query applies its operator to the whole table and keeps the columns that
its contract names.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chainyard.llm.common import prepared, table
from chainyard.session import shared_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Folder of the tokenizer files; their place is a parameter of the operators.
TOKENIZERS = os.path.dirname(public_tokenizers.path("x"))


def tokenizer(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.token_counts import token_counts
    docs = table(prepared(spark), sf_dir, "documents")
    return token_counts(docs, tokenizer("byte_bpe_50k.json"), limit=1024)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.packing_bm25 import pack_documents
    docs = table(prepared(spark), sf_dir, "documents")
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), end_id=1, window=2048,
                          with_ids=False).drop("ids")


@query
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.token_records import read_token_records, write_token_records
    docs = table(prepared(spark), sf_dir, "documents")
    path = shared_dir(spark, "op8")
    write_token_records(docs, path, tokenizer("word_bpe_49k.json"), end_id=2)
    records = read_token_records(spark, path, with_ids=False)
    return records.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.quality_rules_mcd import quality_rules
    return quality_rules(table(prepared(spark), sf_dir, "documents"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.quality_knn import classify
    docs = table(prepared(spark), sf_dir, "documents")
    return classify(docs, table(spark, sf_dir, "labels"))


@query
def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.simhash_gph import near_duplicates
    docs = table(prepared(spark), sf_dir, "documents")
    return near_duplicates(docs, size=4, max_bits=4)


#: A deployment passes a secret of its own; results are repeatable for one key.
PII_KEY = "registered query"


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.pii_surrogates import replace_pii, secret
    docs = table(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    masked = replace_pii(docs, secret(PII_KEY), entities="entities")
    return masked.selectExpr("doc_id", "size(entities) AS n_entities", "text")


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from chainyard.llm.ann_mih import nearest_neighbours
    rows = table(prepared(spark), sf_dir, "embeddings")
    return nearest_neighbours(rows, F.col("vec_id") % 20 == 0, k=20)


@query
def op2_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.sentencepiece_dropout import encode_digest
    docs = table(prepared(spark), sf_dir, "documents")
    return encode_digest(docs, tokenizer("piece_bpe_32k.model"), seed=20, dropout=0.1)


@query
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.warc_derivatives import derivatives, read_warc, responses, write_warc
    pages = table(prepared(spark), sf_dir, "pages")
    path = shared_dir(spark, "op6")
    write_warc(derivatives(responses(pages, date="2024-01-01T00:00:00Z")), path)
    return read_warc(spark, path).withColumnRenamed("key", "page_id")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from chainyard.llm.whitening import fit_whitening, identity_error, whiten
    rows = table(prepared(spark), sf_dir, "embeddings")
    model = fit_whitening(rows, components=32, scale=64, shift=1_000_000)
    whitened = whiten(rows, model)
    error = identity_error(whitened, model)
    explained = F.array(*[F.lit(float(x)) for x in model.explained]).cast("array<double>")
    number = F.posexplode("whitened").alias("at", "whitened")
    return (whitened.select("vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                            number)
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                    "deviation", "whitened", explained[F.col("at")].alias("explained"),
                    F.lit(error).alias("identity_error")))


@query
def op13_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chainyard.llm.embedding_dups import near_duplicates
    return near_duplicates(table(prepared(spark), sf_dir, "embeddings"), cosine=0.95)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from chainyard.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(prepared(spark), sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, scale=256)


ORACLES["op12_hard_negatives"] = """
    with part as (
        select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
               [cast(floor(256 * cast(c as double)) as bigint) for c in embedding] as x
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
          and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
    scored as (
        select a.vec_id as anchor_id, a.label = b.label as alike, b.vec_id as other,
               cast(list_sum([p[1] * p[2] for p in list_zip(a.x, b.x)]) as bigint) as score
        from part a join part b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
    positive as (
        select anchor_id, other as positive_id, score as positive_score from scored where alike
        qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
    select anchor_id, positive_id, other as negative_id, positive_score, score as negative_score,
           cast(row_number() over (partition by anchor_id, positive_id order by score desc, other)
                as integer) as rank
    from positive join scored using (anchor_id)
    where not alike and 80 * positive_score <= 100 * score and score <= positive_score
    qualify rank <= 5"""

ORACLES["op13_embedding_near_duplicates"] = """
    with recursive part as (
        select vec_id, [cast(c as double) for c in embedding] as v from embeddings
        where len([c for c in embedding if c is null or not isfinite(c)]) = 0
          and len([c for c in embedding if c <> 0]) > 0),
    link as (
        select a.vec_id as one, b.vec_id as other from part a join part b
          on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95),
    reach as (
        select vec_id as start, vec_id as there from embeddings
        union select start, other from reach join link on there = one)
    select vec_id, coalesce(n, 0) as n_links, component_id, component_id = vec_id as kept
    from (select start as vec_id, min(there) as component_id from reach group by start)
    left join (select one as vec_id, count(*) as n from link group by one) using (vec_id)"""
