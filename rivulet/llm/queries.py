"""One registered query per operator of this subpackage, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import (dedup, langid, merkle, packing, quality, secret_scan, sentencepieces, setsketch, simhash,
                         topk, toxicity, urlfilter, whitening)
from rivulet.llm.common import ascii_lower, held_out
from rivulet.llm.oracles import DEDUP_SQL, MERKLE_SQL, SECRETS_SQL, TOPK_SQL, URLS_SQL
from rivulet.sources.tables import table

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
TOXIC_FROM, GOOD_FROM = 0.3, 0.7
CAPACITY = 2048


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame, label: str) -> DataFrame:
    """Documents outside the test fold with one of their labels."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    labels = labels.where(~held_out(F.col("doc_id")))
    return docs.select("doc_id", "text").join(labels, "doc_id")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.bit_sliced_topk(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("base")
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[secret_scan.count_of(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    return langid.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.fit(labelled(spark, sf_dir, docs, "toxic"))
    return toxicity.score(docs, field).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "spans")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe(), CAPACITY)


def op7_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(labelled(spark, sf_dir, docs, "quality"))
    return quality.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text that they decode to."""
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents"), piece_model())
    decoded = sentencepieces.decode(encoded, piece_model(), keep=("n_ids", "ids_crc32"))
    return decoded.select("doc_id", "n_ids", "ids_crc32", F.sha2(F.col("text").cast("binary"), 256)
                          .alias("decoded_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents is tampered with: their text is lower-cased, which their proof must show."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(docs, altered={"text": ascii_lower(F.col("text"))}, altered_where=tampered)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector and component."""
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, components=32)
    error = whitening.identity_error(vectors, model)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    rows = whitening.whiten(vectors, model).select(
        "vec_id", F.col("deviation").try_cast("bigint").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_topk, op2_urls, op3_secrets, op4_language, op5_toxicity, op6_packing,
                            op7_dedup, op8_quality, op9_simhash, op10_sentencepiece, op11_merkle,
                            op12_whitening, op13_setsketch)}
ORACLES = {"op1_topk": TOPK_SQL, "op2_urls": URLS_SQL, "op3_secrets": SECRETS_SQL, "op7_dedup": DEDUP_SQL,
           "op11_merkle": MERKLE_SQL}
