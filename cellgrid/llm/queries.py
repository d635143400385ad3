"""The queries of the training-data operators; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, html_extract, mixing, pii, quality, secrets, sentencepiece, sharding, simhash, spans, suffix_dedup
from .common import read

#: Domains of the labelled table, and the shares wanted of the expected tokens.  Labelled toxic documents that look
#: clean give clean ones a posterior of toxic of about 0.04, so a share below that can only be had by dropping them all.
DOMAINS = ["clean", "toxic", "junk"]
WEIGHTS = [0.94, 0.05, 0.01]


def piece_model() -> sentencepiece.Model:
    import public_tokenizers

    return sentencepiece.load(public_tokenizers.path("piece_bpe_32k.model"))


def domains_of(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", F.expr("CASE WHEN quality = 0 THEN 'junk' WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' END").alias("domain"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode(docs, piece_model(), check="round_trip", keep_text=False).select("doc_id", "n_tokens", "ids", "round_trip")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(read(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(spark))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2(F.expr(spans.joined("base_spans", by_rank=True)), 256).alias("base_sha256"), F.expr(spans.joined("pii_spans", by_rank=True)).alias("spans"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = mixing.fit(docs, domains_of(labels), DOMAINS)
    from .common import materialise

    scored = materialise(mixing.score(docs.select("doc_id", "source", "text"), model, keep_text=False), "scored")
    return mixing.with_rates(scored, mixing.fit_rates(scored, WEIGHTS))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select("doc_id", *quality.BASE, "base_failed", "kept")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in secrets.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", "links")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_ann, op2_sentencepiece, op3_shards, op4_suffix_dedup, op5_pii, op6_mixing, op7_html, op8_simhash, op9_quality, op10_secrets)}

#: No query here has an equivalent in SQL: each holds a fitted model, a hash that SQL engines lack or an iteration.
#: They are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {}
