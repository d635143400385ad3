"""A corpus from raw documents to token ids: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept, and all but the last return the columns of ``documents``.
Null and empty texts are texts without words; rows with null or repeated ids
are rows like others; an empty table stays empty; columns besides those of
``documents`` are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import common, mixing, pii, quality, queries, sentencepiece, simhash
from cellgrid.llm.common import materialise, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the learned decision list reject go."""
    rules = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by Jaccard >= 0.8 over five-word shingles one of the smallest doc_id stays.

    Rows with equal or null ids are rows like others: of equal texts one stays.
    """
    common.bound_batches(spark)
    return simhash.near_documents(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data gives way to its kind in angle brackets; ``n_chars`` follows.  No row goes."""
    found = pii.find(docs, pii.fit(spark))
    return pii.redact(found).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rate leaves them no copy go; a rate above one keeps a document once."""
    common.bound_batches(spark)
    model = mixing.fit(docs, queries.domains_of(read(spark, sf_dir, "labels")), queries.DOMAINS)
    scored = materialise(mixing.score(docs, model), "scored")
    rated = mixing.with_rates(scored, mixing.fit_rates(scored, queries.WEIGHTS))
    return rated.where("copies > 0").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and how many they are."""
    return sentencepiece.encode(docs.select("doc_id", "text", "lang", "source"), queries.piece_model(), keep_text=False)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", personal_data),
    ("mixing to target weights", mix),
    ("SentencePiece encoding", tokens),
]

#: Fitted models and fingerprints have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, first = read(spark, sf_dir, "documents"), len(common.MADE)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage{k}")
            done = common.MADE[-1]
            # Only what the next stage reads stays.
            common.drop_made(spark, first, [done])
            first = len(common.MADE) - 1
    return docs
