"""A corpus for training: toxic documents go, one of each group of near copies stays, documents
with benchmark passages go, personal data get surrogates, and what is left is packed in batches.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all
but the last return the columns of documents. Null texts count as empty, null ids as ids; rows that
repeat an id and a text stay once after the second stage; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactmill.llm import decontaminate, ngram_join, packing, pii, toxicity
from contactmill.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: No SQL can express the classifier chain; the stages are tested against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the chain, trained on the labels of docs, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    chain = toxicity.train(docs, labels)
    return toxicity.predict(docs, chain).where("not is_toxic").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: that with the least id."""
    return ngram_join.one_of_each_group(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.drop_contaminated(docs, benchmark).select(*COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates for personal data and n_chars of the new texts."""
    done = pii.pseudonymise(docs)
    changed = F.when(F.col("n_entities") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", changed).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their places in token-budget batches."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
