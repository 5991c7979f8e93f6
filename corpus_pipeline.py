"""A corpus pipeline in stages: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and hands
what it reads back to the next stage. All but the last return the columns of documents. Empty tables pass through, null
texts fail the quality rules, extra columns stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import line_dedup, minhash, mixing, packing, quality
from spanlake.llm.common import prepare, staged, table, whole, words

# token shares asked for, and least rates by domain: documents labelled clean, or as likely clean as any of these, stay
TARGETS = {"clean": 0.9, "low": 0.06, "toxic": 0.04}
FLOORS = {"clean": 1.0}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.filter_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents hold; ``n_chars`` follows the text."""
    left = line_dedup.without_lines(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return minhash.drop_copies(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: kept once, left out, or repeated."""
    labelled = mixing.domains(table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, TARGETS, floors=FLOORS, keep="clean")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their places in training sequences; a token per word, and one for the end."""
    return packing.pack(docs.select("doc_id", (F.size(words(whole())) + 1).alias("n_tokens")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_documents),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

# the last three stages are beyond SQL; tests compare near dedup with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
