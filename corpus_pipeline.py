"""Corpus pipeline: every stage takes the documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm import decontaminate, line_dedup, packing, simhash, toxicity
from loanlake.llm.common import table
from loanlake.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the blocks of lines that an earlier one has.

    ``n_chars`` follows the text. A document that is left without text stays, for
    the next stage to fold into one.
    """
    shorter = line_dedup.delete_repeats(docs)
    if "n_chars" not in docs.columns:
        return shorter
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and places in the training sequences."""
    placed = packing.packed_documents(docs, "pipeline-pieces")
    return placed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_blocks),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


#: The stages train a classifier, hash and tokenise: SQL cannot express them.
ORACLE_SQL = None
