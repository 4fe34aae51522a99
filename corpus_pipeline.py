"""A corpus pipeline: toxic documents go, then repeated lines, then near duplicates, then
documents that hold benchmark passages; what is left is packed into sequences.

Defined results: null texts are empty: they are not toxic, have no lines, are near duplicates of each other, hold no passage and are packed as
one end token. Rows of null id are never learned from and never dropped as duplicates; rows that share an id are told apart by their
texts. An empty documents table gives no rows; without labels nothing is toxic, without benchmark nothing is contaminated. Other columns are kept,
whatever their names, until packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm import decontamination, line_dedup, packing, simhash, toxicity
from vaultflow.llm._common import materialise, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no line is left go too. n_chars, where it is, stays the length of the text that is returned."""
    out = line_dedup.remove_lines(docs)
    return out if "n_chars" not in docs.columns else out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints within op7's radius one document stays; then documents go whose five-word shingles are like an earlier one's
    (Jaccard 0.8 or more), most of which lie beyond that radius."""
    return line_dedup.drop_similar(materialise(simhash.keep_one_of_each(docs), "one_of_each"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express any of the stages; tests/llm holds run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
