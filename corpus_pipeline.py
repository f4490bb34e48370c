"""The training-data pipeline: toxicity, line dedup, near-duplicate texts, benchmark leaks, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coverlake.llm import leaks, lines, mixing, near, toxicity
from coverlake.llm.text import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, trained on their labelled part, does not predict to be toxic."""
    return toxicity.without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, or nearly stand, in an earlier one; those with nothing left go."""
    docs = docs.select(*COLUMNS)
    return lines.without_lines(docs, lines.dedup_lines(docs))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicate texts."""
    return near.one_of_each_class(docs.select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    docs = docs.select(*COLUMNS)
    return leaks.without_leaks(docs, leaks.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with `copy_no`."""
    docs = docs.select(*COLUMNS)
    return mixing.mixed_documents(docs, mixing.mix(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: No single SQL statement expresses the learned stages and joins; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
