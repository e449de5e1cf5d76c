"""A training corpus from documents: toxic ones go, near copies and benchmark passages go, personal data is masked, sources are mixed."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.llm import decontaminate, mixing, ngram_join, pii, toxicity
from wattloom.llm.common import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go; it is trained from the labels of documents that are there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage, or one a few edits away, go."""
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind; all documents stay, and n_chars follows the text."""
    return pii.redact_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes from, with the words taken, repeats counted."""
    return mixing.mix(docs, whole_rows=True).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_out), ("ngram_join", near_copies_out), ("decontamination", benchmark_out), ("pii", personal_masked),
    ("mixing", mixed),
]

#: A trained network and a trained field decide; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written as Parquet in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
