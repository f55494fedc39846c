"""A corpus pipeline over ``documents``: filter, cut boilerplate, deduplicate, decontaminate, encode.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import host_rules, lsh_forest, piece_viterbi, site_lines, template_leaks
from corpuskit.llm.queries import tokenizer_file
from corpuskit.session import durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the rules or whose host is rejected."""
    return host_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines after their first document; drops documents that were nothing else."""
    return site_lines.cleaned_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each near-duplicate group."""
    return lsh_forest.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark questions, also re-parameterised ones."""
    return template_leaks.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, with the piece ids of their texts, and whether these spell the text again.

    Only the mark that the model puts for white space comes back as a space.
    """
    model = Path(tokenizer_file("piece_bpe_32k.model")).read_bytes()
    spelled = piece_viterbi.encode(docs, model, decoded="decoded")
    whole = F.replace(F.coalesce("text", F.lit("")), F.lit(piece_viterbi.MARK), F.lit(" "))
    return spelled.withColumn("decodes", F.col("decoded") == whole).drop("decoded")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("piece_coding", encode),
]

# Signatures, slot agreement and piece merges are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
