"""Saving and loading datasets, reports, vector stores and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_splits(dataset: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split. Rows stay in the tasks that made them: no shuffle."""
    dataset.write.mode("overwrite").partitionBy(split).parquet(path)


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """Reads what :func:`save_splits` wrote; a filter on the split reads one folder."""
    return spark.read.parquet(path)


def save_report(report: DataFrame, path: str) -> None:
    """One JSON object per line, non-ASCII kept. A report has one row per split."""
    report.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def save_vectors(store: DataFrame, path: str) -> None:
    """``vec_id, doc_id, document, embedding`` as one table."""
    store.select("vec_id", "doc_id", "document", "embedding").write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    schema = "vec_id bigint, doc_id bigint, document string, embedding array<float>"
    return spark.read.schema(schema).parquet(path)


def export(df: DataFrame, path: str, *, fmt: str = "csv", by: Sequence[str] = ()) -> None:
    """Tables for offline use, in folders by date when asked."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # Doubled quotes are what other CSV readers expect inside a quoted field.
        writer = writer.options(header="true", escape='"')
    (writer.partitionBy(*by) if by else writer).save(path)


def read_relation(
    spark: SparkSession, url: str, table: str, *, split_column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """A database table, read by ``parts`` tasks over ranges of ``split_column``."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=split_column,
            lowerBound=lower, upperBound=upper, numPartitions=parts, **options,
        )
        .load()
    )


def write_relation(df: DataFrame, url: str, table: str, *, parts: int, **options: str) -> None:
    """Appends to a database table through at most ``parts`` connections.

    A repartition, so that the work before it keeps all its tasks.
    """
    df.repartition(parts).write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()
