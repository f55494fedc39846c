"""Raw lines to stored records, quarantine and training rows, counted by the passes that write them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpuskit.functions.text import is_blank, preprocess_text, training_text
from corpuskit.operators.dedup import first_occurrences
from corpuskit.sources.lines import parse_lines


@dataclass(frozen=True)
class Ingested:
    """Tables as they were written, and ``counts``: rows by stage."""

    records: DataFrame
    quarantine: DataFrame
    training: DataFrame
    counts: dict[str, int]

    def stages(self) -> DataFrame:
        """``(stage, rows)``"""
        return self.records.sparkSession.createDataFrame(list(self.counts.items()), "stage string, rows bigint")


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def ingest(lines: DataFrame, folder: str, *order: str) -> Ingested:
    """Stores what ``lines`` hold under ``folder``. An action.

    The lines are read once: records and quarantine are two parts of one written table, and what
    is counted is observed on its way there. Training rows are made from the records that were
    stored, the first of equal bodies in the given order, and counted in the pass that stores
    them. Both counts are taken in the task that writes, whose result counts once even if it has
    to run again on another executor.
    """
    spark = lines.sparkSession
    read, parsed = Observation(), Observation()
    told = parse_lines(
        lines.observe(read, F.count("*").alias("lines"), _count(is_blank(F.col("value"))).alias("blank"))
    ).observe(parsed, F.count("*").alias("not_blank"), _count(F.col("reject_reason").isNotNull()).alias("rejected"))
    part = F.when(F.col("reject_reason").isNull(), "records").otherwise("quarantine")
    text = [F.coalesce(F.col("record")[c], F.lit("")).alias(c) for c in ("body", "parsed_content")]
    held = told.select(*order, "value", "reject_reason", *text, part.alias("part"))
    held = held.withColumn("value", F.when(F.col("part") == "quarantine", F.col("value")))
    held.write.partitionBy("part").parquet(f"{folder}/parsed")
    stored = spark.read.schema(held.schema).parquet(f"{folder}/parsed")
    records = stored.filter("part = 'records'").select(*order, "body", "parsed_content")
    quarantine = stored.filter("part = 'quarantine'").select(*order, "value", "reject_reason")

    kept = Observation()
    cleaned = records.withColumns({c: preprocess_text(F.col(c)) for c in ("body", "parsed_content")})
    first = first_occurrences(cleaned, F.col("body"), *order)
    rows = first.withColumn("text", training_text(F.col("body"), F.col("parsed_content")))
    seen = rows.observe(kept, F.count("*").alias("bodies"), _count(F.col("text") == "").alias("empty"))
    made = seen.filter(F.col("text") != "").select(*order, "text", "content_hash")
    made.write.parquet(f"{folder}/training")
    training = spark.read.schema(made.schema).parquet(f"{folder}/training")

    n = {**read.get, **parsed.get, **kept.get}
    n["records"] = n["not_blank"] - n["rejected"]
    n["duplicate"] = n["records"] - n["bodies"]
    n["training_rows"] = n.pop("bodies") - n["empty"]
    return Ingested(records, quarantine, training, n)
