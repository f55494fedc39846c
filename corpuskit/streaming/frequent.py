"""The most frequent questions of a stream, without a stored row per question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.operators.feedback import top_questions

# Frequent-item summaries keep this many questions, whatever the number there are.
TRACKED = 10_000

# A question that a summary of n texts has lost or hides was asked at most this often times n / TRACKED
# (3.5 is the summary's own bound on its counts, reached once from below and once from above).
_ERROR = 7


class FrequentQuestions:
    """A ``foreachBatch`` sink that keeps one frequent-item summary a batch.

    Summaries are made within tasks and merged; a batch that runs again replaces its own.
    Questions without text are left out.
    """

    def __init__(self, folder: str, tracked: int = TRACKED):
        self.folder, self.tracked = folder, tracked

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        made = batch.filter("query_text IS NOT NULL").agg(
            F.count("*").alias("texts"), F.expr(f"approx_top_k_accumulate(query_text, {self.tracked})").alias("summary")
        )
        made.filter("texts > 0").write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def candidates(self, spark) -> DataFrame:
        """``(query_text)``: at most as many texts as summaries keep, all that were asked often among them."""
        merged = spark.read.parquet(self.folder).agg(F.expr(f"approx_top_k_combine(summary, {self.tracked})").alias("s"))
        return merged.select(F.inline(F.expr(f"approx_top_k_estimate(s, {self.tracked})"))).select(F.col("item").alias("query_text"))

    def top(self, stored: DataFrame, n: int = fixed.TOP_QUESTIONS) -> DataFrame:
        """``(query_text, query_count)``: exactly the ``n`` most frequent of the ``stored`` questions. An action.

        ``stored`` holds what the batches brought. Only candidates are counted in it, so a task
        sends a row per candidate, not per question. Their counts show whether a question that is
        no candidate could be among the first; then, and only then, all questions are counted.
        """
        asked = stored.filter("query_text IS NOT NULL")
        # At most TRACKED texts.
        counted = asked.join(F.broadcast(self.candidates(stored.sparkSession)), "query_text").groupBy("query_text").agg(F.count("*").alias("query_count"))
        rows = counted.orderBy(F.desc("query_count"), "query_text").limit(n)
        first = rows.collect()
        total = asked.count()
        # Fewer than n rows are all candidates there are.
        complete = len(first) < n and sum(r["query_count"] for r in first) == total
        if complete or (len(first) == n and first[-1]["query_count"] > _ERROR * total / self.tracked):
            return stored.sparkSession.createDataFrame(first, counted.schema)
        return top_questions(asked, n)
