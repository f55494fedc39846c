"""Feedback analytics: the tables behind a usage dashboard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.operators import feedback as ops


@dataclass(frozen=True)
class Analytics:
    """Figures over valid rows; each is worked out when asked for."""

    queries: DataFrame
    feedback: DataFrame
    rejected_feedback: DataFrame

    def daily(self) -> DataFrame:
        return ops.daily_metrics(self.queries, self.feedback).orderBy("date")

    def positive_ratio(self) -> DataFrame:
        return ops.positive_ratio(ops.daily_metrics(self.queries, self.feedback)).orderBy("date")

    def top_questions(self) -> DataFrame:
        return ops.top_questions(self.queries)

    def orphans(self) -> DataFrame:
        return ops.orphan_feedback(self.feedback, self.queries)


def analyse(queries: DataFrame, feedback: DataFrame) -> Analytics:
    """Sets invalid rows aside; feedback that is left out comes back as a table."""
    checked = ops.check_rows(feedback, ops.feedback_rules())
    valid = checked.filter("is_valid").select(*feedback.columns)
    asked = ops.check_rows(queries, ops.query_rules()).filter("is_valid").select(*queries.columns)
    return Analytics(asked, valid, checked.filter(~F.col("is_valid")))
