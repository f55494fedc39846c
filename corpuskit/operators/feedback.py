"""Queries asked, feedback given, and what they add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import pseudonym
from corpuskit.operators.skew import skewed_join

QUERY_SCHEMA = (
    "id bigint, query_text string, response_text string, request_id string, timestamp timestamp_ntz, "
    "user_id string, session_id string, response_time_ms int, sources_used array<struct<text:string,score:double>>"
)
FEEDBACK_SCHEMA = (
    "id bigint, request_id string, rating int, is_helpful boolean, comment string, "
    "timestamp timestamp_ntz, user_id string"
)


def query_rules() -> dict[str, Column]:
    """What a stored query must satisfy."""
    required = ("query_text", "response_text", "request_id", "timestamp")
    return {f"{c}_required": F.col(c).isNotNull() for c in required}


def feedback_rules() -> dict[str, Column]:
    """What a feedback row must satisfy; a missing rating is allowed."""
    return {
        "timestamp_required": F.col("timestamp").isNotNull(),
        "rating_1_to_5": F.col("rating").isNull() | F.col("rating").between(1, 5),
    }


def check_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds the names of the violated rules and ``is_valid``."""
    broken = F.array_compact(F.array(*[F.when(~holds, F.lit(name)) for name, holds in rules.items()]))
    return df.withColumn("violations", broken).withColumn("is_valid", F.size("violations") == 0)


def first_query_ids(queries: DataFrame) -> DataFrame:
    """The first query of each request id, with its timestamp."""
    return queries.groupBy("request_id").agg(
        F.min("id").alias("query_id"), F.min_by("timestamp", "id").alias("query_timestamp")
    )


def attach_feedback(feedback: DataFrame, queries: DataFrame) -> DataFrame:
    """Feedback with the id of its query; feedback without one is left out."""
    return skewed_join(feedback, first_query_ids(queries), "request_id")


def orphan_feedback(feedback: DataFrame, queries: DataFrame) -> DataFrame:
    """Feedback whose request id belongs to no query."""
    # A missing id belongs to no query; such rows, however many, stay where they are.
    missing = feedback.filter("request_id is null")
    known = queries.select("request_id").distinct().withColumn("known", F.lit(True))
    joined = skewed_join(feedback.filter("request_id is not null"), known, "request_id", "left")
    return joined.filter(F.col("known").isNull()).select(*feedback.columns).unionByName(missing)


def latest_feedback(feedback: DataFrame, *by: str) -> DataFrame:
    """The last word per message and user: later feedback replaces earlier.

    An aggregate with partial results, not a sort of each group, so many clicks on one
    message meet as one row per task.
    """
    others = [c for c in feedback.columns if c not in (*by, "timestamp", "id")]
    newest = F.max(F.struct("timestamp", "id", *others))
    return feedback.groupBy(*by).agg(newest.alias("f")).select(*by, "f.*")


def feedback_signs(feedback: DataFrame, queries: DataFrame) -> DataFrame:
    """``(date, up, down)`` of the feedback of each request, on the day of its first query.

    Counted per request before the join: a request with very much feedback meets its query
    as one row. Queries without feedback are dropped by the join, and the first query of a
    request is found where the join has put its queries.
    """
    per_request = feedback.groupBy("request_id").agg(
        F.count_if("is_helpful").alias("up"), F.count_if(~F.col("is_helpful")).alias("down")
    )
    asked = queries.select("request_id", "id", F.to_date("timestamp").alias("date"))
    first = asked.join(per_request, "request_id").groupBy("request_id").agg(
        F.min(F.struct("id", "date", "up", "down")).alias("q")
    )
    return first.select("q.date", "q.up", "q.down")


def daily_metrics(queries: DataFrame, feedback: DataFrame) -> DataFrame:
    """Per day: queries, mean response time, feedback by sign, users. Feedback counts on
    the day of its query. Both kinds of rows go into one aggregate."""
    asked = queries.select(
        F.to_date("timestamp").alias("date"), F.lit(1).alias("asked"), "response_time_ms", "user_id",
        F.lit(0).cast("bigint").alias("up"), F.lit(0).cast("bigint").alias("down"),
    )
    signs = feedback_signs(feedback, queries)
    both = asked.unionByName(signs.withColumn("asked", F.lit(0)), allowMissingColumns=True)
    return both.groupBy("date").agg(
        F.sum("asked").alias("total_queries"),
        F.avg("response_time_ms").alias("avg_response_time_ms"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("up").alias("positive_feedback_count"),
        F.sum("down").alias("negative_feedback_count"),
    ).filter("total_queries > 0")


def positive_ratio(metrics: DataFrame) -> DataFrame:
    """Share of positive feedback, NULL on a day without any."""
    up, down = F.col("positive_feedback_count"), F.col("negative_feedback_count")
    return metrics.select("date", F.try_divide(up, up + down).alias("positive_ratio"))


def question_counts(queries: DataFrame) -> DataFrame:
    return queries.groupBy("query_text").agg(F.count("*").alias("query_count"))


def top_questions(queries: DataFrame, n: int = fixed.TOP_QUESTIONS) -> DataFrame:
    """The most frequent questions, ties by text."""
    return question_counts(queries).orderBy(F.desc("query_count"), "query_text").limit(n)


def daily_usage(log: DataFrame) -> DataFrame:
    """Per day: requests, active users, tokens written."""
    return log.groupBy(F.to_date("ts").alias("date")).agg(
        F.count("*").alias("requests"),
        F.countDistinct("user_id").alias("active_users"),
        F.sum("output_tokens").alias("output_tokens"),
    )


def labelled_training_set(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents judged good and not toxic; unlabelled ones are left out. Ids are unique on
    both sides, and the label filter runs before the join."""
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
    return documents.join(good, "doc_id", "left_semi")


def log_metadata(queries: DataFrame, salt: str) -> DataFrame:
    """What may be logged of a request: ids, lengths, time - no text, no plain user id."""
    return queries.select(
        "request_id",
        pseudonym(F.col("user_id"), salt).alias("user_hash"),
        F.length("query_text").alias("query_length"),
        F.length("response_text").alias("response_length"),
        "timestamp",
    )
