"""Inputs the queries derive from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Five lines per document: the full record, a cut-off one, a blank one, JSON that is no
# object, and the record again without its second field.
def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    doc_id = F.col("doc_id").cast("string")
    lines = F.array(
        F.to_json(F.struct(F.col("text").alias("body"), F.col("source").alias("parsed_content"))),
        F.concat(F.lit('{"body": '), doc_id),
        F.lit("  "),
        F.concat(F.lit("["), doc_id, F.lit("]")),
        F.to_json(F.struct(F.col("text").alias("body"))),
    )
    return docs.select("doc_id", F.posexplode(lines).alias("part", "value")).select(
        (F.col("doc_id") * 10 + F.col("part")).alias("line_no"), "value"
    )


RAW_RECORDS_SQL = """
    SELECT doc_id * 10 AS line_no, text AS body, source AS parsed_content FROM documents
    UNION ALL SELECT doc_id * 10 + 4, text, '' FROM documents"""


def cleaned_sql(column: str) -> str:
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


TOKEN_SQL = r"'[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]'"


def tokens_sql(column: str) -> str:
    return f"regexp_extract_all({column}, {TOKEN_SQL})"


def split_sql(source: str, key: str, columns: str) -> str:
    """Adds the exact split to the rows of ``source``."""
    return f"""
    SELECT {columns},
      CASE WHEN place <= n_test THEN 'test'
           WHEN place <= n_test + ceil((n - n_test) * (0.1::DOUBLE / (1::DOUBLE - 0.1::DOUBLE))) THEN 'validation'
           ELSE 'train' END AS split
    FROM (SELECT *, ceil(n * 0.1::DOUBLE) AS n_test
          FROM (SELECT *, row_number() OVER (ORDER BY sha256({key}::VARCHAR || ':42')) AS place,
                       count(*) OVER () AS n FROM {source}))"""


def unit_sql(key: str) -> str:
    return f"(('0x' || substr(sha256({key}::VARCHAR || ':42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def threshold_sql(key: str) -> str:
    u = unit_sql(key)
    return f"CASE WHEN {u} < 0.1 THEN 'test' WHEN {u} < 0.2 THEN 'validation' ELSE 'train' END"


# Request log, stored queries and feedback, from the events.
def _event_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        "ts",
        "user_id",
        F.when(_event_k() < 50, "/generate").otherwise("/rag_generate").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 100).alias("duration_s"),
        F.floor("value").cast("bigint").alias("output_tokens"),
    )


_K_SQL = "regexp_extract(props, '([0-9]+)', 1)::INTEGER"
LOG_SQL = f"""
    SELECT event_id::VARCHAR AS request_id, ts, user_id,
      CASE WHEN {_K_SQL} < 50 THEN '/generate' ELSE '/rag_generate' END AS endpoint,
      CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
      value / 100 AS duration_s, floor(value)::BIGINT AS output_tokens
    FROM events"""


def asked_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("question "), _event_k().cast("string")).alias("query_text"),
        F.col("event_type").alias("response_text"),
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.floor(F.col("value") * 10).cast("int").alias("response_time_ms"),
    )


QUERIES_SQL = f"""
    SELECT event_id AS id, 'question ' || {_K_SQL} AS query_text, event_type AS response_text,
      event_id::VARCHAR AS request_id, ts AS "timestamp", user_id::VARCHAR AS user_id,
      floor(value * 10)::INTEGER AS response_time_ms
    FROM events"""


def given_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_id") * 2).cast("string").alias("request_id"),
        F.floor(_event_k() / 14).cast("int").alias("rating"),
        F.col("event_type").isin("click", "purchase").alias("is_helpful"),
        F.col("event_type").alias("comment"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
    )


FEEDBACK_SQL = f"""
    SELECT event_id AS id, (event_id * 2)::VARCHAR AS request_id,
      floor({_K_SQL} / 14.0)::INTEGER AS rating,
      event_type IN ('click', 'purchase') AS is_helpful, event_type AS comment,
      ts AS "timestamp", user_id::VARCHAR AS user_id
    FROM events"""


# Feedback on an event's own query up to 99 minutes after it; some on no query, some without a request id.
def prompt_feedback(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    request = F.when(e % 7 == 0, F.concat(F.lit("none-"), e.cast("string"))).when(e % 11 != 0, e.cast("string"))
    return table(spark, sf, "events").select(
        e.alias("id"),
        request.alias("request_id"),
        F.col("event_type").isin("click", "purchase").alias("is_helpful"),
        (F.col("ts") + F.make_dt_interval(mins=_event_k())).alias("timestamp"),
    )


PROMPT_FEEDBACK_SQL = f"""
    SELECT event_id AS id,
      CASE WHEN event_id % 7 = 0 THEN 'none-' || event_id WHEN event_id % 11 <> 0 THEN event_id::VARCHAR END AS request_id,
      event_type IN ('click', 'purchase') AS is_helpful, ts + to_minutes({_K_SQL}) AS "timestamp"
    FROM events"""
