"""Queries that run as streams over the test tables and hand back what the stream wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.catalogue import inputs
from corpuskit.catalogue.inputs import FEEDBACK_SQL, LOG_SQL, PROMPT_FEEDBACK_SQL, QUERIES_SQL, cleaned_sql
from corpuskit.catalogue.registry import query
from corpuskit.operators import feedback as fb
from corpuskit.operators import sketches
from corpuskit.session import new_path
from corpuskit.streaming import feedback as sf_
from corpuskit.streaming import frequent, ingest
from corpuskit.streaming import requests as sr


def _as_stream(table: DataFrame, name: str) -> DataFrame:
    """A written copy of a table, read back as a stream."""
    spark = table.sparkSession
    path = new_path(spark, name)
    table.write.parquet(path)
    return spark.readStream.schema(table.schema).parquet(path)


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    log = inputs.request_log(spark, sf)
    ordered = log.select(F.col("ts").cast("timestamp").alias("ts"), *[c for c in log.columns if c != "ts"])
    return _as_stream(ordered, "log")


_BODIES = f"SELECT DISTINCT sha256({cleaned_sql('text')}) AS content_hash FROM documents"


@query("stream_clean_dedup", _BODIES)
def stream_clean_dedup(spark, sf):
    folder = new_path(spark, "arriving")
    inputs.raw_lines(spark, sf).select("value").write.text(folder)
    cleaned = ingest.stream_clean(ingest.stream_records(ingest.stream_lines(spark, folder)))
    return ingest.run_available(ingest.stream_dedup(cleaned).select("content_hash"), "deduplicated")


# Windows the watermark has passed: those ending at or before the newest row less ten minutes.
_CLOSED = f"""WITH l AS ({LOG_SQL}), w AS (SELECT endpoint, status,
      time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, (SELECT max(ts) FROM l) - INTERVAL 10 MINUTE AS mark FROM l),
    c AS (SELECT window_start, endpoint, count(*) AS requests, count(*) FILTER (status >= 500) AS errors
      FROM w WHERE window_start + INTERVAL 5 MINUTE <= mark GROUP BY 1, 2)"""


def _windows(spark, sf) -> DataFrame:
    return ingest.run_available(sr.stream_windows(_log_stream(spark, sf), slide=None), "windows")


@query("stream_windows", f"{_CLOSED} SELECT window_start, endpoint, requests, errors FROM c")
def stream_windows(spark, sf):
    return _windows(spark, sf).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint", "requests", "errors"
    )


_SLID = f"""WITH l AS ({LOG_SQL}), w AS (SELECT endpoint, status, date_trunc('minute', ts) - to_minutes(back) AS window_start
      FROM (SELECT *, unnest(range(5)) AS back FROM l)),
    c AS (SELECT window_start, endpoint, count(*) AS requests, count(*) FILTER (status >= 500) AS errors FROM w
      WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM l) - INTERVAL 10 MINUTE GROUP BY 1, 2)"""


@query("stream_sliding_windows", f"{_SLID} SELECT window_start, endpoint, requests, errors FROM c")
def stream_sliding_windows(spark, sf):
    slid = ingest.run_available(sr.stream_windows(_log_stream(spark, sf)), "windows")
    return slid.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint", "requests", "errors")


# Every tenth event arrives in a second run, after all the others; whatever lies in windows
# that the first run has closed is late.
@query(
    "stream_late_rows",
    f"""WITH l AS ({LOG_SQL}), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS first_mark FROM l WHERE request_id::BIGINT % 10 <> 0),
    n AS (SELECT greatest(max(ts), (SELECT max(ts) FROM l WHERE request_id::BIGINT % 10 <> 0)) - INTERVAL 10 MINUTE AS last_mark FROM l),
    w AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS start, request_id::BIGINT % 10 = 0 AS second FROM l),
    k AS (SELECT *, second AND start + INTERVAL 5 MINUTE <= first_mark AS late FROM w, m),
    last AS (SELECT max(start) AS newest FROM k, n WHERE NOT late AND start + INTERVAL 5 MINUTE <= last_mark)
    SELECT count(*) AS rows, count(*) FILTER (late) AS late_rows FROM k, last WHERE start <= newest""",
)
def stream_late_rows(spark, sf):
    log = inputs.request_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    path, out = new_path(spark, "log"), new_path(spark, "windows")
    second = F.col("request_id").cast("bigint") % 10 == 0
    for part in (~second, second):
        log.filter(part).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(log.schema).parquet(path)
        windows = ingest.write_available(sr.stream_windows(arriving, slide=None), out, "windows")
    return sr.late_rows(log, windows)


@query(
    "stream_alerts",
    f"""{_CLOSED}, ev AS (SELECT endpoint, window_start AS ts, errors::DOUBLE / requests > {fixed.ERROR_RATIO_LIMIT} AS met FROM c),
    br AS (SELECT *, CASE WHEN NOT met OR ts - lag(ts) OVER u > INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS opens FROM ev
      WINDOW u AS (PARTITION BY endpoint ORDER BY ts)),
    runs AS (SELECT *, sum(opens) OVER (PARTITION BY endpoint ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM br),
    aged AS (SELECT *, ts - min(ts) FILTER (met) OVER (PARTITION BY endpoint, run) AS age FROM runs),
    told AS (SELECT endpoint, ts, CASE WHEN NOT met THEN 'inactive' WHEN age >= INTERVAL 5 MINUTE THEN 'firing' ELSE 'pending' END AS state,
      coalesce(lead(ts) OVER (PARTITION BY endpoint ORDER BY ts), (SELECT max(ts) + INTERVAL 1 MICROSECOND FROM ev)) AS next FROM aged)
    SELECT endpoint, ts, state FROM told
    UNION ALL SELECT endpoint, ts + INTERVAL 5 MINUTE, 'inactive' FROM told WHERE state <> 'inactive' AND next > ts + INTERVAL 5 MINUTE""",
)
def stream_alerts(spark, sf):
    closed = _windows(spark, sf).select("window_start", "endpoint", "error_ratio")
    evaluations = _as_stream(closed, "evaluations").withColumnRenamed("window_start", "ts")
    met = F.col("error_ratio") > fixed.ERROR_RATIO_LIMIT
    written = ingest.run_available(sr.stream_alerts(evaluations, met, 5, step_minutes=5), "alerts")
    return written.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# One series per user, an evaluation for each hour with requests: long silences, many series that end.
@query(
    "stream_alerts_timers",
    f"""WITH l AS ({LOG_SQL}),
    ev AS (SELECT user_id::VARCHAR AS series, date_trunc('hour', ts) AS ts, count(*) FILTER (status >= 500)::DOUBLE / count(*) > 0.2 AS met FROM l GROUP BY 1, 2),
    br AS (SELECT *, CASE WHEN NOT met OR ts - lag(ts) OVER u > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS opens FROM ev
      WINDOW u AS (PARTITION BY series ORDER BY ts)),
    runs AS (SELECT *, sum(opens) OVER (PARTITION BY series ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM br),
    told AS (SELECT series, ts, CASE WHEN NOT met THEN 'inactive'
        WHEN ts - min(ts) FILTER (met) OVER (PARTITION BY series, run) >= INTERVAL 1 HOUR THEN 'firing' ELSE 'pending' END AS state,
      coalesce(lead(ts) OVER (PARTITION BY series ORDER BY ts), (SELECT max(ts) + INTERVAL 1 MICROSECOND FROM ev)) AS next FROM runs)
    SELECT series, ts, state FROM told
    UNION ALL SELECT series, ts + INTERVAL 1 HOUR, 'inactive' FROM told WHERE state <> 'inactive' AND next > ts + INTERVAL 1 HOUR""",
)
def stream_alerts_timers(spark, sf):
    errors = F.count_if(F.col("status") >= 500) / F.count("*")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    log = inputs.request_log(spark, sf)
    hourly = log.groupBy(F.col("user_id").cast("string").alias("series"), hour.alias("ts")).agg(errors.alias("error_ratio"))
    path, out = new_path(spark, "evaluations"), new_path(spark, "alerts")
    middle = F.lit("2024-01-16").cast("timestamp")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        hourly.filter(part).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(hourly.schema).parquet(path)
        states = sr.stream_alerts(arriving, F.col("error_ratio") > 0.2, 60, step_minutes=60, series="series")
        written = ingest.write_available(states, out, "alerts")
    return written.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# The queries of a tenth of the requests come a run after the others of their half of the
# month, and so after feedback on them. In the last run both streams get a row from later on.
@query(
    "stream_feedback_pairs",
    f"""WITH q AS ({QUERIES_SQL}), f AS ({PROMPT_FEEDBACK_SQL})
    SELECT f.id, f.request_id, q.id AS query_id, q."timestamp" AS query_time, q.id IS NULL AS is_orphan FROM f LEFT JOIN q USING (request_id)""",
)
def stream_feedback_pairs(spark, sf):
    def timed(df):
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    asked = timed(inputs.asked_queries(spark, sf)).select("id", "request_id", "timestamp")
    given = timed(inputs.prompt_feedback(spark, sf))
    last = asked.select((F.max("timestamp") + F.expr("INTERVAL 60 DAYS")).alias("timestamp")).filter("timestamp is not null")
    row = {"id": F.lit(-1), "request_id": F.lit("closing"), "is_helpful": F.lit(None), "timestamp": F.col("timestamp")}
    closing = [last.select(*[row[c].cast(t).alias(c) for c, t in df.dtypes]) for df in (asked, given)]
    half = F.lit("2024-01-16").cast("timestamp")
    held = F.col("id") % 10 == 3
    runs = [
        (asked.filter((F.col("timestamp") < half) & ~held), given.filter(F.col("timestamp") < half)),
        (asked.filter((F.col("timestamp") < half) == held), given.filter(F.col("timestamp") >= half)),
        (asked.filter((F.col("timestamp") >= half) & held).unionByName(closing[0]), closing[1]),
    ]
    folder, out = new_path(spark, "arriving"), new_path(spark, "pairs")
    for run in runs:
        streams = []
        for part, name in zip(run, ("queries", "feedback")):
            part.write.mode("append").parquet(f"{folder}/{name}")
            streams.append(spark.readStream.schema(part.schema).parquet(f"{folder}/{name}"))
        pairs = sf_.feedback_pairs(streams[1], streams[0], within="2 hours", early="1 hour", watermark="20 days")
        written = ingest.write_available(pairs, out, "pairs")
    told = written.filter("id >= 0").withColumn("query_time", F.col("query_time").cast("timestamp_ntz"))
    return told.select("id", "request_id", "query_id", "query_time", "is_orphan")


@query(
    "stream_late_quarantine",
    f"""WITH l AS ({LOG_SQL}), m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS first_mark FROM l WHERE request_id::BIGINT % 10 <> 0)
    SELECT request_id, endpoint FROM l, m
    WHERE request_id::BIGINT % 10 = 0 AND time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= first_mark""",
)
def stream_late_quarantine(spark, sf):
    log = inputs.request_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    path, out = new_path(spark, "log"), new_path(spark, "quarantine")
    sink = sr.LateQuarantine(out)
    second = F.col("request_id").cast("bigint") % 10 == 0
    for part in (~second, second):
        log.filter(part).write.mode("append").parquet(path)
        ingest.feed_available(spark.readStream.schema(log.schema).parquet(path), sink, f"{out}/progress")
    return sink.rows(log, "late").select("request_id", "endpoint")


@query(
    "stream_feedback_join",
    f"""WITH q AS ({QUERIES_SQL}), f AS ({FEEDBACK_SQL})
    SELECT f.id, q.id AS query_id, q.id IS NULL AS is_orphan FROM f LEFT JOIN q USING (request_id)""",
)
def stream_feedback_join(spark, sf):
    arriving = _as_stream(inputs.given_feedback(spark, sf), "feedback")
    joined = sf_.join_feedback(arriving, inputs.asked_queries(spark, sf), new_path(spark, "joined"))
    return joined.select("id", "query_id", "is_orphan")


@query(
    "chat_sessions",
    f"""WITH l AS ({LOG_SQL}),
    s AS (SELECT *, CASE WHEN ts < lag(ts) OVER u + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM l
      WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM s),
    g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS requests
      FROM n GROUP BY user_id, no)
    SELECT * FROM g WHERE session_end <= (SELECT max(ts) FROM l) - INTERVAL 10 MINUTE""",
)
def chat_sessions(spark, sf):
    written = ingest.run_available(sf_.stream_sessions(_log_stream(spark, sf)), "sessions")
    return written.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query(
    "stream_daily_refresh",
    f"""WITH q AS ({QUERIES_SQL}), f AS ({FEEDBACK_SQL}),
    a AS (SELECT "timestamp"::DATE AS date, count(*) AS total_queries, round(avg(response_time_ms), 6) AS avg_response_time_ms,
      count(DISTINCT user_id) AS unique_users FROM q GROUP BY 1),
    b AS (SELECT q."timestamp"::DATE AS date, count(*) FILTER (is_helpful) AS up, count(*) FILTER (NOT is_helpful) AS down
      FROM f JOIN q USING (request_id) WHERE rating BETWEEN 1 AND 5 GROUP BY 1)
    SELECT date, total_queries, avg_response_time_ms, unique_users, coalesce(up, 0) AS positive_feedback_count,
      coalesce(down, 0) AS negative_feedback_count FROM a LEFT JOIN b USING (date)""",
)
def stream_daily_refresh(spark, sf):
    def timed(df):
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    asked = _as_stream(timed(inputs.asked_queries(spark, sf)), "queries")
    given = inputs.given_feedback(spark, sf)
    valid = fb.check_rows(given, fb.feedback_rules()).filter("is_valid").select(*given.columns)
    # Feedback k is on query 2k of the table, which is up to a month younger.
    daily = sf_.refresh_daily(asked, _as_stream(timed(valid), "feedback"), new_path(spark, "refresh"), early="31 days", watermark="31 days")
    return daily.withColumn("avg_response_time_ms", F.round("avg_response_time_ms", 6))


@query(
    "top_questions_stream",
    f"""WITH q AS ({QUERIES_SQL}) SELECT query_text, count(*) AS query_count FROM q GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {fixed.TOP_QUESTIONS}""",
)
def top_questions_stream(spark, sf):
    asked = inputs.asked_queries(spark, sf).select("id", "query_text")
    path, out = new_path(spark, "asked"), new_path(spark, "summaries")
    sink = frequent.FrequentQuestions(out)
    for part in (F.col("id") % 3 == 0, F.col("id") % 3 != 0):
        asked.filter(part).write.mode("append").parquet(path)
        ingest.feed_available(spark.readStream.schema(asked.schema).parquet(path), sink, f"{out}-progress")
    return sink.top(spark.read.schema(asked.schema).parquet(path))


# The state of the stream is a sketch per open window and endpoint.
@query(
    "stream_latency_sketches",
    f"""WITH l AS ({LOG_SQL}) SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, endpoint, count(*) AS requests,
      quantile_disc(duration_s, 0.5) AS p50, quantile_disc(duration_s, 0.95) AS p95 FROM l
    WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM l) GROUP BY 1, 2""",
)
def stream_latency_sketches(spark, sf):
    hourly = ingest.run_available(sr.stream_sketches(_log_stream(spark, sf), "1 hour"), "sketches")
    return hourly.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "endpoint", sketches.sketch_count().alias("requests"),
        sketches.sketch_quantile(0.5).alias("p50"), sketches.sketch_quantile(0.95).alias("p95"),
    )
