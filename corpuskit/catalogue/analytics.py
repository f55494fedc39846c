"""Queries over stored queries, feedback, labels and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.catalogue import inputs
from corpuskit.catalogue.inputs import FEEDBACK_SQL, LOG_SQL, QUERIES_SQL, asked_queries, given_feedback, request_log
from corpuskit.catalogue.registry import query
from corpuskit.functions import text as tx
from corpuskit.operators import alerts, conversation, evaluation, sketches
from corpuskit.operators import feedback as fb
from corpuskit.plans.analytics import analyse
from corpuskit.session import durable, new_path
from corpuskit.sources import store

_Q = f"q AS ({QUERIES_SQL})"
_F = f"f AS ({FEEDBACK_SQL})"
_VALID = "v AS (SELECT * FROM f WHERE rating BETWEEN 1 AND 5)"


def _first(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "feedback_validate",
    f"""WITH {_F} SELECT id, rating BETWEEN 1 AND 5 AS is_valid,
    CASE WHEN rating BETWEEN 1 AND 5 THEN '' ELSE 'rating_1_to_5' END AS violations FROM f""",
)
def feedback_validate(spark, sf):
    checked = fb.check_rows(given_feedback(spark, sf), fb.feedback_rules())
    return checked.select("id", "is_valid", F.array_join("violations", ",").alias("violations"))


@query(
    "feedback_join",
    f"""WITH {_Q}, {_F} SELECT f.id, f.request_id, q.id AS query_id, q."timestamp" AS query_timestamp, rating, is_helpful
    FROM f JOIN q USING (request_id)""",
)
def feedback_join(spark, sf):
    attached = fb.attach_feedback(given_feedback(spark, sf), asked_queries(spark, sf))
    return attached.select("id", "request_id", "query_id", "query_timestamp", "rating", "is_helpful")


@query("feedback_orphans", f"WITH {_Q}, {_F} SELECT id, request_id FROM f WHERE request_id NOT IN (SELECT request_id FROM q)")
def feedback_orphans(spark, sf):
    return fb.orphan_feedback(given_feedback(spark, sf), asked_queries(spark, sf)).select("id", "request_id")


# A message is what a request id's last three digits say, so users click on the same one again.


@query(
    "feedback_latest",
    f"""WITH {_F}, m AS (SELECT *, right(request_id, 3) AS message_id, user_id::BIGINT % 20 AS clicker FROM f)
    SELECT message_id, clicker, id, is_helpful, "timestamp" FROM
    (SELECT *, row_number() OVER (PARTITION BY message_id, clicker ORDER BY "timestamp" DESC, id DESC) AS r FROM m) WHERE r = 1""",
)
def feedback_latest(spark, sf):
    clicks = given_feedback(spark, sf).withColumns(
        {"message_id": F.right("request_id", F.lit(3)), "clicker": F.col("user_id").cast("bigint") % 20}
    )
    return fb.latest_feedback(clicks, "message_id", "clicker").select("message_id", "clicker", "id", "is_helpful", "timestamp")


_DAILY = f"""WITH {_Q}, {_F}, {_VALID},
    a AS (SELECT "timestamp"::DATE AS date, count(*) AS total_queries, round(avg(response_time_ms), 6) AS avg_response_time_ms,
      count(DISTINCT user_id) AS unique_users FROM q GROUP BY 1),
    b AS (SELECT q."timestamp"::DATE AS date, count(*) FILTER (is_helpful) AS up, count(*) FILTER (NOT is_helpful) AS down
      FROM v JOIN q USING (request_id) GROUP BY 1),
    d AS (SELECT date, total_queries, avg_response_time_ms, unique_users, coalesce(up, 0) AS positive_feedback_count,
      coalesce(down, 0) AS negative_feedback_count FROM a LEFT JOIN b USING (date))"""


def _analysed(spark, sf):
    return analyse(asked_queries(spark, sf), given_feedback(spark, sf))


@query("daily_metrics", f"{_DAILY} SELECT * FROM d ORDER BY date")
def daily_metrics(spark, sf):
    return _first(_analysed(spark, sf).daily(), "avg_response_time_ms")


@query(
    "positive_ratio",
    f"""{_DAILY} SELECT date, round(positive_feedback_count::DOUBLE
    / nullif(positive_feedback_count + negative_feedback_count, 0), 6) AS positive_ratio FROM d ORDER BY date""",
)
def positive_ratio(spark, sf):
    return _first(_analysed(spark, sf).positive_ratio(), "positive_ratio")


@query("question_frequency", f"WITH {_Q} SELECT query_text, count(*) AS query_count FROM q GROUP BY 1")
def question_frequency(spark, sf):
    return fb.question_counts(asked_queries(spark, sf))


@query(
    "top_questions",
    f"WITH {_Q} SELECT query_text, count(*) AS query_count FROM q GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {fixed.TOP_QUESTIONS}",
)
def top_questions(spark, sf):
    return _analysed(spark, sf).top_questions()


@query(
    "daily_usage",
    f"""WITH l AS ({LOG_SQL}) SELECT ts::DATE AS date, count(*) AS requests, count(DISTINCT user_id) AS active_users,
    sum(output_tokens)::BIGINT AS output_tokens FROM l GROUP BY 1""",
)
def daily_usage(spark, sf):
    return fb.daily_usage(request_log(spark, sf))


@query(
    "labelled_training_set",
    "SELECT doc_id, lang, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0",
)
def labelled_training_set(spark, sf):
    kept = fb.labelled_training_set(inputs.table(spark, sf, "documents"), inputs.table(spark, sf, "labels"))
    return kept.select("doc_id", "lang", "text")


@query(
    "request_log_metadata",
    f"""WITH {_Q} SELECT request_id, sha256('salt' || user_id) AS user_hash, length(query_text)::INTEGER AS query_length,
    length(response_text)::INTEGER AS response_length, "timestamp" FROM q""",
)
def request_log_metadata(spark, sf):
    return fb.log_metadata(asked_queries(spark, sf), "salt")


@query("feedback_export", f"WITH {_F} SELECT id, request_id, rating, is_helpful, comment FROM f")
def feedback_export(spark, sf):
    path = new_path(spark, "export")
    dated = given_feedback(spark, sf).withColumn("date", F.to_date("timestamp"))
    store.export(dated, path, by=["date"])
    back = spark.read.options(header="true", escape='"', enforceSchema="false").schema(dated.schema).csv(path)
    return back.select("id", "request_id", "rating", "is_helpful", "comment")


@query(
    "usage_anomalies",
    """WITH d AS (SELECT event_type, ts::DATE AS date, count(*) AS n FROM events GROUP BY ALL)
    SELECT event_type, date, n, round((n - avg(n) OVER w) / nullif(stddev_samp(n) OVER w, 0), 6) AS zscore FROM d
    WINDOW w AS (PARTITION BY event_type ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def usage_anomalies(spark, sf):
    events = inputs.table(spark, sf, "events")
    daily = events.groupBy("event_type", F.to_date("ts").alias("date")).agg(F.count("*").alias("n"))
    return _first(alerts.trailing_zscore(daily, ["event_type"], "date", "n"), "zscore")


_SPANS = " UNION ALL ".join(
    f"SELECT '{span}' AS span, date_trunc('{span}', ts)::DATE AS start, count(DISTINCT user_id) AS active_users FROM events GROUP BY 2"
    for span in ("day", "week", "month")
)


@query("active_users_rollup", _SPANS)
def active_users_rollup(spark, sf):
    daily = durable(sketches.daily_users(inputs.table(spark, sf, "events")), "daily-users")
    out = None
    for span in ("day", "week", "month"):
        part = sketches.users_of(daily, F.date_trunc(span, "date").cast("date")).select(F.lit(span).alias("span"), F.col("span").alias("start"), "active_users")
        out = part if out is None else out.unionByName(part)
    return out


# --- conversations


@query(
    "chat_history",
    """SELECT conv_id, turn, coalesce(string_agg(CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || text,
      chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history
    FROM conversations""",
)
def chat_history(spark, sf):
    return conversation.with_history(inputs.table(spark, sf, "conversations")).select("conv_id", "turn", "history")


_LINES = """l AS (SELECT *, CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || text AS line FROM conversations),
    o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l)"""


@query(
    "chat_history_offsets",
    f"""WITH {_LINES} SELECT conv_id, turn, sha256(coalesce(line, '')) AS line_hash, start, start + coalesce(length(line), 0) AS "end" FROM o""",
)
def chat_history_offsets(spark, sf):
    told = conversation.with_offsets(inputs.table(spark, sf, "conversations"))
    return told.select("conv_id", "turn", F.sha2(F.coalesce("line", F.lit("")), 256).alias("line_hash"), "start", "end")


@query(
    "chat_requests",
    f"""WITH {_LINES}, h AS (SELECT *, coalesce(string_agg(line, chr(10))
      OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history FROM l)
    SELECT conv_id, turn, text, history FROM h WHERE role = 'user'""",
)
def chat_requests(spark, sf):
    return conversation.user_requests(inputs.table(spark, sf, "conversations"))


_PAIRS = """SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer FROM conversations u
    JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'"""


@query("qa_pairs", _PAIRS)
def qa_pairs(spark, sf):
    return conversation.question_answer_pairs(inputs.table(spark, sf, "conversations"))


@query("accepted_input", "SELECT conv_id, turn, role FROM conversations WHERE trim(text) <> ''")
def accepted_input(spark, sf):
    return conversation.accepted_input(inputs.table(spark, sf, "conversations")).select("conv_id", "turn", "role")


# --- verdicts on responses: every user turn is a case. Of ten conversations one expects words
# no answer has, and one has a malformed pattern; of seven one got an error status. The others
# expect one of the words asked.
_TEST = "conv_id * 1000 + turn"
_PATTERN = """CASE conv_id % 10 WHEN 3 THEN 'qqq|zzz' WHEN 4 THEN '(' || turn
      ELSE array_to_string(regexp_extract_all(text, '\\p{L}+'), '|') END"""
_VERDICTS = f"""WITH pairs AS ({_PAIRS}),
    c AS (SELECT {_TEST} AS test, {_PATTERN} AS pattern FROM conversations WHERE role = 'user'),
    r AS (SELECT {_TEST} AS test, CASE conv_id % 7 WHEN 2 THEN 503 ELSE 200 END AS code, answer FROM pairs),
    met AS (SELECT test, code, pattern, answer, code = 200 AND pattern LIKE '(%' AS bad,
        regexp_matches(answer, CASE WHEN pattern LIKE '(%' THEN 'x' ELSE pattern END, 'i') AS met FROM c LEFT JOIN r USING (test)),
    judged AS (SELECT test, CASE WHEN code IS NULL OR bad THEN 'ERROR' WHEN code <> 200 OR NOT met THEN 'FAIL' ELSE 'PASS' END AS status,
      CASE WHEN code IS NULL THEN 'no response' WHEN code <> 200 THEN 'API returned status code ' || code
        WHEN bad THEN 'missing ), unterminated subpattern at position 0'
        WHEN NOT met THEN 'Response did not match expected pattern' END AS reason,
      CASE WHEN code = 200 AND NOT bad THEN substr(answer, 1, 100) || '...' END AS response,
      CASE WHEN code = 200 AND NOT bad AND NOT met THEN pattern END AS expected_pattern FROM met)"""


def _judged(spark, sf):
    turns = inputs.table(spark, sf, "conversations")
    test = F.expr(_TEST).alias("test")
    kind, words = F.col("conv_id") % 10, F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    pattern = (
        F.when(kind == 3, "qqq|zzz").when(kind == 4, F.concat(F.lit("("), F.col("turn").cast("string"))).otherwise(F.array_join(words, "|"))
    )
    cases = turns.filter("role = 'user'").select(test, pattern.alias("expected_pattern"))
    responses = conversation.question_answer_pairs(turns).select(
        test, F.when(F.col("conv_id") % 7 == 2, 503).otherwise(200).alias("status_code"), F.col("answer").alias("response")
    )
    return evaluation.verdicts(cases, responses)


@query("synthetic_verdicts", f"{_VERDICTS} SELECT * FROM judged")
def synthetic_verdicts(spark, sf):
    return _judged(spark, sf)


@query("synthetic_summary", f"{_VERDICTS} SELECT count(*) FILTER (status = 'PASS') AS passed, count(*) AS total FROM judged")
def synthetic_summary(spark, sf):
    return evaluation.verdict_summary(_judged(spark, sf))


@query(
    "dont_know_rate",
    """SELECT turn, count(*) AS responses,
      round(avg(regexp_matches(text, 'don''t know|cannot answer|insufficient information', 'i')::INTEGER), 6) AS dont_know_rate
    FROM conversations WHERE role = 'assistant' GROUP BY 1""",
)
def dont_know_rate(spark, sf):
    answers = inputs.table(spark, sf, "conversations").filter("role = 'assistant'")
    return _first(evaluation.dont_know_rate(answers, "text", ["turn"]), "dont_know_rate")


@query(
    "dont_know_flag",
    """SELECT conv_id, turn, regexp_matches(text, 'don''t know|cannot answer|insufficient information', 'i') AS gave_up
    FROM conversations""",
)
def dont_know_flag(spark, sf):
    return inputs.table(spark, sf, "conversations").select("conv_id", "turn", tx.dont_know(F.col("text")).alias("gave_up"))
