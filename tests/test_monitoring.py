import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpuskit.operators import alerts, evaluation
from corpuskit.operators import feedback as fb
from corpuskit.operators import requests as rq

T0 = dt.datetime(2024, 1, 1)


def minute(n):
    return T0 + dt.timedelta(minutes=n)


def states(spark, met, hold, step=1):
    rows = [("s", minute(m), v) for m, v in met.items()]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, met boolean")
    got = alerts.sustained(df, ["series"], "ts", F.col("met"), hold, step).orderBy("ts").collect()
    return "".join(r.state[0] for r in got)


def test_alert_needs_to_hold(spark):
    assert states(spark, {0: False, 1: True, 2: True, 3: True, 4: True, 5: False, 6: True}, 2) == "ippffip"


def test_gap_and_unknown_end_a_run(spark):
    assert states(spark, {0: True, 1: True, 3: True, 4: True, 5: None, 6: True}, 1) == "pfpfip"


def test_alert_true_from_the_start(spark):
    assert states(spark, {0: True, 1: True, 2: True}, 2) == "ppf"
    assert states(spark, {0: True}, 0) == "f"


def test_gauge_rules(spark):
    gauges = spark.createDataFrame([("gpu", minute(i), 95.0) for i in range(17)] + [("disk", minute(0), 9.0)],
                                   "series string, ts timestamp_ntz, value double")
    rules = spark.createDataFrame([("gpu", ">", 90.0, 15), ("disk", "<", 10.0, 5)],
                                  "series string, op string, threshold double, hold_minutes int")
    got = alerts.apply_rules(gauges, rules).groupBy("series", "state").count().collect()
    assert {(r.series, r.state): r["count"] for r in got} == {("gpu", "pending"): 15, ("gpu", "firing"): 2, ("disk", "pending"): 1}


def test_uneven_samples_fire(spark):
    rows = [("gpu_utilisation", minute(i) + dt.timedelta(seconds=(i * 37) % 50), 95.0) for i in range(20)]
    rows += [("disk_free", minute(i) + dt.timedelta(seconds=7), 5.0 if i else 50.0) for i in range(8)]
    rows += [("disk_size", minute(i) + dt.timedelta(seconds=40), 100.0) for i in range(8)] + [("gpu_utilisation", minute(900_000), 1.0)]
    gauges = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")
    got = alerts.infrastructure_alerts(gauges).orderBy("series", "ts").collect()
    states = {s: "".join(r.state[0] for r in got if r.series == s) for s in ("gpu_utilisation", "disk_free_percent")}
    assert states == {"gpu_utilisation": "p" * 15 + "f" * 5 + "i", "disk_free_percent": "ipppppff"}


def test_histogram_quantile_edges(spark):
    bounds = (1.0, 2.0, 4.0)
    rows = [("even", 10, 20, 20, 20), ("over", 0, 0, 0, 5), ("none", 0, 0, 0, 0), ("last", 0, 0, 8, 8)]
    df = spark.createDataFrame(rows, "g string, a int, b int, c int, n int")
    q = rq.histogram_quantile(0.75, [F.col(x) for x in "abc"], F.col("n"), bounds)
    got = {r.g: r.q for r in df.select("g", q.alias("q")).collect()}
    assert got == {"even": 1.5, "over": 4.0, "none": None, "last": 3.5}


def test_server_error_is_anchored(spark):
    df = spark.createDataFrame([("500",), ("599",), ("1500",), ("404",), ("5000",)], "s string")
    assert [r.e for r in df.select(rq.is_server_error(F.col("s")).alias("e")).collect()] == [True, True, False, False, False]


def test_windows_repeat_minutes_not_requests(spark, sf):
    from corpuskit.catalogue.inputs import request_log

    plan = rq.sliding(rq.minute_counts(request_log(spark, sf)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate")


def test_verdicts(spark):
    cases = spark.createDataFrame([(1, "vector|index"), (2, "x"), (3, "x"), (4, "x"), (5, "ü"), (6, "a(b")], "test int, expected_pattern string")
    responses = spark.createDataFrame([(1, 200, "An INDEX"), (2, 200, "no"), (3, 500, "x"), (5, 200, "Ü"), (6, 200, "ab")],
                                      "test int, status_code int, response string")
    judged = evaluation.verdicts(cases, responses)
    assert {r.test: (r.status, r.reason) for r in judged.filter("test < 6").collect()} == {
        1: ("PASS", None), 2: ("FAIL", "Response did not match expected pattern"),
        3: ("FAIL", "API returned status code 500"), 4: ("ERROR", "no response"), 5: ("PASS", None),
    }
    bad = judged.filter("test = 6").first()
    assert bad.status == "ERROR" and "unterminated" in bad.reason and bad.response is None
    failed = judged.filter("test = 2").first()
    assert failed.response == "no..." and failed.expected_pattern == "x"
    assert tuple(evaluation.verdict_summary(judged).first()) == (2, 6)


def test_perplexity_of_uniform_scores(spark):
    df = spark.createDataFrame([(-1.0,), (-1.0,)], "lp double")
    assert evaluation.logprob_perplexity(df, "lp").first()[0] == pytest.approx(2.718281828)


def test_stability_is_zero_without_drift(spark):
    df = spark.createDataFrame([(v, s) for v in (1, 5, 9) for s in (False, True)], "v int, s boolean")
    assert evaluation.population_stability(df, "v", F.col("s"), (3, 6)).first()[0] == pytest.approx(0)


def test_feedback_rules(spark):
    df = spark.createDataFrame([(1, None, T0), (2, 5, T0), (3, 0, None)], "id int, rating int, timestamp timestamp_ntz")
    got = {r.id: r.violations for r in fb.check_rows(df, fb.feedback_rules()).collect()}
    assert got == {1: [], 2: [], 3: ["timestamp_required", "rating_1_to_5"]}


def test_feedback_goes_to_the_first_query(spark):
    queries = spark.createDataFrame([(2, "r", T0), (1, "r", minute(-1))], "id long, request_id string, timestamp timestamp_ntz")
    given = spark.createDataFrame([(7, "r"), (8, "none")], "id long, request_id string")
    assert [(r.id, r.query_id) for r in fb.attach_feedback(given, queries).collect()] == [(7, 1)]
    assert [r.id for r in fb.orphan_feedback(given, queries).collect()] == [8]


def test_last_click_counts(spark):
    rows = [(1, "m", "u", True, minute(0)), (2, "m", "u", False, minute(1)), (3, "m", "u", True, minute(1)), (4, "m", "v", True, minute(0))]
    df = spark.createDataFrame(rows, "id long, message string, user_id string, is_helpful boolean, timestamp timestamp_ntz")
    got = fb.latest_feedback(df, "message", "user_id").collect()
    assert {(r.user_id, r.id, r.is_helpful) for r in got} == {("u", 3, True), ("v", 4, True)}


def test_ratio_without_feedback_is_null(spark):
    df = spark.createDataFrame([(T0.date(), 0, 0), (minute(2000).date(), 3, 1)],
                               "date date, positive_feedback_count int, negative_feedback_count int")
    assert [r.positive_ratio for r in fb.positive_ratio(df).orderBy("date").collect()] == [None, 0.75]
