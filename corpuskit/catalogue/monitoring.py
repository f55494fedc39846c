"""Queries over the request log: rates, errors, latency, tokens, alerts, drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.catalogue import inputs
from corpuskit.catalogue.inputs import LOG_SQL, cleaned_sql, request_log, threshold_sql, tokens_sql
from corpuskit.catalogue.registry import query
from corpuskit.functions.tokens import tokens
from corpuskit.operators import alerts, evaluation, sketches, splits
from corpuskit.operators import requests as rq
from corpuskit.plans.monitoring import monitor
from corpuskit.session import durable

_LOG = f"l AS ({LOG_SQL})"
_WIN = f"""WITH {_LOG}, w AS (SELECT *, unnest(range(5)) AS back FROM l),
    win AS (SELECT *, date_trunc('minute', ts) - to_minutes(back) AS window_start FROM w)"""


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("server_errors", f"WITH {_LOG} SELECT request_id, endpoint FROM l WHERE status BETWEEN 500 AND 599")
def server_errors(spark, sf):
    return request_log(spark, sf).filter(rq.is_server_error(F.col("status"))).select("request_id", "endpoint")


@query(
    "request_rate",
    f"""{_WIN} SELECT window_start, endpoint, count(*) AS requests, round(count(*) / 300.0::DOUBLE, 6) AS requests_per_s
    FROM win GROUP BY 1, 2""",
)
def request_rate(spark, sf):
    return _round(monitor(request_log(spark, sf)).rate(), "requests_per_s")


@query(
    "error_ratio",
    f"""{_WIN} SELECT window_start, endpoint, count(*) FILTER (status >= 500) AS errors,
      round(count(*) FILTER (status >= 500)::DOUBLE / count(*), 6) AS error_ratio FROM win GROUP BY 1, 2""",
)
def error_ratio(spark, sf):
    return _round(monitor(request_log(spark, sf)).errors(), "error_ratio")


_BOUNDS = ", ".join(f"({i}, {b}::DOUBLE, {([0.0, *fixed.LATENCY_BOUNDS])[i]}::DOUBLE)" for i, b in enumerate(fixed.LATENCY_BOUNDS))


def _quantile_sql(source: str, keys: str, q: float) -> str:
    """Bucket-interpolated quantile per key from the rows of a relation."""
    top = fixed.LATENCY_BOUNDS[-1]
    return f"""
    SELECT {keys}, coalesce(min_by(CASE WHEN c > below THEN lo + (hi - lo) * ({q}::DOUBLE * n - below) / (c - below) ELSE lo END, i)
      FILTER (c >= {q}::DOUBLE * n), {top}) AS x
    FROM (SELECT *, coalesce(lag(c) OVER (PARTITION BY {keys} ORDER BY i), 0) AS below FROM
      (SELECT {keys}, i, lo, hi, count(*) AS n, count(*) FILTER (duration_s <= hi) AS c
       FROM {source} CROSS JOIN (VALUES {_BOUNDS}) b(i, hi, lo) GROUP BY ALL)) GROUP BY {keys}"""


@query(
    "latency_quantiles",
    f"""{_WIN} SELECT window_start, endpoint, round(a.x, 6) AS p50, round(b.x, 6) AS p95
    FROM ({_quantile_sql('win', 'window_start, endpoint', 0.5)}) a
    JOIN ({_quantile_sql('win', 'window_start, endpoint', 0.95)}) b USING (window_start, endpoint)""",
)
def latency_quantiles(spark, sf):
    return _round(monitor(request_log(spark, sf)).latency(), "p50", "p95")


@query(
    "latency_quantiles_exact",
    f"""WITH {_LOG} SELECT endpoint, status, round(quantile_cont(duration_s, 0.5), 6) AS p50,
    round(quantile_cont(duration_s, 0.95), 6) AS p95 FROM l GROUP BY ALL""",
)
def latency_quantiles_exact(spark, sf):
    return _round(rq.exact_latency_quantiles(request_log(spark, sf), ["endpoint", "status"]), "p50", "p95")


# Windows of the test tables hold fewer values than a sketch keeps, so their quantiles are values of known rank.
@query(
    "latency_quantiles_sketch",
    f"""{_WIN} SELECT window_start, endpoint, count(duration_s) AS requests, quantile_disc(duration_s, 0.5) AS p50,
      quantile_disc(duration_s, 0.95) AS p95 FROM win GROUP BY 1, 2""",
)
def latency_quantiles_sketch(spark, sf):
    minutes = durable(sketches.latency_sketches(request_log(spark, sf)), "sketches")
    windows = sketches.sliding_sketches(minutes)
    return windows.select(
        "window_start", "endpoint", sketches.sketch_count().alias("requests"),
        sketches.sketch_quantile(0.5).alias("p50"), sketches.sketch_quantile(0.95).alias("p95"),
    )


@query(
    "latency_sketch_error",
    f"""WITH {_LOG} SELECT endpoint, count(*) AS n, true AS p50_within, true AS p95_within FROM l GROUP BY 1""",
)
def latency_sketch_error(spark, sf):
    log, wanted = request_log(spark, sf), {"p50": 0.5, "p95": 0.95}
    whole = sketches.merged_sketches(sketches.latency_sketches(log), "endpoint")
    stated = whole.select("endpoint", *[sketches.sketch_quantile(q).alias(n) for n, q in wanted.items()])
    errors = sketches.rank_errors(log, stated, wanted, ["endpoint"])
    return errors.select("endpoint", "n", *[(F.col(f"{n}_error") < 0.01).alias(f"{n}_within") for n in wanted])


_TOKEN_BOUNDS = ", ".join([f"('{b}', {b})" for b in fixed.TOKEN_BOUNDS] + ["('+Inf', 9000000000)"])


@query(
    "token_histogram",
    f"""{_WIN} SELECT window_start, le, count(*) FILTER (output_tokens <= b) AS responses,
      round(count(*) FILTER (output_tokens <= b) / 300.0::DOUBLE, 6) AS responses_per_s
    FROM win CROSS JOIN (VALUES {_TOKEN_BOUNDS}) t(le, b) GROUP BY 1, 2""",
)
def token_histogram(spark, sf):
    return _round(monitor(request_log(spark, sf)).tokens(), "responses_per_s")


_LE = "CASE " + " ".join(f"WHEN output_tokens <= {b} THEN '{b}'" for b in fixed.TOKEN_BOUNDS) + " ELSE '+Inf' END"


@query("output_length_distribution", f"WITH {_LOG} SELECT {_LE} AS le, count(*) AS responses FROM l GROUP BY 1")
def output_length_distribution(spark, sf):
    return rq.output_lengths(request_log(spark, sf))


_STATES = """opened AS (SELECT *, NOT met OR coalesce(ts - lag(ts) OVER u > to_minutes({step}), true) AS opens
      FROM (SELECT * REPLACE (coalesce(met, false) AS met) FROM vals) WINDOW u AS (PARTITION BY {keys} ORDER BY ts)),
    runs AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY {keys} ORDER BY ts) AS run FROM opened),
    aged AS (SELECT *, ts - min(ts) FILTER (met) OVER (PARTITION BY {keys}, run) AS age FROM runs),
    states AS (SELECT *, CASE WHEN NOT met THEN 'inactive' WHEN age >= to_minutes({hold}) THEN 'firing' ELSE 'pending' END AS state FROM aged)"""


@query(
    "alert_sustained",
    f"""{_WIN}, vals AS (
      SELECT 'high_error_rate' AS alert, window_start AS ts, count(*) FILTER (status >= 500)::DOUBLE / count(*) > {fixed.ERROR_RATIO_LIMIT} AS met
      FROM win GROUP BY 2
      UNION ALL SELECT 'slow_response', window_start, x > {fixed.P95_LIMIT_SECONDS} FROM ({_quantile_sql('win', 'window_start', 0.95)})),
    {_STATES.format(keys='alert', step=1, hold=5)} SELECT alert, ts, state FROM states""",
)
def alert_sustained(spark, sf):
    return monitor(request_log(spark, sf)).alerts()


# Events are the samples of one gauge per event type, at whatever times they came.
_RULES = [("view", ">", 45.0, 120), ("error", ">", 50.0, 60), ("purchase", "<", 55.0, 180)]


@query(
    "alert_rules",
    f"""WITH g AS (SELECT series, ts, value FROM (SELECT event_type AS series, date_trunc('hour', ts) AS ts, value,
        row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY e.ts DESC, value DESC) AS r FROM events e) WHERE r = 1),
    rules AS (SELECT * FROM (VALUES {", ".join(str(r) for r in _RULES)}) r(series, op, threshold, hold)),
    vals AS (SELECT series, op, threshold, hold, ts, CASE op WHEN '>' THEN value > threshold ELSE value < threshold END AS met
      FROM g JOIN rules USING (series)),
    {_STATES.format(keys='series, op, threshold, hold', step=60, hold='hold')}
    SELECT series, op, threshold::DOUBLE AS threshold, ts, state FROM states""",
)
def alert_rules(spark, sf):
    gauges = inputs.table(spark, sf, "events").select(F.col("event_type").alias("series"), "ts", "value")
    rules = spark.createDataFrame(_RULES, "series string, op string, threshold double, hold_minutes int")
    return alerts.apply_rules(gauges, rules, step_minutes=60)


_SPLIT_TOKENS = f"""t AS (SELECT split, unnest(tk) AS token FROM
    (SELECT {threshold_sql('doc_id')} AS split, {tokens_sql(cleaned_sql('text'))} AS tk FROM documents)),
    tr AS (SELECT token, count(*) AS seen FROM t WHERE split = 'train' GROUP BY 1)"""


@query(
    "perplexity",
    f"""WITH {_SPLIT_TOKENS}, n AS (SELECT sum(seen) AS total, count(*) AS types FROM tr)
    SELECT count(*) AS tokens, round(exp(-avg(ln((coalesce(seen, 0) + 1)::DOUBLE / (total + types + 1)))), 4) AS perplexity
    FROM t LEFT JOIN tr USING (token) CROSS JOIN n WHERE split = 'validation'""",
)
def perplexity(spark, sf):
    split = splits.threshold_split(inputs.table(spark, sf, "documents"), "doc_id")
    parts = split.select("split", tokens(F.col("text")).alias("tokens"))
    scored = evaluation.perplexity(parts.filter("split = 'train'"), parts.filter("split = 'validation'"))
    return scored.withColumn("perplexity", F.round("perplexity", 4))


_PSI_BOUNDS = (10, 20, 40, 80, 160)
_PSI_BUCKET = "CASE " + " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(_PSI_BOUNDS)) + f" ELSE {len(_PSI_BOUNDS)} END"


@query(
    "psi_drift",
    f"""WITH e AS (SELECT event_type, {_PSI_BUCKET} AS b, ts >= TIMESTAMP '2024-01-16' AS second FROM events),
    n AS (SELECT event_type, count(*) FILTER (NOT second) AS n0, count(*) FILTER (second) AS n1 FROM e GROUP BY 1),
    c AS (SELECT n.event_type, g.b, greatest(count(e.b) FILTER (NOT second), 0.5) / any_value(n0) AS p,
        greatest(count(e.b) FILTER (second), 0.5) / any_value(n1) AS q
      FROM n CROSS JOIN range({len(_PSI_BOUNDS) + 1}) g(b) LEFT JOIN e ON e.event_type = n.event_type AND e.b = g.b GROUP BY 1, 2)
    SELECT event_type, round(sum((p - q) * ln(p::DOUBLE / q)), 6) AS psi FROM c GROUP BY 1""",
)
def psi_drift(spark, sf):
    second = F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    return _round(
        evaluation.population_stability(inputs.table(spark, sf, "events"), "value", second, _PSI_BOUNDS, ["event_type"]),
        "psi",
    )


@query(
    "ks_drift",
    """WITH c AS (SELECT event_type, value, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS a,
        count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS b FROM events GROUP BY 1, 2),
    s AS (SELECT event_type, sum(a) OVER w AS fa, sum(b) OVER w AS fb, sum(a) OVER (PARTITION BY event_type) AS na,
        sum(b) OVER (PARTITION BY event_type) AS nb FROM c WINDOW w AS (PARTITION BY event_type ORDER BY value))
    SELECT event_type, max(na)::BIGINT AS n_first, max(nb)::BIGINT AS n_second, round(max(abs(fa::DOUBLE / na - fb::DOUBLE / nb)), 6) AS distance
    FROM s GROUP BY 1""",
)
def ks_drift(spark, sf):
    second = F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))
    return _round(evaluation.distribution_distance(inputs.table(spark, sf, "events"), "value", second, ["event_type"]), "distance")


_STEP_RUNS = """opened AS (SELECT *, NOT met OR coalesce(ts - lag(ts) OVER u > INTERVAL 15 MINUTE, true) AS opens
      FROM vals WINDOW u AS (ORDER BY ts)),
    runs AS (SELECT *, count(*) FILTER (opens) OVER (ORDER BY ts) AS run FROM opened),
    aged AS (SELECT *, ts - min(ts) FILTER (met) OVER (PARTITION BY run) AS age FROM runs)"""


# All events as one long series, so that running values have to cross ranges of one key.
@query(
    "alert_long_series",
    f"""WITH k AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS step, ts, value > 20 AS met FROM events),
    vals AS (SELECT step AS ts, met FROM (SELECT *, row_number() OVER (PARTITION BY step ORDER BY ts DESC, met DESC) AS r FROM k) WHERE r = 1),
    {_STEP_RUNS}
    SELECT ts, CASE WHEN NOT met THEN 'inactive' WHEN age >= INTERVAL 45 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM aged""",
)
def alert_long_series(spark, sf):
    events = inputs.table(spark, sf, "events")
    return alerts.sustained(events, [], "ts", F.col("value") > 20, 45, step_minutes=15)


# A sample a minute from each event: a GPU that is often busy, and a disk of which its value is free.
_GAUGES = f"""g AS (SELECT TIMESTAMP '2024-01-01' + to_minutes(event_id::INTEGER) AS ts, value FROM events),
    raw AS (SELECT 'gpu_utilisation' AS series, '>' AS op, {fixed.GPU_UTILISATION_LIMIT}::DOUBLE AS threshold, {fixed.GPU_HOLD_MINUTES} AS hold, ts, value * 10 AS v FROM g
      UNION ALL SELECT 'disk_free_percent', '<', {fixed.DISK_FREE_PERCENT_LIMIT}, {fixed.DISK_HOLD_MINUTES}, ts, value * 100 / 500.0::DOUBLE FROM g),
    vals AS (SELECT *, CASE op WHEN '>' THEN v > threshold ELSE v < threshold END AS met FROM raw)"""


@query(
    "infrastructure_alerts",
    f"""WITH {_GAUGES}, {_STATES.format(keys='series', step=1, hold='hold')}
    SELECT series, op, threshold, ts, state FROM states""",
)
def infrastructure_alerts(spark, sf):
    minute = F.make_dt_interval(mins=F.col("event_id").cast("int"))
    samples = {"gpu_utilisation": F.col("value") * 10, "disk_free": F.col("value"), "disk_size": F.lit(500.0)}
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("series"), v.alias("value")) for n, v in samples.items()]))
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    return alerts.infrastructure_alerts(inputs.table(spark, sf, "events").select((start + minute).alias("ts"), rows))
