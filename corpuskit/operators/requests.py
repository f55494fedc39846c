"""Rates, error ratios, latency and token histograms of a request log.

The log has ``ts, endpoint, status, duration_s, output_tokens``. Everything here starts
from per-minute counts: those merge within each task, so the shuffle holds one row per
task, minute and endpoint whatever the traffic, and a sliding window repeats minutes
instead of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.operators.quantiles import group_quantiles

WINDOW_MINUTES = fixed.RATE_WINDOW_MINUTES


def is_server_error(status: Column) -> Column:
    """Status codes 500 to 599, as text or number."""
    return status.cast("string").rlike(fixed.SERVER_ERROR)


def _bound_names(prefix: str, bounds: Sequence[float]) -> list[str]:
    return [f"{prefix}_{i}" for i in range(len(bounds))]


def minute_counts(
    log: DataFrame, by: Sequence[str] = ("endpoint",), latency: bool = True, tokens: bool = True
) -> DataFrame:
    """Per minute and key: requests, errors, and cumulative counts per bucket bound, those that are asked for."""

    def at_most(column: str, prefix: str, bounds: Sequence[float]) -> list[Column]:
        return [
            F.count_if(F.col(column) <= F.lit(b)).alias(n) for n, b in zip(_bound_names(prefix, bounds), bounds)
        ]

    minute = F.window("ts", "1 minute").getField("start").alias("minute")
    return log.groupBy(minute, *by).agg(
        F.count("*").alias("requests"),
        F.count_if(is_server_error(F.col("status"))).alias("errors"),
        *(at_most("duration_s", "lat", fixed.LATENCY_BOUNDS) if latency else []),
        *(at_most("output_tokens", "tok", fixed.TOKEN_BOUNDS) if tokens else []),
    )


def sliding(minutes: DataFrame, by: Sequence[str] = ("endpoint",), width: int = WINDOW_MINUTES) -> DataFrame:
    """Sums over windows of ``width`` minutes that start every minute."""
    back = F.expr(f"minute - make_dt_interval(0, 0, {width - 1})")
    starts = F.sequence(back, F.col("minute"), F.expr("interval 1 minute"))
    counts = [c for c in minutes.columns if c not in ("minute", *by)]
    return (
        minutes.withColumn("window_start", F.explode(starts))
        .groupBy("window_start", *by)
        .agg(*[F.sum(c).alias(c) for c in counts])
    )


def request_rate(windows: DataFrame, by: Sequence[str] = ("endpoint",), width: int = WINDOW_MINUTES) -> DataFrame:
    """Requests per second."""
    return windows.select(
        "window_start", *by, "requests", (F.col("requests") / (60.0 * width)).alias("requests_per_s")
    )


def error_share() -> Column:
    return F.try_divide("errors", "requests")


def error_ratio(windows: DataFrame, by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Share of requests that ended in a server error."""
    return windows.select("window_start", *by, "errors", error_share().alias("error_ratio"))


def histogram_quantile(q: float, cumulative: Sequence[Column], total: Column, bounds: Sequence[float]) -> Column:
    """Quantile read off cumulative bucket counts, linear within its bucket.

    Beyond the last bound the last bound is the answer; NULL without observations.
    """
    wanted = F.lit(q) * total
    out = F.when(total == 0, None)
    below, lower = F.lit(0), 0.0
    for count, upper in zip(cumulative, bounds):
        inside = (wanted - below) / F.nullif(count - below, F.lit(0))
        out = out.when(count >= wanted, F.coalesce(F.lit(lower) + F.lit(upper - lower) * inside, F.lit(lower)))
        below, lower = count, upper
    return out.otherwise(F.lit(float(bounds[-1])))


def latency_quantile(q: float) -> Column:
    """A latency quantile of a row of counts."""
    counts = [F.col(n) for n in _bound_names("lat", fixed.LATENCY_BOUNDS)]
    return histogram_quantile(q, counts, F.col("requests"), fixed.LATENCY_BOUNDS)


def latency_quantiles(windows: DataFrame, by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """p50 and p95 from the latency buckets."""
    return windows.select(
        "window_start", *by, latency_quantile(0.5).alias("p50"), latency_quantile(0.95).alias("p95")
    )


def exact_latency_quantiles(log: DataFrame, by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """p50 and p95 of all durations of a key, without buckets."""
    return group_quantiles(log, by, "duration_s", {"p50": 0.5, "p95": 0.95})


def token_histogram(windows: DataFrame, by: Sequence[str] = ("endpoint",), width: int = WINDOW_MINUTES) -> DataFrame:
    """``(window_start, le, responses, responses_per_s)``: cumulative counts by output tokens."""
    bounds = [str(b) for b in fixed.TOKEN_BOUNDS] + ["+Inf"]
    counts = [F.col(n) for n in _bound_names("tok", fixed.TOKEN_BOUNDS)] + [F.col("requests")]
    buckets = F.array(*[F.struct(F.lit(b).alias("le"), c.alias("n")) for b, c in zip(bounds, counts)])
    return (
        windows.select("window_start", F.inline(buckets))
        .groupBy("window_start", "le")
        .agg(F.sum("n").alias("responses"))
        .withColumn("responses_per_s", F.col("responses") / (60.0 * width))
    )


def output_lengths(log: DataFrame, bounds: Sequence[int] = fixed.TOKEN_BOUNDS) -> DataFrame:
    """How many responses fall in each output-length bucket, each bucket up to its bound."""
    tokens = F.col("output_tokens")
    bucket = F.lit("+Inf")
    for b in reversed(bounds):
        bucket = F.when(tokens <= b, F.lit(str(b))).otherwise(bucket)
    return log.groupBy(bucket.alias("le")).agg(F.count("*").alias("responses"))
