"""Summaries that merge: latency quantiles and active users over any span, from small rows per minute or day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# KLL with this k keeps all of up to that many values; beyond, a rank is off by less than
# 1 % of the values (0.7 % is expected at 99 % confidence).
SKETCH_K = 400


def latency_sketches(log: DataFrame, by: Sequence[str] = ("endpoint",), value: str = "duration_s", k: int = SKETCH_K) -> DataFrame:
    """``(minute, by..., sketch)``: a KLL sketch of each minute's values, merged within tasks first.

    NULL and NaN are left out; a minute with no other value has no row.
    """
    minute = F.window("ts", "1 minute").getField("start").alias("minute")
    v = F.col(value).cast("double")
    held = log.filter(v.isNotNull() & ~F.isnan(v))
    return held.groupBy(minute, *by).agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, *by: str | Column, k: int = SKETCH_K) -> DataFrame:
    """Sketches of any coarser grouping: days, weeks, all endpoints together."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sliding_sketches(sketches: DataFrame, by: Sequence[str] = ("endpoint",), width: int = 5, k: int = SKETCH_K) -> DataFrame:
    """Sketches of windows of ``width`` minutes that start every minute: minutes are repeated, not requests."""
    back = F.expr(f"minute - make_dt_interval(0, 0, {width - 1})")
    starts = F.sequence(back, F.col("minute"), F.expr("interval 1 minute"))
    return merged_sketches(sketches.withColumn("window_start", F.explode(starts)), "window_start", *by, k=k)


def sketch_quantile(q: float, sketch: str = "sketch") -> Column:
    """The value at rank ``ceil(q * n)`` or one close to it."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def sketch_count(sketch: str = "sketch") -> Column:
    return F.kll_sketch_get_n_double(sketch)


def rank_errors(log: DataFrame, quantiles: DataFrame, wanted: dict[str, float], by: Sequence[str], value: str = "duration_s") -> DataFrame:
    """``(by..., n, <name>_error)``: how far the rank of each stated quantile is from the wanted one.

    Ties give a value a range of ranks, of which the nearest counts. Quantiles are one row per
    key; values are counted against them within tasks.
    """
    v = F.col(value).cast("double")
    met = log.filter(v.isNotNull() & ~F.isnan(v)).select(*by, v.alias("_v")).join(quantiles.select(*by, *wanted), list(by))
    counts = [f(F.col("_v"), F.col(n)).alias(f"_{n}_{side}") for n in wanted for side, f in (("under", lambda a, b: F.count_if(a < b)), ("upto", lambda a, b: F.count_if(a <= b)))]
    ranks = met.groupBy(*by).agg(F.count("*").alias("n"), *counts)

    def off(name: str, q: float) -> Column:
        under, upto = F.col(f"_{name}_under") / F.col("n"), F.col(f"_{name}_upto") / F.col("n")
        return F.greatest(under - q, q - upto, F.lit(0.0)).alias(f"{name}_error")

    return ranks.select(*by, "n", *[off(n, q) for n, q in wanted.items()])


def daily_users(log: DataFrame, user: str = "user_id", by: Sequence[str] = ()) -> DataFrame:
    """``(date, by..., bucket, users)``: bitmaps of the numbered users of each day.

    Exact. A bitmap holds the users of one bucket of 32,768 numbers, so numbers that lie close
    together cost a bit each. Rows without a user or a time are left out.
    """
    number = F.col(user).cast("bigint")
    held = log.filter(number.isNotNull() & F.col("ts").isNotNull())
    return held.groupBy(F.to_date("ts").alias("date"), *by, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users")
    )


def users_of(daily: DataFrame, span: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(span, by..., active_users)``: distinct users of any span of days, from the days' bitmaps alone."""
    spans = daily.groupBy(span.alias("span"), *by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return spans.groupBy("span", *by).agg(F.sum(F.bitmap_count("users")).cast("bigint").alias("active_users"))


def daily_user_sketches(log: DataFrame, user: str = "user_id", by: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """``(date, by..., users)``: as :func:`daily_users` for users of any name, as HyperLogLog sketches (off by about 1 %)."""
    held = log.filter(F.col(user).isNotNull() & F.col("ts").isNotNull())
    return held.groupBy(F.to_date("ts").alias("date"), *by).agg(F.hll_sketch_agg(F.col(user).cast("string"), F.lit(lg_k)).alias("users"))


def users_of_sketches(daily: DataFrame, span: Column, by: Sequence[str] = ()) -> DataFrame:
    """``(span, by..., active_users)``, estimated."""
    return daily.groupBy(span.alias("span"), *by).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("active_users"))
