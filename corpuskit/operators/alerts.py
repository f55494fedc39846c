"""Alerts: conditions that must hold for a while, and daily anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.operators import scan


def _minutes(n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(mins=n)


def last_per_step(df: DataFrame, series: list[str], ts: str, value: str, step_minutes: int) -> DataFrame:
    """The newest value of each series in each step, at the step's start.

    Samples need not be evenly spaced; of samples at the same time the larger counts. Partial
    results are merged, so the amount of samples in a step does not matter.
    """
    step = F.window(ts, f"{step_minutes} minutes").getField("start")
    newest = F.max(F.struct(F.col(ts).alias("at"), F.col(value).alias("v")))
    return df.groupBy(*series, step.alias("_step")).agg(newest.alias("_newest")).select(
        *series, F.col("_step").alias(ts), F.col("_newest.v").alias(value)
    )


def sustained(
    df: DataFrame,
    series: list[str],
    ts: str,
    condition: Column,
    hold_minutes: int | Column,
    step_minutes: int = 1,
) -> DataFrame:
    """``(series..., ts, state)`` with state inactive, pending or firing, a row per step with samples.

    Samples are brought to steps first, the newest in a step counting. A step without
    samples or an unknown condition ends a run. A run fires once it has held for
    ``hold_minutes``. When that is a column it must be one of ``series``.

    Rows here are evaluation times after aggregation, dealt over tasks by ranges of series and
    time, so neither one long series nor many short ones burden a task. An action.
    """
    keys = series or ["_all"]
    marked = df.withColumn("_all", F.lit(0)).select(*keys, ts, F.coalesce(condition, F.lit(False)).alias("_met"))
    known = scan.in_ranges(last_per_step(marked, keys, ts, "_met", step_minutes), keys, [ts], last=["_met"])
    seen = scan.previous(known, {"_before": ts, "_was_met": "_met"})
    gap = F.col("_before").isNull() | (F.col(ts) - F.col("_before") > _minutes(step_minutes))
    starts = F.when(F.col("_met") & (gap | ~F.col("_was_met")), F.col(ts))
    begun = scan.running(seen, {"_since": ("max", starts)})
    return begun.select(
        *series,
        ts,
        F.when(~F.col("_met"), "inactive")
        .when(F.col(ts) - F.col("_since") >= _minutes(hold_minutes), "firing")
        .otherwise("pending")
        .alias("state"),
    )


def apply_rules(gauges: DataFrame, rules: DataFrame, step_minutes: int = 1) -> DataFrame:
    """States of gauge series ``(series, ts, value)`` under ``rules(series, op, threshold,
    hold_minutes)``. Rules are configuration: written by hand, so few."""
    latest = last_per_step(gauges, ["series"], "ts", "value", step_minutes)
    value, threshold = F.col("value"), F.col("threshold")
    met = F.when(F.col("op") == ">", value > threshold).when(F.col("op") == "<", value < threshold)
    ruled = latest.join(F.broadcast(rules), "series")
    keys = ["series", "op", "threshold", "hold_minutes"]
    return sustained(ruled, keys, "ts", met, F.col("hold_minutes"), step_minutes).select(
        "series", "op", "threshold", "ts", "state"
    )


def percent_of(gauges: DataFrame, part: str, whole: str, name: str, step_minutes: int = 1) -> DataFrame:
    """A series ``name``: ``part`` as a percentage of ``whole``, step by step."""
    both = last_per_step(gauges.filter(F.col("series").isin(part, whole)), ["series"], "ts", "value", step_minutes)

    def of(series: str) -> Column:
        return F.max(F.when(F.col("series") == series, F.col("value")))

    share = F.try_divide(of(part) * 100, of(whole))
    return both.groupBy("ts").agg(share.alias("value")).select(F.lit(name).alias("series"), "ts", "value")


def infrastructure_alerts(
    gauges: DataFrame, gpu: str = "gpu_utilisation", disk_free: str = "disk_free", disk_size: str = "disk_size"
) -> DataFrame:
    """The two ready rules: a busy GPU for 15 minutes, little free disk for 5."""
    spark = gauges.sparkSession
    rules = [
        (gpu, ">", fixed.GPU_UTILISATION_LIMIT, fixed.GPU_HOLD_MINUTES),
        ("disk_free_percent", "<", fixed.DISK_FREE_PERCENT_LIMIT, fixed.DISK_HOLD_MINUTES),
    ]
    table = spark.createDataFrame(rules, "series string, op string, threshold double, hold_minutes int")
    free = percent_of(gauges, disk_free, disk_size, "disk_free_percent")
    return apply_rules(gauges.select("series", "ts", "value").unionByName(free), table)


def trailing_zscore(daily: DataFrame, by: list[str], date: str, value: str, days: int = 7) -> DataFrame:
    """Distance of each day from the mean of the days before, in standard deviations.

    NULL without two earlier days or without variation. A long series is cut into blocks that
    begin with the ``days`` rows before them. An action.
    """
    keys = by or ["_all"]
    rows = daily.withColumn("_all", F.lit(0)).select(*dict.fromkeys([*keys, date, value]))
    dealt = scan.blocks_with_rows_before(rows, keys, [date], days)
    before = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-days, -1)
    mean, deviation = F.avg(value).over(before), F.stddev_samp(value).over(before)
    scored = dealt.withColumn("zscore", F.try_divide(F.col(value) - mean, deviation)).filter(~F.col("_lead"))
    return scored.select(*by, date, value, "zscore")
