"""Request windows, late rows and sustained alerts on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from corpuskit import fixed
from corpuskit.operators.requests import is_server_error, latency_quantile
from corpuskit.operators.sketches import SKETCH_K

WATERMARK = "10 minutes"


def stream_windows(log: DataFrame, slide: str | None = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Per endpoint and 5-minute window: requests, errors, p95, once the window is closed.

    ``log.ts`` must be a timestamp with time zone. Rows later than the watermark are
    dropped. State is one row of counters per open window and endpoint. With ``slide``,
    requests are counted per slide first and those counts go into the windows, so a request
    is not repeated for every window it lies in.
    """
    width = f"{fixed.RATE_WINDOW_MINUTES} minutes"
    bounds = fixed.LATENCY_BOUNDS
    counts = [F.count_if(F.col("duration_s") <= F.lit(b)).alias(f"lat_{i}") for i, b in enumerate(bounds)]
    first = F.window("ts", slide or width).alias("w")
    windows = (
        log.withWatermark("ts", watermark)
        .groupBy(first, "endpoint")
        .agg(F.count("*").alias("requests"), F.count_if(is_server_error(F.col("status"))).alias("errors"), *counts)
    )
    if slide:
        sums = [F.sum(c).alias(c) for c in ("requests", "errors", *[f"lat_{i}" for i in range(len(bounds))])]
        windows = windows.groupBy(F.window(F.window_time("w"), width, slide).alias("w"), "endpoint").agg(*sums)
    return windows.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "endpoint",
        "requests",
        "errors",
        (F.col("requests") / (60.0 * fixed.RATE_WINDOW_MINUTES)).alias("requests_per_s"),
        F.try_divide("errors", "requests").alias("error_ratio"),
        latency_quantile(0.95).alias("p95"),
    )


def stream_sketches(log: DataFrame, width: str, watermark: str = WATERMARK, k: int = SKETCH_K) -> DataFrame:
    """``(window_start, endpoint, sketch)`` once a window is closed: a KLL sketch of its durations.

    Sketches of closed windows merge with :func:`~corpuskit.operators.sketches.merged_sketches` to
    those of any longer time. NULL and NaN are left out.
    """
    v = F.col("duration_s").cast("double")
    timed = log.withWatermark("ts", watermark).filter(v.isNotNull() & ~F.isnan(v))
    made = timed.groupBy(F.window("ts", width).alias("w"), "endpoint").agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))
    return made.select(F.col("w.start").alias("window_start"), "endpoint", "sketch")


def late_rows(log: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of the batch table that no closed tumbling window of the stream counted,
    apart from windows still open. Both sides are counted before they meet."""
    width = f"{fixed.RATE_WINDOW_MINUTES} minutes"
    expected = log.groupBy(F.window("ts", width).getField("start").alias("window_start"), "endpoint").agg(
        F.count("*").alias("expected")
    )
    counted = windows.select("window_start", "endpoint", F.col("requests").alias("counted"))
    last_closed = windows.agg(F.max("window_start")).scalar()
    return (
        expected.join(counted, ["window_start", "endpoint"], "left")
        .filter(F.col("window_start") <= last_closed)
        .agg(
            F.sum("expected").alias("rows"),
            (F.sum("expected") - F.coalesce(F.sum("counted"), F.lit(0))).alias("late_rows"),
        )
    )


class LateQuarantine:
    """A ``foreachBatch`` sink that parts rows on time from rows whose window was closed before they came.

    A window is closed once the newest time of all earlier batches, less ``delay``, has passed
    its end. Each batch leaves its newest time behind, one row, from which the next ones take
    their mark; a batch that runs again finds the same mark and replaces its own folders. Rows
    without a time belong to no window and are quarantined too.
    """

    def __init__(self, folder: str, delay: str = WATERMARK, width: str = f"{fixed.RATE_WINDOW_MINUTES} minutes"):
        self.folder, self.delay, self.width = folder, delay, width

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.agg(F.max("ts").alias("newest")).filter("newest is not null")
        newest.write.mode("overwrite").parquet(f"{self.folder}/marks/batch={batch_id}")
        marks = spark.read.schema("newest timestamp, batch bigint").parquet(f"{self.folder}/marks")
        before = marks.filter(F.col("batch") < batch_id).agg(F.max("newest").alias("newest"))
        mark = before.select(F.col("newest") - F.expr(f"INTERVAL {self.delay}")).scalar()
        # A window of a missing time would drop its row.
        end = F.window(F.coalesce("ts", F.lit(0).cast("timestamp")), self.width).getField("end")
        late = F.col("ts").isNull() | F.coalesce(end <= mark, F.lit(False))
        told = batch.withColumn("part", F.when(late, "late").otherwise("on_time")).withColumn("batch", F.lit(batch_id))
        writer = told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch")
        writer.parquet(f"{self.folder}/rows")

    def rows(self, like: DataFrame, part: str) -> DataFrame:
        """The rows ``late`` or ``on_time``, with the columns of ``like``."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        written = like.sparkSession.read.schema(f"{columns}, part string, batch bigint").parquet(f"{self.folder}/rows")
        return written.filter(F.col("part") == part).select(*like.columns)


class _States(StatefulProcessor):
    """Alert states of one series: a value state for its run and a timer for its silence."""

    def __init__(self, series: str, hold_us: int, step_us: int):
        self.series, self.hold, self.step = series, hold_us, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "last bigint, since bigint")

    def _told(self, key: tuple, at: list[int], states: list[str]) -> pd.DataFrame:
        ts = pd.to_datetime(pd.Series(at, dtype="int64"), unit="us")
        return pd.DataFrame({self.series: [key[0]] * len(at), "ts": ts, "state": states})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        last, since = self.run.get() if self.run.exists() else (None, None)
        # Two numbers for each evaluation: aggregates of one series that came in one batch, not requests.
        came = sorted((int(t.value // 1000), bool(m)) for frame in rows for t, m in zip(frame["ts"], frame["met"]))
        at, states = [], []
        for ts, met in came:
            if last is not None and ts <= last:
                continue
            if last is not None and ts - last > self.step:
                if since is not None:
                    at.append(last + self.step)
                    states.append("inactive")
                since = None
            since = (ts if since is None else since) if met else None
            last = ts
            at.append(ts)
            states.append("inactive" if since is None else "firing" if ts - since >= self.hold else "pending")
        if at:
            self.run.update((last, since))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(-(-(last + self.step) // 1000))
            yield self._told(key, at, states)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, since = self.run.get()
        self.run.clear()
        if since is not None:
            yield self._told(key, [last + self.step], ["inactive"])

    def close(self) -> None:
        pass


def stream_alerts(
    evaluations: DataFrame,
    met: Column,
    hold_minutes: int,
    step_minutes: int = 1,
    series: str = "endpoint",
    watermark: str = "0 seconds",
) -> DataFrame:
    """``(series, ts, state)`` per evaluation, as in the batch form, from a stream of
    ``(series, ts, ...)`` rows, and a row where a series that was pending or firing falls silent.

    Evaluations of a series come in time order across batches; one at or before the last is
    left out, and so are those later than ``watermark``. A series without an evaluation one step
    after its last is inactive from then on: told at once when a later evaluation shows the gap,
    else by a timer when the watermark passes it. The timer also removes the state, so state
    holds the series that are heard of, not all there ever were.

    The state store must be RocksDB, which :func:`~corpuskit.streaming.ingest.write_available` sets.
    """
    minute = 60_000_000
    timed = evaluations.select(F.col(series).cast("string").alias(series), "ts", F.coalesce(met, F.lit(False)).alias("met"))
    return (
        timed.withWatermark("ts", watermark)
        .groupBy(series)
        .transformWithStateInPandas(
            _States(series, hold_minutes * minute, step_minutes * minute),
            f"{series} string, ts timestamp, state string",
            "append",
            "eventtime",
        )
    )
