"""Service monitoring: windows, quantiles, histograms and alert states of a request log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.operators import requests as ops
from corpuskit.operators.alerts import sustained
from corpuskit.session import durable


def service_alerts(minutes: DataFrame, hold_minutes: int = 5) -> DataFrame:
    """``(alert, ts, state)`` of the error-rate and the slow-response alert over all endpoints."""
    overall = ops.sliding(minutes.drop("endpoint"), by=())
    met = {
        "high_error_rate": ops.error_share() > fixed.ERROR_RATIO_LIMIT,
        "slow_response": ops.latency_quantile(0.95) > fixed.P95_LIMIT_SECONDS,
    }
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("alert"), m.alias("met")) for name, m in met.items()]))
    return sustained(
        overall.select(F.col("window_start").alias("ts"), each), ["alert"], "ts", F.col("met"), hold_minutes
    )


@dataclass(frozen=True)
class Monitoring:
    """Figures of a log, each worked out from per-minute counts when asked for.

    A figure reads the log with just the columns and counters it needs. With ``minutes``, the
    stored per-minute table, all figures come from that instead.
    """

    log: DataFrame
    minutes: DataFrame | None = None

    def _minutes(self, latency: bool = False, tokens: bool = False) -> DataFrame:
        return ops.minute_counts(self.log, latency=latency, tokens=tokens) if self.minutes is None else self.minutes

    def windows(self, latency: bool = False, tokens: bool = False) -> DataFrame:
        return ops.sliding(self._minutes(latency, tokens))

    def rate(self) -> DataFrame:
        return ops.request_rate(self.windows())

    def errors(self) -> DataFrame:
        return ops.error_ratio(self.windows())

    def latency(self) -> DataFrame:
        return ops.latency_quantiles(self.windows(latency=True))

    def tokens(self) -> DataFrame:
        return ops.token_histogram(self.windows(tokens=True))

    def alerts(self, hold_minutes: int = 5) -> DataFrame:
        return service_alerts(self._minutes(latency=True), hold_minutes)


def monitor(log: DataFrame, keep: bool = False) -> Monitoring:
    """Figures of ``log``; with ``keep`` it is read once, into the per-minute table, for several figures. That is an action."""
    return Monitoring(log, durable(ops.minute_counts(log), "minutes") if keep else None)
