"""Feedback paired with its query, whichever comes first; chat sessions; refreshed daily figures."""

from __future__ import annotations

import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpuskit.operators.feedback import first_query_ids
from corpuskit.operators.skew import skewed_join
from corpuskit.streaming.ingest import feed_available, keep_state_on_disk

# Queries that a task holds at once to pack them.
_HELD_BYTES = 32 << 20
_LISTS = {"_requests": "_request", "_ids": "query_id", "_times": "query_time"}


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Overwrites just the folders that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per bucket and slot of time of a task's queries, with their columns as lists, earliest query first."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _HELD_BYTES:
            yield from _pack(held)
            held, size = [], 0
    if held:
        yield from _pack(held)


def _pack(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["_bucket", "_slot"]
    rows = pa.Table.from_batches(batches).sort_by([(k, "ascending") for k in (*keys, "query_time")]).combine_chunks()
    if not rows.num_rows:
        return
    bucket, slot = (rows[k].to_numpy() for k in keys)
    starts = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(slot) != 0)))
    ends = pa.array(np.append(starts, rows.num_rows), pa.int32())
    packed = {"_bucket": rows["_bucket"].take(starts), "_first": rows["query_time"].take(starts)}
    packed |= {to: pa.ListArray.from_arrays(ends, rows[of].chunk(0)) for to, of in _LISTS.items()}
    yield from pa.table(packed).to_batches(max_chunksize=1_000)


def feedback_pairs(
    feedback: DataFrame,
    queries: DataFrame,
    within: str = "1 day",
    early: str = "1 hour",
    watermark: str = "1 hour",
    shares: int = 8,
    buckets: int = 100_800,
) -> DataFrame:
    """Arriving feedback with ``query_id`` and ``query_time`` of its query, both streams.

    Either may come first: feedback is kept until its query is there, and told without one
    (``is_orphan``) once the watermark shows that none can come any more. Feedback is dated up to
    ``within`` after its query and up to ``early`` before it; rows of either stream may arrive
    ``watermark`` late. These three bound the state. Of queries with one request id the first to
    arrive counts, as long as repeats come within ``watermark``.

    A request with very much feedback is spread over ``shares`` keys, for which its query is
    repeated; feedback without a request id is spread over many, none of them a query's.

    Queries that arrive in one batch are kept together, a row per bucket of request ids and slot of
    ``within`` and ``watermark``, so the repeats cost ``shares`` rows a bucket and not a query;
    feedback looks its query up in the rows of its bucket. Queries stay up to one slot longer for it.
    Neither ``shares`` nor ``buckets`` may change while a stream goes on. If the number of the stream's
    partitions divides that of buckets, no two tasks have queries of one bucket. Batches with fewer
    queries than buckets save nothing and cost a little; streams of such want fewer buckets.
    """
    request = F.col("request_id").cast("string")
    # An hour more, as days may have 25.
    (slot,) = feedback.sparkSession.sql(f"SELECT unix_seconds(timestamp_seconds(3600) + INTERVAL {within} + INTERVAL {watermark})").first()
    asked = (
        queries.select(request.alias("_request"), F.col("id").alias("query_id"), F.col("timestamp").alias("query_time"))
        .filter("_request is not null")
        .withWatermark("query_time", watermark)
        .dropDuplicatesWithinWatermark(["_request"])
        .filter("query_time is not null")
    )
    # The hash by which Spark has dealt the requests out to find repeats.
    placed = asked.withColumns(
        {
            "_bucket": F.pmod(F.hash("_request"), F.lit(buckets)),
            "_slot": F.floor(F.unix_seconds("query_time") / slot),
        }
    )
    kinds = {f.name: f.dataType for f in asked.schema.fields}
    lists = [T.StructField(to, T.ArrayType(kinds[of])) for to, of in _LISTS.items()]
    schema = T.StructType([T.StructField("_bucket", T.IntegerType()), T.StructField("_first", kinds["query_time"]), *lists])
    # A row of queries is as old as its first, which is under the queries' watermark.
    first = F.col("_first").alias("_first", metadata=asked.schema["query_time"].metadata)
    packed = placed.mapInArrow(_packed, schema).select(
        F.col("_bucket").alias("_in"), first, "_requests", "_ids", "_times", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_of")
    )
    dealt = F.xxhash64("id")
    share = F.when(F.col("request_id").isNull(), -1 - F.pmod(dealt, F.lit(1 << 20))).otherwise(F.pmod(dealt, F.lit(shares)))
    given = feedback.withWatermark("timestamp", watermark).withColumns(
        {"_bucket": F.pmod(F.hash(request), F.lit(buckets)), "_share": share.cast("int")}
    )

    def found(column: str) -> Column:
        return F.get(column, F.array_position("_requests", request).cast("int") - 1)

    near = found("_times").between(F.expr(f"timestamp - INTERVAL {within}"), F.expr(f"timestamp + INTERVAL {early}"))
    # Follows from the line above; by it Spark knows what no row to come can meet.
    alive = F.expr(f"_first BETWEEN timestamp - INTERVAL {within} - INTERVAL {slot + 7200} SECONDS AND timestamp + INTERVAL {early}")
    same = (F.col("_bucket") == F.col("_in")) & (F.col("_share") == F.col("_of")) & near & alive
    paired = given.join(packed, same, "left_outer").withColumns({"query_id": found("_ids"), "query_time": found("_times")})
    return paired.select(*feedback.columns, "query_id", "query_time", F.col("query_id").isNull().alias("is_orphan"))


class FeedbackJoin:
    """A ``foreachBatch`` sink that writes arriving feedback with its query id.

    For queries that are all there, in a table; :func:`feedback_pairs` is for two streams.
    ``is_orphan`` marks feedback without a query. With ``within``, the longest time from a query
    to its feedback, a batch reads only the queries of its own span of time: of a table in files
    by time, a few of them. Of these only those of the batch's request ids are regrouped. A request
    with very much feedback is spread over tasks, and feedback without a request id is set aside
    before the join. A batch that runs again replaces its own folder.
    """

    def __init__(self, queries: DataFrame, folder: str, within: str | None = None):
        self.queries, self.folder, self.within = queries, folder, within

    def _near(self, asked: DataFrame) -> DataFrame:
        if self.within is None:
            return self.queries
        kind = dict(self.queries.dtypes)["timestamp"]
        span = asked.agg(F.min("timestamp").cast(kind).alias("first"), F.max("timestamp").cast(kind).alias("last")).first()
        first = F.lit(span["first"]).cast(kind) - F.expr(f"INTERVAL {self.within}")
        return self.queries.filter(F.col("timestamp").between(first, F.lit(span["last"]).cast(kind)))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        asked = batch.filter("request_id is not null")
        ids = asked.select("request_id").distinct()
        known = first_query_ids(self._near(asked).join(ids, "request_id", "left_semi")).select("request_id", "query_id")
        joined = skewed_join(asked, known, "request_id", "left").select(*batch.columns, "query_id")
        missing = batch.filter("request_id is null").withColumn("query_id", F.lit(None).cast("bigint"))
        both = joined.unionByName(missing).withColumn("is_orphan", F.col("query_id").isNull())
        _replace(both.withColumn("batch", F.lit(batch_id)), self.folder, "batch")


def join_feedback(feedback: DataFrame, queries: DataFrame, folder: str, within: str | None = None) -> DataFrame:
    """Feeds the feedback that is there now to :class:`FeedbackJoin`; returns all that was written."""
    sink = FeedbackJoin(queries, f"{folder}/joined", within)
    feed_available(feedback, sink, f"{folder}/progress")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feedback.schema)
    written = feedback.sparkSession.read.schema(f"{columns}, query_id bigint, is_orphan boolean, batch bigint")
    return written.parquet(sink.folder).drop("batch")


def stream_sessions(log: DataFrame, gap: str = "30 minutes", watermark: str = "10 minutes") -> DataFrame:
    """Per user: bursts of requests with less than ``gap`` between them.

    Sessions are merged within each task before the shuffle, so a user with very many
    requests sends few rows.
    """
    log.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        log.withWatermark("ts", watermark)
        .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
        .agg(F.count("*").alias("requests"))
        .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "requests")
    )


class DailyRefresh:
    """Two ``foreachBatch`` sinks keeping a daily table current: :meth:`queries` and :meth:`pairs`.

    A batch adds what merges - counts, sums, users, feedback signs per day - under (date,
    batch), and then only the days it touched are merged again, from these partial rows.
    All writes replace whole folders, so a batch that is run again after a failure changes
    nothing. Feedback comes as :func:`feedback_pairs` and counts on the day of its query,
    whichever of the two came first; orphans count nowhere. The two sinks write different
    partial rows and share only the last step, so they take turns there.
    """

    _PARTIAL = "asked bigint, ms bigint, timed bigint, up bigint, down bigint, date date, kind string, batch bigint"
    _USERS = "user_id string, date date, batch bigint"

    def __init__(self, folder: str):
        self.folder, self.daily, self._turn, self._ready = folder, f"{folder}/daily", threading.Lock(), False

    def _prepare(self, spark) -> None:
        """Empty tables, so that either sink may come first."""
        if not self._ready:
            for name, schema, by in (("users", self._USERS, ("date", "batch")), ("partial", self._PARTIAL, ("date", "kind", "batch"))):
                spark.createDataFrame([], schema).write.mode("append").partitionBy(*by).parquet(f"{self.folder}/{name}")
            self._ready = True

    def _read(self, spark, name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def queries(self, batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("date", F.to_date("timestamp")).withColumn("batch", F.lit(batch_id)).persist()
        ms = F.col("response_time_ms").cast("bigint")
        counts = dated.groupBy("date").agg(F.count("*").alias("asked"), F.sum(ms).alias("ms"), F.count(ms).alias("timed"))
        with self._turn:
            self._prepare(batch.sparkSession)
            self._add(counts, "queries", batch_id)
            _replace(dated.select("user_id", "date", "batch").distinct(), f"{self.folder}/users", "date", "batch")
            dated.unpersist()
            self._merge(batch.sparkSession, "queries", batch_id)

    def pairs(self, batch: DataFrame, batch_id: int) -> None:
        signs = batch.filter("not is_orphan").groupBy(F.to_date("query_time").alias("date")).agg(
            F.count_if("is_helpful").alias("up"), F.count_if(~F.col("is_helpful")).alias("down")
        )
        with self._turn:
            self._prepare(batch.sparkSession)
            self._add(signs, "feedback", batch_id)
            self._merge(batch.sparkSession, "feedback", batch_id)

    def _add(self, counts: DataFrame, kind: str, batch_id: int) -> None:
        have = [F.col(c) if c in counts.columns else F.lit(0).cast("bigint").alias(c) for c in ("asked", "ms", "timed", "up", "down")]
        rows = counts.select(*have, "date", F.lit(kind).alias("kind"), F.lit(batch_id).alias("batch"))
        _replace(rows, f"{self.folder}/partial", "date", "kind", "batch")

    def _merge(self, spark, kind: str, batch_id: int) -> None:
        partial = self._read(spark, "partial", self._PARTIAL)
        touched = partial.filter((F.col("kind") == kind) & (F.col("batch") == batch_id)).select("date").distinct()
        users = self._read(spark, "users", self._USERS).join(touched, "date", "left_semi")
        partial = partial.join(touched, "date", "left_semi")
        sums = partial.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("asked", "ms", "timed", "up", "down")])
        people = users.groupBy("date").agg(F.countDistinct("user_id").alias("unique_users"))
        # A day whose queries' own batch is still to come has feedback only; that batch merges it again.
        days = sums.join(people, "date").select(
            F.col("asked").alias("total_queries"),
            F.try_divide("ms", "timed").alias("avg_response_time_ms"),
            "unique_users",
            F.col("up").alias("positive_feedback_count"),
            F.col("down").alias("negative_feedback_count"),
            "date",
        )
        _replace(days, self.daily, "date")

    def table(self, spark) -> DataFrame:
        schema = (
            "total_queries bigint, avg_response_time_ms double, unique_users bigint, "
            "positive_feedback_count bigint, negative_feedback_count bigint, date date"
        )
        return self._read(spark, "daily", schema)


def refresh_daily(queries: DataFrame, feedback: DataFrame, folder: str, **bounds: str) -> DataFrame:
    """Feeds the queries and feedback that are there now to :class:`DailyRefresh`; returns the daily table.

    ``bounds`` are those of :func:`feedback_pairs`.
    """
    sink = DailyRefresh(folder)
    feed_available(queries, sink.queries, f"{folder}/progress-queries")
    feed_available(feedback_pairs(feedback, queries, **bounds), sink.pairs, f"{folder}/progress-feedback")
    return sink.table(queries.sparkSession)


def keep_daily_fresh(queries: DataFrame, feedback: DataFrame, folder: str, every: str = "1 hour", **bounds: str) -> list[StreamingQuery]:
    """The same on a timer, until the returned queries are stopped."""
    sink = DailyRefresh(folder)
    keep_state_on_disk(queries.sparkSession)
    streams = ((queries, sink.queries, "queries"), (feedback_pairs(feedback, queries, **bounds), sink.pairs, "feedback"))
    return [
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress-{name}")
        .trigger(processingTime=every)
        .start()
        for stream, write, name in streams
    ]
