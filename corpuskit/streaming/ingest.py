"""Lines arriving in a folder: parsed, cleaned, deduplicated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions.text import content_hash, preprocess_text
from corpuskit.session import new_path
from corpuskit.sources.lines import parse_lines, records


# State is kept on disk, beside the heap; a join's in one store a partition, which costs a batch less than four.
# A query that began with other settings keeps them.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def keep_state_on_disk(spark: SparkSession) -> None:
    for name, value in STATE.items():
        spark.conf.set(name, value)


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New text files of an append-only folder."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
        .select(F.when(F.is_valid_utf8("value"), F.col("value")).alias("value"))
    )


def stream_records(lines: DataFrame) -> DataFrame:
    return records(parse_lines(lines))


def stream_clean(recs: DataFrame, mode: str = "parsed") -> DataFrame:
    """Stateless: the same column functions as in batch."""
    return recs.withColumns(
        {c: preprocess_text(F.col(c), mode) for c in ("body", "parsed_content")}
    )


def stream_dedup(cleaned: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """First arrival of each body.

    Without an event time every hash ever seen is kept as state, which is the full
    guarantee and grows with the number of distinct bodies; :func:`write_available` keeps it
    in the RocksDB state store. With one, hashes are dropped after ``delay``, and a repeat later than that
    passes.
    """
    hashed = cleaned.withColumn("content_hash", content_hash(F.col("body")))
    if event_time is None:
        return hashed.dropDuplicates(["content_hash"])
    return hashed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def write_available(stream: DataFrame, path: str, name: str, mode: str = "append") -> DataFrame:
    """Process what is there now into a Parquet table; a second call continues after it.

    ``name`` identifies the progress log next to the table.
    """
    keep_state_on_disk(stream.sparkSession)
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", f"{path}-{name}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def feed_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], progress: str) -> None:
    """Hand what is there now to a ``foreachBatch`` sink; a second call continues after it."""
    keep_state_on_disk(stream.sparkSession)
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """:func:`write_available` into a fresh table of the shared folder."""
    return write_available(stream, new_path(stream.sparkSession, name), name)
