"""Times headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names).
The tables are copied first, outside the timing, into as many files as there are CPUs: each
comes as one file with one row group, which only one task can read, unlike a table of any
size. Each query runs once to warm up and once timed, all rows computed and discarded.
"""

from __future__ import annotations

import json
import os
import time

from corpuskit.catalogue import QUERIES
from corpuskit.session import local_session, new_path

HEADLINE = (
    "corpus_report ingest_records clean_documents clean_markup preprocess_pages dedup_exact split_exact "
    "vocabulary encode_padded quality_report dataset_fingerprint incremental_add passages knn_topk rag_prompts "
    "retrieval_recall daily_metrics feedback_join feedback_latest request_rate latency_quantiles "
    "latency_quantiles_exact token_histogram alert_sustained perplexity qa_pairs chat_history "
    "stream_clean_dedup stream_windows"
).split()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def copied(spark, sf: str, files: int) -> str:
    folder = new_path(spark, "bench")
    for name in TABLES.split():
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            spark.read.parquet(path).repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    folder = copied(spark, sf, int(os.environ.get("BENCH_CPUS", "8")))
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input": "tables copied into as many files as CPUs, outside the timing",
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
