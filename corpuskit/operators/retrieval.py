"""From hits to prompt contexts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.functions.text import prompt, source_preview
from corpuskit.operators.seen import SeenFilter
from corpuskit.operators.skew import skewed_join
from corpuskit.operators.versions import number_rows
from corpuskit.session import durable


def embed(documents: DataFrame, text: str, function: Callable[[Column], Column]) -> DataFrame:
    """Adds ``embedding`` with a user-supplied column function (an Arrow UDF, say)."""
    return documents.withColumn("embedding", function(F.col(text)))


def append_documents(store: DataFrame, documents: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """The store with the documents at the next contiguous positions, plus the first and
    last position given out."""
    last = store.agg(F.max("vec_id")).first()[0]
    start = 0 if last is None else last + 1
    added = number_rows(documents, key, "vec_id", start).select(*store.columns)
    return store.unionByName(added), start, start + added.count() - 1


def wanted_documents(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose ``doc_id`` is in the one column of ``ids``, and few others.

    A filter of 4 MB goes to the tasks that read the documents, so that texts nobody asks for
    are not shuffled; with very many ids it lets more of the others pass, but never fewer of those asked for.
    ``ids`` are read again, so they should be a table.
    """
    (column, kind), = ids.dtypes
    if kind != dict(documents.dtypes)["doc_id"]:  # hashes of equal numbers of two types differ
        return documents
    return SeenFilter.sent(ids, column).possible(documents, "doc_id", send=True)


def attach_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Document of each hit; hits without one are dropped. A document found by very many
    queries is spread over tasks, one found by none is not shuffled. The hits are written, an action."""
    hits = durable(hits, "hits")
    wanted = wanted_documents(documents.select("doc_id", "text"), hits.select("vec_id"))
    by_vector = wanted.select(F.col("doc_id").alias("vec_id"), F.col("text").alias("document"))
    return skewed_join(hits, by_vector, "vec_id")


def contexts(found: DataFrame, k: int = fixed.CONTEXT_K) -> DataFrame:
    """Per query: the ``k`` best documents joined by blank lines, with sources and ids.

    ``found`` comes from :func:`attach_documents`. Groups have at most ``k`` rows.
    """
    hits = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "document", "score")))
    grouped = found.filter(F.col("rank") <= k).groupBy("query_id").agg(hits.alias("hits"))
    return grouped.select(
        "query_id",
        F.array_join(F.transform("hits", lambda h: h["document"]), fixed.PART_SEPARATOR).alias("context"),
        F.transform(
            "hits",
            lambda h: F.struct(source_preview(h["document"]).alias("text"), h["score"].alias("score")),
        ).alias("sources"),
        F.transform("hits", lambda h: h["vec_id"]).alias("cited"),
    )


def with_prompts(queries: DataFrame, context: DataFrame, fallback: str = fixed.FALLBACK_CONTEXT) -> DataFrame:
    """Every query with its prompt; those without a context get the fallback.

    ``queries(query_id, question)``; both sides have one row per query.
    """
    joined = queries.select("query_id", "question").join(context, "query_id", "left")
    return joined.withColumn("is_fallback", F.col("context").isNull()).withColumn(
        "context", F.coalesce("context", F.lit(fallback))
    ).withColumn("prompt", prompt(F.col("context"), F.col("question")))


def relevant(hits: DataFrame, max_score: float) -> DataFrame:
    """Hits near enough to be used."""
    return hits.filter(F.col("score") <= max_score)


def recall(hits: DataFrame, labelled: DataFrame, k: int) -> DataFrame:
    """Recall@k, precision@k and hit rate, where vectors of the query's label are expected.

    ``labelled(vec_id, label)`` also labels the queries, by id; a query is not expected
    to find itself. A query shows ``k`` hits at most, so those of one query fit in a row.
    """
    per_label = labelled.groupBy("label").agg((F.count("*") - 1).alias("expected"))
    others = hits.filter((F.col("rank") <= k) & (F.col("vec_id") != F.col("query_id")))
    # The label of what was found, then once for each query all that it found.
    found = skewed_join(others, labelled.select("vec_id", "label"), "vec_id")
    shown = found.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.collect_list("label").alias("labels"), F.count("*").alias("shown")
    )
    queries = labelled.select("vec_id", "label").join(shown, "vec_id", "left")
    right = F.size(F.filter("labels", lambda x: x == F.col("label")))
    counted = queries.select(
        "label", F.when(F.col("labels").isNull(), 0).otherwise(right).alias("right"), F.coalesce("shown", F.lit(0)).alias("shown")
    )
    scored = skewed_join(counted, per_label, "label")
    return scored.agg(
        F.count("*").alias("queries"),
        F.avg(F.try_divide(F.col("right"), F.col("expected"))).alias("recall"),
        F.avg(F.try_divide(F.col("right"), F.col("shown"))).alias("precision"),
        F.avg((F.col("right") > 0).cast("double")).alias("hit_rate"),
    )


def citation_overlap(answer: Column, source: Column) -> Column:
    """Share of the distinct answer tokens that occur in the source (token arrays)."""
    return F.try_divide(F.size(F.array_intersect(answer, source)), F.size(F.array_distinct(answer)))
