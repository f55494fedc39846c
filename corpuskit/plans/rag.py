"""Prompts with retrieved context for a table of questions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpuskit import fixed
from corpuskit.operators.neighbours import nearest
from corpuskit.operators.retrieval import attach_documents, contexts, relevant, with_prompts


def prompts(
    vectors: DataFrame,
    documents: DataFrame,
    queries: DataFrame,
    k: int = fixed.CONTEXT_K,
    max_score: float | None = None,
) -> DataFrame:
    """One prompt per query: nearest documents, or the fallback when none is near enough.

    ``vectors(vec_id, embedding)``, ``documents(doc_id, text)``,
    ``queries(query_id, embedding, question)``.
    """
    hits = nearest(vectors, queries, k)
    if max_score is not None:
        hits = relevant(hits, max_score)
    return with_prompts(queries, contexts(attach_documents(hits, documents), k))
