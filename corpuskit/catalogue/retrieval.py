"""Queries over embeddings: nearest neighbours, contexts, prompts, recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.catalogue import inputs
from corpuskit.catalogue.inputs import cleaned_sql, tokens_sql
from corpuskit.catalogue.registry import query
from corpuskit.functions import text as tx
from corpuskit.functions.tokens import tokens
from corpuskit.operators import neighbours, retrieval
from corpuskit.plans import rag
from corpuskit.session import durable, new_path
from corpuskit.sources import store

K, C = fixed.SEARCH_K, fixed.CONTEXT_K


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "embeddings").select("vec_id", "embedding")


# Every stored vector is asked for.
def asked(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        F.concat(F.lit("Which documents resemble number "), F.col("vec_id").cast("string"), F.lit("?")).alias("question"),
    )


def _hits_sql(k: int) -> str:
    return f"""
    near AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
        pow(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 2) AS score
      FROM embeddings q CROSS JOIN embeddings v),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank
      FROM near) WHERE rank <= {k})"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("knn_topk", f"WITH {_hits_sql(K)} SELECT query_id, vec_id, rank, round(score, 6) AS score FROM hits")
def knn_topk(spark, sf):
    return _rounded(neighbours.nearest(vectors(spark, sf), asked(spark, sf)), "score")


@query("knn_topk_grid", f"WITH {_hits_sql(K)} SELECT query_id, vec_id, rank, round(score, 6) AS score FROM hits")
def knn_topk_grid(spark, sf):
    return _rounded(neighbours.nearest(vectors(spark, sf), asked(spark, sf), part_bytes=64 << 10), "score")


# Vectors with some of them missing, cut short or not finite.
def damaged(spark: SparkSession, sf: str) -> DataFrame:
    e, n = F.col("embedding").cast("array<double>"), F.col("vec_id") % 20
    broken = (
        F.when(n == 1, F.lit(None).cast("array<double>"))
        .when(n == 2, F.slice(e, 1, 7))
        .when(n == 3, F.transform(e, lambda x, i: F.when(i == 5, float("nan")).otherwise(x)))
        .when(n == 4, F.concat(F.slice(e, 1, F.size(e) - 1), F.array(F.lit(float("-inf")))))
        .otherwise(e)
    )
    return inputs.table(spark, sf, "embeddings").select("vec_id", broken.alias("embedding"))


@query(
    "vector_quarantine",
    """SELECT vec_id, CASE vec_id % 20 WHEN 1 THEN 'missing' WHEN 2 THEN 'dimension' ELSE 'not finite' END AS reason
    FROM embeddings WHERE vec_id % 20 BETWEEN 1 AND 4""",
)
def vector_quarantine(spark, sf):
    return neighbours.quarantined(damaged(spark, sf))


@query(
    "knn_damaged",
    f"""WITH good AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 NOT BETWEEN 1 AND 4)
    SELECT query_id, vec_id, rank, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM (
        SELECT q.vec_id AS query_id, v.vec_id, pow(list_distance(q.e, v.e), 2) AS score FROM good q CROSS JOIN good v))
    WHERE rank <= {K}""",
)
def knn_damaged(spark, sf):
    held = damaged(spark, sf)
    return _rounded(neighbours.nearest(held, held.withColumnRenamed("vec_id", "query_id")), "score")


_FOUND = f"""WITH {_hits_sql(C)}, found AS (SELECT query_id, rank, vec_id, text AS document, score
    FROM hits JOIN documents ON vec_id = doc_id)"""


@query("hit_documents", f"{_FOUND} SELECT query_id, rank, vec_id, document, round(score, 6) AS score FROM found")
def hit_documents(spark, sf):
    hits = neighbours.nearest(vectors(spark, sf), asked(spark, sf), C)
    return _rounded(retrieval.attach_documents(hits, inputs.table(spark, sf, "documents")), "score")


_CONTEXT = f"""{_FOUND}, ctx AS (SELECT query_id, string_agg(document, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(vec_id::VARCHAR, ',' ORDER BY rank) AS cited FROM found GROUP BY 1)"""


def _prompt_sql(context: str, question: str) -> str:
    n = "chr(10)"
    return (
        f"'Context information:' || {n} || {context} || {n} || {n} || 'Question: ' || {question}"
        f" || {n} || {n} || 'Answer:'"
    )


_QUESTION = "'Which documents resemble number ' || e.vec_id || '?'"


@query(
    "rag_prompts",
    f"""{_CONTEXT} SELECT e.vec_id AS query_id, cited, context IS NULL AS is_fallback,
    {_prompt_sql(f"coalesce(context, '{fixed.FALLBACK_CONTEXT}')", _QUESTION)} AS prompt
    FROM embeddings e LEFT JOIN ctx ON e.vec_id = ctx.query_id""",
)
def rag_prompts(spark, sf):
    made = rag.prompts(vectors(spark, sf), inputs.table(spark, sf, "documents"), asked(spark, sf))
    return made.select(
        "query_id", F.array_join(F.col("cited").cast("array<string>"), ",").alias("cited"), "is_fallback", "prompt"
    )


@query(
    "rag_sources",
    f"{_FOUND} SELECT query_id, substr(document, 1, 100) || '...' AS text, round(score, 6) AS score FROM found",
)
def rag_sources(spark, sf):
    hits = neighbours.nearest(vectors(spark, sf), asked(spark, sf), C)
    found = retrieval.attach_documents(hits, inputs.table(spark, sf, "documents"))
    return _rounded(retrieval.contexts(found).select("query_id", F.inline("sources")), "score")


# A query does not retrieve itself here, and hits have to be near.
_NEAR = 1.27


@query(
    "rag_fallback",
    f"""WITH {_hits_sql(C + 1)}, ok AS (SELECT DISTINCT query_id FROM hits JOIN documents ON vec_id = doc_id
      WHERE query_id <> vec_id AND score <= {_NEAR})
    SELECT vec_id AS query_id, vec_id NOT IN (SELECT query_id FROM ok) AS is_fallback FROM embeddings""",
)
def rag_fallback(spark, sf):
    hits = neighbours.nearest(vectors(spark, sf), asked(spark, sf), C + 1).filter("query_id <> vec_id")
    found = retrieval.attach_documents(retrieval.relevant(hits, _NEAR), inputs.table(spark, sf, "documents"))
    made = retrieval.with_prompts(asked(spark, sf), retrieval.contexts(found, C + 1))
    return made.select("query_id", "is_fallback")


@query(
    "retrieval_recall",
    f"""WITH {_hits_sql(K)}, lab AS (SELECT vec_id, label, count(*) OVER (PARTITION BY label) - 1 AS expected FROM embeddings),
    m AS (SELECT h.query_id, count(*) FILTER (v.label = q.label) AS hit, count(*) AS shown FROM hits h
      JOIN lab v ON v.vec_id = h.vec_id JOIN lab q ON q.vec_id = h.query_id WHERE h.vec_id <> h.query_id GROUP BY 1)
    SELECT count(*) AS queries, round(avg(hit / nullif(expected, 0)), 6) AS recall,
      round(avg(hit / nullif(shown, 0)), 6) AS precision, round(avg((hit > 0)::INTEGER), 6) AS hit_rate
    FROM (SELECT expected, coalesce(hit, 0)::DOUBLE AS hit, coalesce(shown, 0) AS shown
      FROM lab LEFT JOIN m ON lab.vec_id = m.query_id)""",
)
def retrieval_recall(spark, sf):
    hits = neighbours.nearest(vectors(spark, sf), asked(spark, sf))
    scored = retrieval.recall(hits, inputs.table(spark, sf, "embeddings").select("vec_id", "label"), K)
    return _rounded(scored, "recall", "precision", "hit_rate")


# The document of the query stands for its answer, the nearest other ones for its sources.
_DOC_TOKENS = tokens_sql(cleaned_sql("text"))


@query(
    "citation_overlap",
    f"""WITH {_hits_sql(C)}, t AS (SELECT doc_id, list_distinct({_DOC_TOKENS}) AS t FROM documents)
    SELECT query_id, vec_id, round(len(list_intersect(a.t, s.t))::DOUBLE / nullif(len(a.t), 0), 6) AS overlap
    FROM hits JOIN t a ON a.doc_id = query_id JOIN t s ON s.doc_id = vec_id WHERE query_id <> vec_id""",
)
def citation_overlap(spark, sf):
    hits = durable(neighbours.nearest(vectors(spark, sf), asked(spark, sf), C).filter("query_id <> vec_id"), "hits")
    # Only documents on either side of a hit are tokenised.
    sides = hits.select("vec_id").union(hits.select("query_id"))
    docs = retrieval.wanted_documents(inputs.table(spark, sf, "documents"), sides)
    bags = durable(docs.select("doc_id", F.array_distinct(tokens(F.col("text"))).alias("text")), "bags")
    sources = retrieval.attach_documents(hits, bags)
    answers = bags.select(F.col("doc_id").alias("query_id"), F.col("text").alias("answer"))
    overlap = retrieval.citation_overlap(F.col("answer"), F.col("document"))
    return sources.join(answers, "query_id").select("query_id", "vec_id", F.round(overlap, 6).alias("overlap"))


@query(
    "mean_pool",
    """SELECT label, (pos - 1)::INTEGER AS pos, round(avg(x::DOUBLE), 6) AS x FROM
    (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY ALL""",
)
def mean_pool(spark, sf):
    stored = inputs.table(spark, sf, "embeddings")
    pooled = neighbours.mean_pool(stored, "label", neighbours.common_dimension(stored))
    return _rounded(pooled.select("label", F.posexplode("embedding").alias("pos", "x")), "x")


def _store(spark, sf) -> DataFrame:
    docs = inputs.table(spark, sf, "documents").select("doc_id", F.col("text").alias("document"))
    return inputs.table(spark, sf, "embeddings").join(docs, F.col("vec_id") == F.col("doc_id")).select(
        "vec_id", "doc_id", "document", "embedding"
    )


@query(
    "vector_append",
    """WITH s AS (SELECT vec_id, doc_id FROM embeddings JOIN documents ON vec_id = doc_id)
    SELECT * FROM s UNION ALL
    SELECT (SELECT max(vec_id) FROM s) + row_number() OVER (ORDER BY doc_id), doc_id
    FROM documents""",
)
def vector_append(spark, sf):
    # A one-number embedding function: the text's length.
    new = inputs.table(spark, sf, "documents").select("doc_id", F.col("text").alias("document"))
    embedded = retrieval.embed(new, "document", lambda t: F.array(F.length(t).cast("float")))
    grown, _, _ = retrieval.append_documents(_store(spark, sf), embedded, "doc_id")
    return grown.select("vec_id", "doc_id")


@query(
    "vector_store_roundtrip",
    """SELECT vec_id, doc_id, sha256(text) AS document_hash, len(embedding)::INTEGER AS dimension
    FROM embeddings JOIN documents ON vec_id = doc_id""",
)
def vector_store_roundtrip(spark, sf):
    path = new_path(spark, "vectors")
    store.save_vectors(_store(spark, sf), path)
    return store.load_vectors(spark, path).select(
        "vec_id", "doc_id", F.sha2("document", 256).alias("document_hash"), F.size("embedding").alias("dimension")
    )


@query(
    "answer_extract",
    f"""SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS answer FROM conversations WHERE role = 'assistant'""",
)
def answer_extract(spark, sf):
    turns = inputs.table(spark, sf, "conversations").filter("role = 'assistant'")
    response = F.concat(tx.prompt(F.lit("Answer: none"), F.lit("?")), F.lit(" "), F.col("text"))
    return turns.select("conv_id", "turn", tx.answer_part(response).alias("answer"))
