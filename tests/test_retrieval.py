import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.operators import neighbours, quantiles, retrieval
from corpuskit.plans import rag


def brute(vectors, queries, k):
    out = {}
    for q, x in queries.items():
        scored = sorted((float(((x - v) ** 2).sum()), i) for i, v in vectors.items())
        out[q] = [i for _, i in scored[:k]]
    return out


def frame(spark, data, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data.items()], f"{name} long, embedding array<float>")


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


@pytest.mark.parametrize("limit", [300, 1 << 26])
@pytest.mark.parametrize("repeats", [1, 40])
def test_nearest_equals_brute_force(spark, monkeypatch, limit, repeats):
    # Small tiles and query blocks, and many equal vectors: ties go to the smaller id.
    monkeypatch.setattr(neighbours, "_TILE", 16)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(200 // repeats, 8)).astype(np.float32)
    vectors = {i: base[i % len(base)].astype(float) for i in range(200)}
    queries = {i: v for i, v in enumerate(rng.normal(size=(20, 8)).astype(np.float32).astype(float))}
    queries[99] = vectors[3]
    hits = neighbours.nearest(
        frame(spark, vectors, "vec_id").repartition(3), frame(spark, queries, "query_id"), 5, part_bytes=limit
    )
    assert found(hits) == brute(vectors, queries, 5)


@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-25), (0.0, 1e25)])
def test_nearest_is_exact_where_single_precision_is_not(shift, scale):
    rng = np.random.default_rng(4)
    vectors = shift + scale * rng.normal(size=(3000, 16))
    ids = np.arange(3000)
    best = neighbours._Best(ids[:50], vectors[:50], 4)
    best.add(ids, vectors)
    wanted = [np.lexsort((ids, ((x - vectors) ** 2).sum(axis=1)))[:4] for x in vectors[:50]]
    assert (best.vec == np.array(wanted)).all()


def test_small_parts_do_not_repeat_the_queries(spark):
    rng = np.random.default_rng(5)
    vectors = frame(spark, {i: v for i, v in enumerate(rng.normal(size=(400, 8)))}, "vec_id")
    hits = neighbours.nearest(vectors, vectors.withColumnRenamed("vec_id", "query_id"), 3, part_bytes=64)
    assert hits.count() == 1200
    # What is shuffled: a row per matrix of queries, and k rows per query.
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" in plan


def test_fewer_vectors_than_k(spark):
    one = frame(spark, {4: np.array([1.0, 2.0])}, "vec_id")
    hits = neighbours.nearest(one, frame(spark, {0: np.array([0.0, 0.0])}, "query_id"), 5).collect()
    assert [(r.vec_id, r.rank, r.score) for r in hits] == [(4, 1, 5.0)]


def test_damaged_vectors_take_no_neighbours_away(spark):
    rows = [(i, [float(i), 0.0]) for i in range(6)]
    rows += [(10, None), (11, [float("nan"), 1.0]), (12, [1.0]), (13, [float("inf"), 0.0]), (14, [None, 1.0]), (15, [])]
    held = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    hits = found(neighbours.nearest(held, held.withColumnRenamed("vec_id", "query_id"), 2))
    assert hits == {0: [0, 1], 1: [1, 0], 2: [2, 1], 3: [3, 2], 4: [4, 3], 5: [5, 4]}
    reasons = {r.vec_id: r.reason for r in neighbours.quarantined(held).collect()}
    assert reasons == {10: "missing", 11: "not finite", 12: "dimension", 13: "not finite", 14: "not finite", 15: "dimension"}


def test_equal_vectors_stay_small():
    import tracemalloc

    best = neighbours._Best(np.arange(2000), np.ones((2000, 8)), 5)
    tracemalloc.start()
    best.add(np.arange(10_000)[::-1].copy(), np.ones((10_000, 8)))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert (best.vec == np.arange(5)).all() and (best.score == 0).all()


def test_no_queries_no_hits(spark):
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert neighbours.nearest(frame(spark, {1: np.array([1.0])}, "vec_id"), none).count() == 0


def test_prompt_fallback_and_order(spark):
    vectors = frame(spark, {1: np.array([0.0]), 2: np.array([1.0]), 3: np.array([9.0])}, "vec_id")
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    queries = frame(spark, {10: np.array([0.9]), 11: np.array([50.0])}, "query_id").withColumn("question", F.lit("why?"))
    got = {r.query_id: r for r in rag.prompts(vectors, docs, queries, k=2, max_score=2.0).collect()}
    assert got[10].prompt == "Context information:\ntwo\n\none\n\nQuestion: why?\n\nAnswer:"
    assert [s.text for s in got[10].sources] == ["two...", "one..."] and not got[10].is_fallback
    assert got[11].is_fallback and "No relevant document" in got[11].prompt


def test_only_documents_that_were_found_are_shuffled(spark):
    hits = spark.createDataFrame([(q, q % 20, 1, 0.5) for q in range(60)] + [(99, 5_000, 1, 0.5), (98, None, 1, 0.5)], "query_id long, vec_id long, rank int, score double")
    rows = [(i, f"text {i}") for i in range(2_000)] + [(3, "again"), (None, "none"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = hits.join(docs.withColumnsRenamed({"doc_id": "vec_id", "text": "document"}), "vec_id").select("query_id", "vec_id", "rank", "document")
    got = retrieval.attach_documents(hits, docs).select(*joined.columns)
    assert got.count() == 66 and got.exceptAll(joined).isEmpty() and joined.exceptAll(got).isEmpty()
    assert 22 <= retrieval.wanted_documents(docs, hits.select("vec_id")).count() < 200
    other = docs.withColumn("doc_id", F.col("doc_id").cast("int"))
    assert retrieval.wanted_documents(other, hits.select("vec_id")).count() == 2_003


def test_append_gives_contiguous_positions(spark):
    store = spark.createDataFrame([(0, 5, "a", [1.0])], "vec_id long, doc_id long, document string, embedding array<float>")
    new = spark.createDataFrame([(9, "c"), (7, "b")], "doc_id long, document string")
    embedded = retrieval.embed(new, "document", lambda t: F.array(F.lit(0.5).cast("float")))
    grown, first, last = retrieval.append_documents(store, embedded, "doc_id")
    assert (first, last) == (1, 2)
    assert {r.vec_id: r.document for r in grown.collect()} == {0: "a", 1: "b", 2: "c"}
    empty, first, last = retrieval.append_documents(store.limit(0), embedded, "doc_id")
    assert (first, last, empty.count()) == (0, 1, 2)


def test_mean_pool(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [0.0, 1.0])], "g string, embedding array<float>")
    assert {r.g: r.embedding for r in neighbours.mean_pool(df, "g", 2).collect()} == {"a": [2.0, 4.0], "b": [0.0, 1.0]}


def test_quantiles_in_one_band(spark):
    """Values much alike, whose coarse cell is cut again, and infinite ones."""
    df = spark.range(300_000).select(F.lit("band").alias("g"), (1 + F.col("id") * 1e-9).alias("v"))
    df = df.union(spark.createDataFrame([("inf", float("-inf")), ("inf", 1.0), ("inf", 2.0), ("inf", float("inf")), ("inf", float("nan"))], "g string, v double"))
    got = {r.g: r for r in quantiles.group_quantiles(df, ["g"], "v", {"a": 0.0, "b": 0.5, "c": 1.0}, small_cell=50).collect()}
    assert got["band"].b == pytest.approx(1 + 149_999.5e-9, abs=1e-15) and got["band"].c == pytest.approx(1 + 299_999e-9, abs=1e-15)
    assert (got["inf"].a, got["inf"].b, got["inf"].c) == (float("-inf"), 1.5, float("inf"))


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    groups = {
        "flat": [3.5] * 50, "one": [1.0], "two": [-1.0, 4.0], "mixed": list(rng.normal(size=501) * 100),
        "tied": list(rng.integers(0, 4, 400).astype(float)),
    }
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None)], "g string, v double")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: r for r in quantiles.group_quantiles(df, ["g"], "v", wanted).collect()}
    for g, vs in groups.items():
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, q), abs=1e-9)
