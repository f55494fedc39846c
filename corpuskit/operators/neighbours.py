"""Exact nearest neighbours by squared Euclidean distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.session import durable

PART_BYTES = 256 << 20
_TILE = 1_024
_QUERIES = 2_048
_CHUNK_BYTES = 4 << 20
_EXACT_PAIRS = 65_536
_MANY = 16
_LARGE = 1e30
_CHUNK = "chunk bigint, ids binary, flat binary"
_HITS = "query_id bigint, vec_id bigint, score double"
_NO_VECTOR = np.iinfo(np.int64).max


def _matrix(embeddings: pa.Array, kind: type) -> np.ndarray:
    flat = embeddings.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(embeddings), -1) if len(embeddings) else flat.reshape(0, 0)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows, dtype=np.float64)


class _Best:
    """The k nearest vectors seen so far for each of a set of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = _norms(queries)
        self.score = np.full((len(ids), k), np.inf)
        self.vec = np.full((len(ids), k), _NO_VECTOR)
        # Whether single precision tells candidates apart.
        self.single = True

    def add(self, vec_ids: np.ndarray, vectors: np.ndarray) -> None:
        for v in range(0, len(vec_ids), _TILE):
            ids, tile = vec_ids[v : v + _TILE], vectors[v : v + _TILE]
            norms = _norms(tile)
            for q in range(0, len(self.ids), _TILE):
                self._near(slice(q, q + _TILE), ids, tile, norms)

    def _rough(self, part: slice, tile, norms, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Distances by a matrix product of this precision, and twice what rounding may move them by."""
        queries, own = self.queries[part], self.norms[part]
        rough = queries.astype(kind, copy=False) @ tile.astype(kind, copy=False).T
        rough *= -2
        rough += own.astype(kind)[:, None]
        rough += norms.astype(kind)
        if kind is np.float64:
            return rough, 2e-9 * (1.0 + own + norms.max())
        return rough, 2.0 * (queries.shape[1] + 16) * np.finfo(kind).eps * (own + norms.max()) + 1e-30

    def _candidates(self, part: slice, tile, norms, kind: type) -> np.ndarray:
        rough, slack = self._rough(part, tile, norms, kind)

        def within(limit: np.ndarray) -> np.ndarray:
            return rough <= np.nextafter((limit + slack).astype(kind), kind(np.inf))[:, None]

        limit = self.score[part, -1]
        near = within(limit)
        if rough.shape[1] > self.k and np.count_nonzero(near) > _MANY * len(rough):
            near = within(np.minimum(limit, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]))
        return near

    def _near(self, part: slice, ids, tile, norms) -> None:
        # The matrix product finds candidates; rounding may move it by less than the
        # slack. Candidates then get the plain sum of squared differences, and at once
        # compete with the best so far, so that equal vectors do not pile up.
        if self.single and max(self.norms[part].max(), norms.max()) < _LARGE:
            near = self._candidates(part, tile, norms, np.float32)
            many = np.count_nonzero(near)
            if many > (_MANY + self.k) * len(near):
                near = self._candidates(part, tile, norms, np.float64)
                self.single = 2 * np.count_nonzero(near) > many
        else:
            near = self._candidates(part, tile, norms, np.float64)
        rows, columns = np.nonzero(near)
        for at in range(0, len(rows), _EXACT_PAIRS):
            r, c = rows[at : at + _EXACT_PAIRS], columns[at : at + _EXACT_PAIRS]
            difference = np.subtract(self.queries[part][r], tile[c], dtype=np.float64)
            self._keep(r + part.start, ids[c], np.einsum("ij,ij->i", difference, difference))

    def _keep(self, row, vec, score) -> None:
        touched = np.unique(row)
        row = np.append(np.repeat(touched, self.k), row)
        vec = np.append(self.vec[touched].ravel(), vec)
        score = np.append(self.score[touched].ravel(), score)
        order = np.lexsort((vec, score, row))
        row, vec, score = row[order], vec[order], score[order]
        near = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.vec[touched], self.score[touched] = vec[near].reshape(-1, self.k), score[near].reshape(-1, self.k)

    def batch(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.vec != _NO_VECTOR)
        columns = [self.ids[row], self.vec[row, place], self.score[row, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def _single(side: DataFrame) -> bool:
    return dict(side.dtypes)["embedding"] == "array<float>"


def _chunks(side: DataFrame, rows: int) -> DataFrame:
    """``(chunk, ids, flat)``: rows of ``side(id, embedding)`` packed into matrices of at most so many."""
    kind = np.float32 if _single(side) else np.float64

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                ids = np.ascontiguousarray(some.column(0).to_numpy(zero_copy_only=False), np.int64).tobytes()
                flat = np.ascontiguousarray(_matrix(some.column(1), kind)).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([ids], pa.binary()), pa.array([flat], pa.binary())], ["chunk", "ids", "flat"]
                )
                chunk += 1

    return side.mapInArrow(packed, _CHUNK)


def _part_hits(vectors: DataFrame, queries: DataFrame, k: int, dimension: int, kinds: tuple[type, type]) -> DataFrame:
    """The ``k`` nearest vectors for each query, of each part of the vectors' chunks, for each part of the queries'."""

    def rows(ids: pa.Scalar, flat: pa.Scalar, kind: type) -> tuple[np.ndarray, np.ndarray]:
        found = np.frombuffer(ids.as_buffer(), np.int64)
        return found, np.frombuffer(flat.as_buffer(), kind).reshape(len(found), dimension)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A chunk of queries comes with one chunk of vectors after the other.
        current, best = None, None
        for batch in batches:
            for chunk, q_ids, q_flat, v_ids, v_flat in zip(*[batch.column(i) for i in range(5)]):
                if chunk.as_py() != current:
                    if best is not None:
                        yield best.batch()
                    current, best = chunk.as_py(), _Best(*(a.copy() for a in rows(q_ids, q_flat, kinds[1])), k)
                best.add(*rows(v_ids, v_flat, kinds[0]))
        if best is not None:
            yield best.batch()

    of = vectors.select(F.col("ids").alias("vec_ids"), F.col("flat").alias("vec_flat"))
    return queries.crossJoin(of.hint("shuffle_replicate_nl")).mapInArrow(nearest, _HITS)


def _common(vectors: DataFrame) -> tuple[int, int]:
    sizes = vectors.filter("embedding is not null").groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    row = sizes.orderBy(F.desc("n"), "d").first()
    return (row["d"], row["n"]) if row else (0, 0)


def common_dimension(vectors: DataFrame) -> int:
    """The size most embeddings have, the smaller of equals; 0 without any. An action."""
    return _common(vectors)[0]


def defect(embedding: Column, dimension: int) -> Column:
    """Why an embedding cannot be compared: ``missing``, ``dimension``, ``not finite``; else NULL."""
    infinite = F.lit(float("inf"))
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return (
        F.when(embedding.isNull(), "missing")
        .when((F.size(embedding) != dimension) | (F.size(embedding) == 0), "dimension")
        .when(~finite, "not finite")
    )


def quarantined(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """``(vec_id, reason)`` of the vectors a search leaves aside."""
    dimension = common_dimension(vectors) if dimension is None else dimension
    return vectors.select("vec_id", defect(F.col("embedding"), dimension).alias("reason")).filter("reason is not null")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = fixed.SEARCH_K,
    *,
    dimension: int | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``(query_id, vec_id, rank, score)``: the ``k`` nearest vectors of each query.

    ``vectors(vec_id, embedding)``, ``queries(query_id, embedding)``; ids are unique,
    ties go to the smaller id. Embeddings that are missing, not finite or not of the common
    dimension are left aside on both sides (see :func:`quarantined`).

    The search is flat and exact, so its work is vectors times queries. Both are packed into matrices,
    of vectors ``part_bytes`` each at most, and parts of both sides meet in a Cartesian product: a task
    reads a part of the vectors, written once, and passes it through Python a matrix at a time for each
    matrix of its queries. Neither side has to fit anywhere as a whole, nothing goes through the driver, and
    neither is repeated in a shuffle. No pairs are written out: per query and part of ``PART_BYTES``
    ``k`` rows leave a task. Counting the vectors and writing their matrices are actions.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding")
    queries = queries.select("query_id", "embedding")
    common, n = _common(vectors)
    dimension = common if dimension is None else dimension
    vectors = vectors.filter(defect(F.col("embedding"), dimension).isNull())
    queries = queries.filter(defect(F.col("embedding"), dimension).isNull())
    row_bytes = 8 * max(dimension, 1)
    most = max(1, _CHUNK_BYTES // row_bytes)
    parts = max(1, -(-n * row_bytes // PART_BYTES))
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    held = durable(_chunks(vectors, min(_TILE, most, max(1, part_bytes // row_bytes))), "vectors").coalesce(parts)
    asked = _chunks(queries, min(_QUERIES, most)).repartition(spread)
    kinds = tuple(np.float32 if _single(side) else np.float64 for side in (vectors, queries))
    hits = _part_hits(held, asked, k, dimension, kinds)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    hits = hits.withColumn("rank", best).filter(F.col("rank") <= k)
    return hits.select("query_id", "vec_id", "rank", "score")


def mean_pool(df: DataFrame, by: str, dimension: int, embedding: str = "embedding") -> DataFrame:
    """Element-wise mean per group, one average per position in a single aggregate.

    Positions an embedding does not have, and NULL ones, do not count.
    """
    at = [F.avg(F.get(F.col(embedding), i).cast("double")) for i in range(dimension)]
    return df.groupBy(by).agg(F.array(*at).alias("embedding"))
