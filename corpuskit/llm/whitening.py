"""Whitening of embeddings from the distinct vectors and how often each occurs.

Vectors are put on a grid of integers, equal ones become one row with their number, and all sums
run over these rows: counts and per-dimension sums exactly, the covariance as one matrix product
of centred, weighted rows per batch. Tasks send one matrix each, which meet in two steps; only the
``dims x dims`` result reaches the driver, whose eigenvectors go back to the tasks. Each distinct
vector is whitened once and joined back to the rows that hold it.

* Rows with a null vector, or with null or non-finite entries, are dropped; so are rows with an
  entry beyond 2**40 (its grid number would be no long) and rows whose number of entries is not
  the commonest one (the larger on a tie; an empty vector has none).
* Null ids and repeated rows are rows like others. Nothing left, or no variation: no result rows.
* Components whose variance cannot be told from zero in double precision are left out.
* Further columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import durable

# The grid.
SCALE, SHIFT = 64, 1_000_000

_LARGEST = float(1 << 40)
_MERGE = 16  # matrices that meet on the driver


class Whitening(NamedTuple):
    """``rows`` is ``(vec_id, x)``; ``vectors`` is ``(x, weight, deviation, whitened)``."""

    rows: DataFrame
    vectors: DataFrame
    n: int
    explained: list[float]
    identity_error: float | None


def on_grid(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(vec_id, x)``: the usable vectors as arrays of integers."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    usable = F.forall("v", lambda c: F.coalesce(F.abs(c) <= _LARGEST, F.lit(False)))
    held = embeddings.select(F.col(key).alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & usable & (F.size("v") > 0))
    # Guarded here too: Spark may look at the numbers before the rows are filtered.
    x = F.transform("v", lambda c: F.when(F.abs(c) <= _LARGEST, F.floor(c * SCALE) + F.lit(SHIFT).cast("bigint")))
    return held.select("vec_id", x.alias("x"))


def _common_length(rows: DataFrame) -> DataFrame:
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("x") == (first.d if first else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of rows behind ``vectors(x, weight)`` and their sum per dimension, as Python integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            x = _matrix(batch.column("x"))
            w = batch.column("weight").to_numpy(zero_copy_only=False)
            if not len(w):
                continue
            # Grid numbers stay below 2**47, so sums of this many weighted rows fit into a long.
            step = max(1, (1 << 62) // (int(np.abs(x).max()) * int(w.max()) + 1))
            total = total or [0] * (x.shape[1] + 1)
            for at in range(0, len(w), step):
                part = w[at : at + step] @ x[at : at + step] if step > 1 else x[at].astype(object) * int(w[at])
                total = [a + int(b) for a, b in zip(total, [*part, int(w[at : at + step].sum())])]
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["d", "total"])

    parts = vectors.select("x", "weight").mapInArrow(run, "d int, total decimal(38,0)")
    sums = [int(r.total) for r in parts.groupBy("d").agg(F.sum("total").alias("total")).orderBy("d").collect()]
    return (sums[-1], sums[:-1]) if sums else (0, [])


def _summed(matrices: DataFrame) -> np.ndarray | None:
    """The sum of all rows ``(part, m)``: first within ``_MERGE`` tasks, then on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for m in batch.column("m"):
                m = np.frombuffer(m.as_buffer(), np.float64)
                total = m.copy() if total is None else total + m
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["m"])

    met = matrices.repartition(_MERGE, "part").mapInArrow(run, "m binary").collect()
    return sum(np.frombuffer(r.m, np.float64) for r in met) if met else None


def _gram(vectors: DataFrame, column: str, mean: np.ndarray) -> np.ndarray:
    """Sum of ``weight * c c'`` over the centred rows ``c`` of a column: a matrix product per batch, a matrix per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                c = _matrix(batch.column(column)) - mean
                w = batch.column("weight").to_numpy(zero_copy_only=False)
                part = (c * w[:, None]).T @ c
                total = part if total is None else total + part
        if total is not None:
            part = TaskContext.get().partitionId() % _MERGE
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "m"])

    made = _summed(vectors.select(column, "weight").mapInArrow(run, "part int, m binary"))
    return np.zeros((len(mean), len(mean))) if made is None else made.reshape(len(mean), -1)


def _mean(vectors: DataFrame, column: str, n: int) -> np.ndarray:
    """The weighted mean of an array column of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                part = batch.column("weight").to_numpy(zero_copy_only=False) @ _matrix(batch.column(column))
                total = part if total is None else total + part
        if total is not None:
            part = TaskContext.get().partitionId() % _MERGE
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "m"])

    made = _summed(vectors.select(column, "weight").mapInArrow(run, "part int, m binary"))
    return np.zeros(0) if made is None else made / n


def squared(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S) ** 2`` for each row, exactly; null where no long holds it."""
    largest = (1 << 63) - 1
    spread = max((max(abs(n * int(hi) - s), abs(n * int(lo) - s)) for hi, lo, s in zip(x.max(0), x.min(0), sums)), default=0)
    if max(n * int(np.abs(x).max()), max(map(abs, sums)), spread * spread * len(sums)) <= largest:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    rows = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [r if r <= largest else None for r in rows]


def whiten(embeddings: DataFrame, components: int = 32, weights: str = "counts", vector: str = "embedding", key: str = "vec_id") -> Whitening:
    """Fits on the distinct vectors and whitens each of them once.

    ``weights`` says what a distinct vector counts for: ``counts`` its number of rows, so that the
    fit is that of all rows, ``one`` a single row however often it occurs. Runs jobs while it is called.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    rows = _common_length(on_grid(embeddings, vector, key))
    weight = F.count("*") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = durable(rows.groupBy("x").agg(weight.alias("weight")), "distinct-vectors")
    n, sums = _exact_sums(distinct)
    dims = len(sums)
    # The mean to double precision, also where the sum is too large for a double.
    mean = np.array([s // n + (s % n) / n for s in sums]) if n else np.zeros(0)
    covariance = _gram(distinct, "x", mean) / n if n else np.zeros((0, 0))
    values, basis = np.linalg.eigh(covariance) if dims else (np.zeros(0), np.zeros((0, 0)))
    values, basis = values[::-1], basis[:, ::-1]
    used = int((values > max(dims, 1) * np.finfo(float).eps * max(values, default=0)).sum()) if dims and values[0] > 0 else 0
    used = min(used, components)
    project = basis[:, :used] / np.sqrt(values[:used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                made = (x - mean) @ project
                whitened = pa.FixedSizeListArray.from_arrays(pa.array(made.ravel()), used).cast(pa.list_(pa.float64()))
                deviation = pa.array(squared(x, n, sums), pa.int64())
                yield pa.record_batch([batch.column("x"), batch.column("weight"), deviation, whitened], names)

    names = ["x", "weight", "deviation", "whitened"]
    shape = "x array<bigint>, weight bigint, deviation bigint, whitened array<double>"
    if not used:
        return Whitening(rows, rows.sparkSession.createDataFrame([], shape), n, [], None)
    vectors = durable(distinct.mapInArrow(run, shape), "whitened-vectors")
    off = _gram(vectors, "whitened", _mean(vectors, "whitened", n)) / n - np.eye(used)
    explained = (values[:used] / np.trace(covariance)).tolist()
    return Whitening(rows, vectors, n, explained, float(np.abs(off).max()))


def whitened_rows(embeddings: DataFrame, components: int = 32, weights: str = "counts") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component.

    Runs jobs while it is called.
    """
    done = whiten(embeddings, components, weights)
    shares = F.array(*[F.lit(e) for e in done.explained]).cast("array<double>")
    back = done.rows.join(done.vectors.drop("weight"), "x").select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return back.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(done.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(done.identity_error).cast("double").alias("identity_error"),
    )
