"""What several operators share: row packing, word hashing in tasks, connected components."""

from __future__ import annotations

import gc
import sys
import types
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.session import durable

# Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

_CACHED_WORDS = 200_000
_TASK_ROWS = 1 << 14  # narrow rows that are worth a task
_M = np.uint64(0xFF51AFD7ED558CCD)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def packed(docs: DataFrame, **named: Column) -> DataFrame:
    """The rows as one struct column ``row``, next to ``named`` columns.

    Whatever further columns the input has, they cannot clash with an operator's own.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in named.items()])


def unpacked(df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    fields = df.schema["row"].dataType.fieldNames()
    columns = [replaced[f].alias(f) if f in replaced else F.col("row")[f].alias(f) for f in fields]
    return df.select(*columns)


def worker_state(name: str, make: Callable[[], object]):
    """A value that stays in the Python worker, shared by its tasks.

    Workers are used again by later stages: when one of these makes a value, those that only
    earlier stages used are given up, so that the caches of several operators do not add up.
    """
    home = sys.modules.setdefault("_corpuskit_worker", types.ModuleType("_corpuskit_worker"))
    used = home.__dict__.setdefault("_used", {})
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if not hasattr(home, name):
        for old in [n for n, last in used.items() if last != stage]:
            delattr(home, old)
            del used[old]
        setattr(home, name, make())
    used[name] = stage
    return getattr(home, name)


class WordHashes(dict):
    """64-bit hash per word (bytes), remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = worker_state("word_hashes", WordHashes)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= _M
    x ^= x >> np.uint64(29)
    return x


def window_hashes(hashes: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """One hash for each ``width`` consecutive words, or for those that begin ``at`` places; the order of the words counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n if at is None else len(at), np.uint64)
    factor = 0x9E3779B97F4A7C15
    for i in range(width):
        out += (hashes[i : i + n] if at is None else hashes[at + i]) * np.uint64(factor)
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
    return mixed(out)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of few bytes, so that what a task derives from a piece stays small."""
    for batch in batches:
        step = rows if batch.nbytes <= size else max(1, min(rows, batch.num_rows * size // batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def in_fewer(df: DataFrame, rows: int, each: int = _TASK_ROWS) -> DataFrame:
    """``df``, of about ``rows`` narrow rows, in no more tasks than they are worth.

    Many shuffles of little data cost what their tasks and files cost. Only lowers the number of
    tasks, so a large table keeps the session's.
    """
    return df.coalesce(4 + rows // each)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the least node it reaches.

    ``rows``, if known, is about how many links there can be.

    Large-star and small-star rounds: neighbours are reduced to their minimum within tasks
    before they are shuffled, and each round is written to the shared folder, so a node
    with very many links is no single task's work. Self links and nulls are ignored; no
    links give no rows. Runs jobs while it is called.
    """
    edges = _oriented(links.select("a", "b"))
    edges = durable(edges if rows is None else in_fewer(edges, rows), "links")
    before = _digest(edges)
    while before[0]:
        edges = durable(_small_star(_large_star(edges, before[0]), before[0]), "links")
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    above = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return in_fewer(_oriented(in_fewer(above.join(least, "a"), rows).select(F.col("v").alias("a"), F.col("m").alias("b"))), rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = in_fewer(edges.join(least, "a"), rows).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return in_fewer(_oriented(hung.union(in_fewer(least, rows).select("a", F.col("m").alias("b")))), rows)



class Remembered:
    """Numbers made from words (ids, hashes), kept per worker for a bounded number of words.

    ``compute`` gets new words at once and returns a sequence of numbers for each. All numbers
    lie in one flat array, so that a batch of words is looked up without a loop over them.
    """

    def __init__(self, compute: Callable[[list], list], kind: type, most: int = 100_000):
        self.compute, self.kind, self.most = compute, kind, most
        self.forget()

    def forget(self) -> None:
        self._number({})
        self.used = 0
        self.flat = np.empty(1 << 16, self.kind)
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)

    def _number(self, known: dict) -> None:
        """From now on looking up a new word gives it the next number."""
        self.index: dict = defaultdict(count(len(known)).__next__, known)

    def _add(self, words: list, first: int) -> None:
        """Computes the numbers of words that are in the index from ``first`` on."""
        # Many small objects at once, none of them in cycles: looking for cycles would take most
        # of the time here.
        collecting = gc.isenabled()
        gc.disable()
        try:
            made = self.compute(words)
        finally:
            if collecting:
                gc.enable()
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(made) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.empty_like(self.sizes)])
        if total:
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(made), self.kind, total)
        self.starts[first : first + len(made)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first : first + len(made)] = sizes
        self.used += total

    def places(self, words: list) -> np.ndarray:
        """Number of each word; the numbers hold until the next call."""
        if len(self.index) > self.most:
            self.forget()
        first = len(self.index)
        try:
            at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            new = np.flatnonzero(at >= first)
            if len(new):
                where = np.empty(len(self.index) - first, np.int64)
                where[at[new] - first] = new
                self._add([words[i] for i in where.tolist()], first)
        except BaseException:
            # The worker lives on: no word may stay without what was to be computed.
            self._number({word: k for word, k in self.index.items() if k < first})
            raise
        return at

    def numbers(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """The words' numbers one after another, and how many each word has."""
        at = self.places(words)
        sizes = self.sizes[at]
        total = int(sizes.sum())
        shift = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(total)], sizes


class RememberedOften(Remembered):
    """The same, but when there are too many words, the half of them that came most often stays."""

    def forget(self) -> None:
        words = list(getattr(self, "index", ()))
        if not words:
            super().forget()
            self.came = np.zeros(0, np.int64)
            return
        kept = np.sort(np.argsort(self.came, kind="stable")[len(words) - self.most // 2 :])
        flat, sizes, came = self._flat(kept), self.sizes[kept], self.came[kept] // 2
        super().forget()
        self.flat = np.concatenate([flat, self.flat])
        self.used = len(flat)
        self.starts = np.concatenate([np.cumsum(sizes) - sizes, self.starts])
        self.sizes = np.concatenate([sizes, self.sizes])
        self.came = came
        self._number({words[i]: at for at, i in enumerate(kept.tolist())})

    def _flat(self, at: np.ndarray) -> np.ndarray:
        sizes = self.sizes[at]
        shift = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(int(sizes.sum()))]

    def places(self, words: list) -> np.ndarray:
        at = super().places(words)
        more = np.bincount(at, minlength=len(self.index))
        more[: len(self.came)] += self.came
        self.came = more
        return at
