"""Token ids in grammar-compressed shards that can be read at any place.

Ids are written in ascending document order. In each shard, frequent pairs of adjacent symbols
are replaced by new symbols, round after round; the shard keeps the remaining sequence, the
rules and how many ids each rule stands for. With these lengths a reader finds the symbols
that hold any range of ids and expands no others.

The file format is a Parquet table with one row a shard (``part, seq, before, doc_ids, sizes,
payload``), so that writing is committed as a whole and shards can be read in parallel.
Payload, little-endian: ``RPR1``, then unsigned 32-bit numbers: bytes per symbol (2 or 4),
first new symbol, rules, symbols; then left sides, right sides, symbols (each of that many
bytes) and the rules' lengths (32 bits).
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.llm.bpe_counts import byte_characters
from corpuskit.llm.common import SPACES, RememberedOften, packed, small_batches, worker_state
from corpuskit.session import new_path

SHARD_IDS = 1 << 16
END_ID = 2
ROUNDS = 8
LEAST_COUNT = 4
_BUCKETS = 1 << 16
_MAGIC = b"RPR1"
# ASCII punctuation but the apostrophe, which can belong to letters after it.
_MARKS = r"!-&(-/:-@\[-`{-~"
_ENDING = re.compile(rf"[{_MARKS}]+\Z")
_OTHER, _MARK, _LETTER, _SPACE = range(4)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[b for b in range(128) if _ENDING.match(chr(b))]] = _MARK
_KINDS[ord("a") : ord("z") + 1] = _LETTER
_KINDS[list(SPACES.encode())] = _SPACE


def compress(ids: np.ndarray, vocabulary: int) -> bytes:
    """Payload of one shard."""
    s = ids.astype(np.int64)
    first = max(vocabulary, int(s.max()) + 1 if len(s) else 0)
    left, right, lengths = [], [], []
    room = (1 << 16) - first if first < 1 << 16 else 1 << 24
    made = 0
    for step in range(ROUNDS):
        least = max(LEAST_COUNT, len(s) >> (9 + step))
        if len(s) < 2 or made >= room:
            break
        # One pair a bucket: the last written. Others with the same bucket wait a round.
        keys = (s[:-1] << 32) | s[1:]
        buckets = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).view(np.int64)
        # No pair is more frequent than its bucket, so most places need no further look.
        at = np.flatnonzero((np.bincount(buckets, minlength=_BUCKETS) >= least)[buckets])
        keys, inside = keys[at], buckets[at]
        holder = np.empty(_BUCKETS, np.int64)
        holder[inside] = keys
        own = holder[inside] == keys
        at, inside = at[own], inside[own]
        counts = np.bincount(inside, minlength=_BUCKETS)
        chosen = _alternate(at[counts[inside] >= least])
        # Overlaps cost some pairs their frequency; those are left for later rounds.
        used = np.bincount(buckets[chosen], minlength=_BUCKETS)
        picked = np.flatnonzero(used >= min(least, LEAST_COUNT))
        picked = picked[np.argsort(-used[picked], kind="stable")][: room - made]
        if not len(picked):
            if least == LEAST_COUNT:
                break
            continue
        symbol = np.zeros(_BUCKETS, np.int64)
        symbol[picked] = first + made + np.arange(len(picked))
        a, b = holder[picked] >> 32, holder[picked] & 0xFFFFFFFF
        known = np.concatenate([np.zeros(0, np.int64), *lengths])
        size = lambda x: np.where(x >= first, np.append(known, 0)[np.minimum(np.maximum(x - first, 0), len(known))], 1)
        left.append(a)
        right.append(b)
        lengths.append(size(a) + size(b))
        made += len(picked)
        chosen = chosen[symbol[buckets[chosen]] > 0]
        s[chosen] = symbol[buckets[chosen]]
        keep = np.ones(len(s), bool)
        keep[chosen + 1] = False
        s = s[keep]
    kind = np.dtype("<u2") if first + made <= 1 << 16 else np.dtype("<u4")
    head = np.array([kind.itemsize, first, made, len(s)], "<u4").tobytes()
    parts = [np.concatenate([np.zeros(0, np.int64), *x]).astype(kind).tobytes() for x in (left, right)]
    return b"".join([_MAGIC, head, *parts, s.astype(kind).tobytes(), np.concatenate([np.zeros(0, np.int64), *lengths]).astype("<u4").tobytes()])


def _is_plain(text: str, last: str) -> bool:
    """Whether normalising keeps the text and its letter ``last`` one letter."""
    return text.isascii() and last.isalpha() or (
        last.isalpha() and len(last.lower()) == 1 and unicodedata.is_normalized("NFC", text)
    )


def _alternate(places: np.ndarray) -> np.ndarray:
    """Every other one of each run of consecutive places: the pairs a reader from the left takes."""
    if not len(places):
        return places
    start = np.append(True, np.diff(places) > 1)
    run = np.maximum.accumulate(np.where(start, places, 0))
    return places[(places - run) % 2 == 0]


class Shard:
    """Reads ids back from a payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a shard")
        width, self.first, rules, symbols = np.frombuffer(payload, "<u4", 4, 4).tolist()
        kind = np.dtype(f"<u{width}")
        at = 20
        self.left = np.frombuffer(payload, kind, rules, at).astype(np.int64)
        self.right = np.frombuffer(payload, kind, rules, at + width * rules).astype(np.int64)
        self.symbols = np.frombuffer(payload, kind, symbols, at + 2 * width * rules).astype(np.int64)
        self.lengths = np.frombuffer(payload, "<u4", rules, at + 2 * width * rules + width * symbols).astype(np.int64)

    def _expanded(self, s: np.ndarray) -> np.ndarray:
        while True:
            rule = s >= self.first
            if not rule.any():
                return s
            out = np.repeat(s, np.where(rule, 2, 1))
            at = np.flatnonzero(rule)
            where = at + np.arange(len(at))  # each earlier rule has made the array one longer
            out[where] = self.left[s[at] - self.first]
            out[where + 1] = self.right[s[at] - self.first]
            s = out

    def ids(self) -> np.ndarray:
        return self._expanded(self.symbols)

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count``, expanding only the symbols that hold them."""
        if count <= 0:
            return np.empty(0, np.int64)
        sizes = np.where(self.symbols >= self.first, np.append(self.lengths, 1)[np.minimum(np.maximum(self.symbols - self.first, 0), len(self.lengths))], 1)
        ends = np.cumsum(sizes)
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, start + count, "left"))
        skip = start - int(ends[a] - sizes[a])
        return self._expanded(self.symbols[a : b + 1])[skip : skip + count]


class WordIds:
    """Ids of words under a tokenizer that treats white space as a boundary and ignores case.

    A text's ids are those of its words one after another, which holds for definitions that
    drop white space. A word is told to the library once while it is remembered; a run of
    ASCII punctuation after a letter is a piece of its own, and so the word before it is shared
    by all its endings: after an ASCII letter texts are cut there at once, after others once a word
    is looked at. Words of letters alone go to the library's model without the steps
    that would leave them as they are.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special_texts = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [t.encode() for t in self.special_texts]
        self.characters = byte_characters()
        self.words = RememberedOften(self._compute, np.uint32, 500_000)

    def _compute(self, words: list[bytes]) -> list[list[int]]:
        known: dict[str, list[int]] = {}
        cut: list[tuple[str | list[int], str]] = []  # a word of ASCII letters has its ids right away
        others = []
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            base, ending = word.decode(), ""
            if base.isalpha():
                if base.isascii() and base.islower():
                    cut.append(([t.id for t in tokenize(base)], ""))
                    continue
            else:
                found = _ENDING.search(base)
                if found and found.start() and _is_plain(base, base[found.start() - 1]) and not any(x in base for x in self.special_texts):
                    base, ending = base[: found.start()], found[0]
                    if ending not in known:
                        known[ending] = []
                        others.append(ending)
            cut.append((base, ending))
            if base not in known:
                if base.isascii() and base.isalpha() and base.islower():
                    known[base] = [t.id for t in tokenize(base)]
                elif base.isalpha() and base.islower() and _is_plain(base, base[-1]) and base == base.lower():
                    known[base] = [t.id for t in tokenize("".join(map(self.characters.__getitem__, base.encode())))]
                else:
                    known[base] = []
                    others.append(base)
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        known.update((text, e.ids) for text, e in zip(others, encoded))
        return [base if isinstance(base, list) else known[base] + known[ending] if ending else known[base] for base, ending in cut]

    def split(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Words of all texts, also cut between an ASCII letter and a mark, and how many there are up to the end of each."""
        raw = [t.encode() if t else b"" for t in texts]
        # Special strings are matched before case is dropped; their texts are cut at white space only.
        whole = {i for i, x in enumerate(raw) if b"<|" in x or any(s in x for s in self.specials)}
        lines = [x if i in whole else x.lower() for i, x in enumerate(raw)]
        ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
        flat = np.frombuffer(b"\n".join([*lines, b""]), np.uint8)
        kinds = _KINDS[flat]
        cuts = np.flatnonzero((kinds[1:] == _MARK) & (kinds[:-1] == _LETTER)) + 1
        for i in whole:
            cuts = cuts[(cuts < ends[i] - len(lines[i]) - 1) | (cuts >= ends[i])]
        starts = np.flatnonzero((kinds != _SPACE) & (np.append(_SPACE, kinds[:-1]) == _SPACE))
        return np.insert(flat, cuts, ord(" ")).tobytes().split(), np.searchsorted(starts, ends) + np.searchsorted(cuts, ends)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        words, before = self.split(texts)
        ids, sizes = self.words.numbers(words)
        ends = np.append(0, np.cumsum(sizes))[before]
        return np.split(ids, ends[:-1])


def write_ids(
    docs: DataFrame, definition: str, path: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> None:
    """Encodes the texts of ``docs`` and writes them as shards under ``path``.

    Order: id, then text; a null id comes first. Null text: only the end id. Documents are
    not cut, so a shard is as large as its longest document, and otherwise about
    ``shard_ids``. Repeated rows are written repeatedly; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # one file of a few MB
    key = xxhash.xxh3_64_hexdigest(definition)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"word_ids_{key}", lambda: WordIds(shared.value))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        ids, arrays, held = [], [], 0

        def shard() -> pa.RecordBatch:
            flat = np.concatenate(arrays)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([[len(a) for a in arrays]], pa.list_(pa.int64())),
                    pa.array([compress(flat, encoder.vocabulary)], pa.binary()),
                ],
                ["part", "seq", "before", "doc_ids", "sizes", "payload"],
            )

        end = np.array([end_id], np.uint32)
        for batch in small_batches(batches, rows=512, size=2 << 20):
            for doc, own in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                ids.append(doc)
                arrays.append(np.append(own, end))
                held += len(own) + 1
                if held >= shard_ids:
                    yield shard()
                    seq, before = seq + 1, before + held
                    ids, arrays, held = [], [], 0
        if arrays:
            yield shard()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = packed(docs, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=F.col(f"`{text}`")).drop("row")
    ordered = narrow.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(
        shards, "part int, seq bigint, before bigint, doc_ids array<bigint>, sizes array<bigint>, payload binary"
    ).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the shards under ``path``."""
    return _read(spark, path, "ids array<bigint>", lambda own: own.tolist(), pa.list_(pa.int64()))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the shards under ``path``."""
    crc = lambda own: zlib.crc32(own.astype("<u4").tobytes())
    return _read(spark, path, "ids_crc32 bigint", crc, pa.int64())


def _read(spark: SparkSession, path: str, column: str, make, kind: pa.DataType) -> DataFrame:
    shards = spark.read.parquet(path)
    # One row for each task that wrote.
    sums = shards.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = shards.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + F.col("before")).alias("start"), "doc_ids", "sizes", "payload"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start = batch.column(0)[row].as_py()
                sizes = batch.column(2)[row].values.to_numpy()
                flat = Shard(batch.column(3)[row].as_py()).ids()
                ends = np.cumsum(sizes)
                made = [make(own) for own in np.split(flat, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[row].values, pa.array(start + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()), pa.array(made, kind),
                    ],
                    ["doc_id", "start", "n_tokens", column.split()[0]],
                )

    return placed.mapInArrow(documents, f"doc_id bigint, start bigint, n_tokens bigint, {column}")


def encoded_digests(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of ``docs`` to a fresh folder of the shared one and reads them back."""
    path = new_path(docs.sparkSession, "ids")
    write_ids(docs, definition, path, doc_id, text)
    return read_digests(docs.sparkSession, path)
