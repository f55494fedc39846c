"""Token counts of a byte-level pair-merging vocabulary without making identifiers.

A piece starts as one symbol per byte, and each merge makes the symbols one fewer. Symbols
are held in a linked list and adjacent pairs in a heap by rank; the count is the initial
symbols minus the merges done.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import packed, small_batches, worker_state

LIMIT = 1024
_CACHED_PIECES = 300_000

# Fixed value: how texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable bytes stand for themselves; the others take the code points from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PieceCounter(dict):
    """Tokens per piece; remembers a bounded number of pieces."""

    def __init__(self, definition: str):
        super().__init__()
        import regex

        model = json.loads(definition)
        merges = model["model"]["merges"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        # Symbols become small numbers, so that a pair is one integer key.
        numbers: dict[str, int] = {}
        for c in byte_characters():
            numbers.setdefault(c, len(numbers))
        for a, b in pairs:
            numbers.setdefault(a + b, len(numbers))
        self.base = len(numbers)
        self.first = [numbers[c] for c in byte_characters()]
        self.ranks = {
            numbers[a] * self.base + numbers[b]: (rank, numbers[a + b])
            for rank, (a, b) in reversed(list(enumerate(pairs)))
        }
        self.pieces = regex.compile(PATTERN).findall
        specials = [t["content"] for t in model.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def __missing__(self, piece: str) -> int:
        if len(self) >= _CACHED_PIECES:
            self.clear()
        value = self[piece] = self.merged(piece.encode("utf-8", "surrogatepass"))
        return value

    def merged(self, piece: bytes) -> int:
        n = len(piece)
        if n == 1:
            return 1
        first, base, ranks = self.first, self.base, self.ranks
        symbols = [first[b] for b in piece]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = ranks.get(symbols[i] * base + symbols[i + 1])
            if found is not None:
                heap.append((found[0], i, found[1]))
        heapify(heap)
        merges = 0
        while heap:
            rank, i, made = heappop(heap)
            j = after[i] if symbols[i] >= 0 else n
            # An entry is stale once either symbol of its pair has changed.
            if j >= n or ranks.get(symbols[i] * base + symbols[j], (-1, 0))[0] != rank:
                continue
            symbols[i], symbols[j] = made, -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = ranks.get(made * base + symbols[k])
                if found is not None:
                    heappush(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = ranks.get(symbols[h] * base + made)
                if found is not None:
                    heappush(heap, (found[0], h, found[1]))
        return n - merges

    def tokens(self, text: str) -> int:
        if self.specials is None or self.specials.search(text) is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


def token_counts(docs: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``definition`` is the content of the tokenizer's JSON file. Whole texts are counted,
    special strings inside a text as one token each. Null text: no bytes, no tokens. Ids
    are passed through, null or repeated; an empty table gives no rows. No shuffle: a
    task reads its rows in small batches and remembers a bounded number of pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # one file of a few MB
    key = xxhash.xxh3_64_hexdigest(definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_state(f"piece_counter_{key}", lambda: PieceCounter(shared.value)).tokens
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            counts = [tokens(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    content = F.col(f"`{text}`")
    narrow = packed(docs, doc_id=F.col(f"`{doc_id}`"), text=content, n_bytes=F.coalesce(F.octet_length(content), F.lit(0)).cast("bigint"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    counted = narrow.drop("row").mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
