"""Secrets in texts: three patterns, and random strings that a token vocabulary cannot shorten.

Ordinary words have several characters per token, random ones few. Strings that are random
for a known reason (digests, UUIDs) or are plainly identifiers or numbers are left alone.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import packed, small_batches, worker_state

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "random")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Our own choices for the token-efficiency test.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MAX_CHARACTERS_PER_TOKEN = 2.2
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
DIGEST = re.compile(r"[0-9A-Fa-f]+")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
# Words, or words and numbers joined by one kind of mark: names, paths, slugs.
IDENTIFIER = re.compile(r"[A-Za-z]?[a-z]*(?:[A-Z][a-z]+)*\d*|(?:[A-Za-z]+|\d+)(?:[_/=+-]+(?:[A-Za-z]+|\d+))*[_/=+-]*")

_KEYWORDS = ("passw", "secret", "token", "api")


def is_ordinary(s: str) -> bool:
    """Known digests, UUIDs, identifiers and plain numbers; also strings without letters and digits both."""
    if not (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
        return True
    if UUID.fullmatch(s) or (len(s) in DIGEST_LENGTHS and DIGEST.fullmatch(s)):
        return True
    return IDENTIFIER.fullmatch(s) is not None


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, ends exclusive, in code points."""
    found = []
    low = text.lower()
    # Lower-casing may change other characters' number, but not whether a keyword occurs.
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Efficiency:
    """Characters per token under a vocabulary file of ranks."""

    def __init__(self, ranks: bytes):
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary

    def random_spans(self, text: str, base: list[tuple[int, int, int]], most: float) -> list[tuple[int, int, int]]:
        found, at = [], 0
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            # Base spans stay as they are; what they touch is not reported twice.
            while at < len(base) and base[at][0] < start and base[at][2] <= start:
                at += 1
            if any(s < end and e > start for s, _, e in base[at : at + 64]) or is_ordinary(m[0]):
                continue
            if len(m[0]) < most * len(self.encode(m[0])):
                found.append((start, 3, end))
        return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(
    docs: DataFrame, ranks: bytes, doc_id: str = "doc_id", text: str = "text",
    max_characters_per_token: float = MAX_CHARACTERS_PER_TOKEN,
) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs``: a list of ``(kind, start, end)`` by start, then kind.

    ``ranks`` is the content of a vocabulary file of ranks. Whole texts are searched; a null
    text has no spans. Ids are passed through, null or repeated; an empty table gives no
    rows. No shuffle; candidates of one text at a time are tokenised.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # one file of about a MB
    key = xxhash.xxh3_64_hexdigest(ranks)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        efficiency = worker_state(f"efficiency_{key}", lambda: Efficiency(shared.value))
        for batch in small_batches(batches):
            rows = []
            for t in batch.column(1).to_pylist():
                t = t or ""
                base = base_spans(t)
                spans = sorted(base + efficiency.random_spans(t, base, max_characters_per_token))
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, span)], ["doc_id", "spans"])

    narrow = packed(docs, doc_id=F.col(f"`{doc_id}`"), text=F.col(f"`{text}`")).drop("row")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(search, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
    )


