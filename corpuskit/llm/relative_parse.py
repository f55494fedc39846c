"""Repeated passages by parsing every document relative to all documents with smaller ids.

The reference is all documents, cut into blocks by a hash of their id. Each block's index knows
the first document of the block, and the place in it, where a window of consecutive words starts.
A document is factored greedily against every block: where a window of it is in some block, the
block whose source goes on longest with the same words gives the factor, source and place in the
source included; the next factor starts at the next window that any block has. So windows across
the end of a factor are looked up like any other, and the factors are the duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import mixed, packed, small_batches, window_hashes, word_hashes
from corpuskit.session import durable

WINDOW = 13
ANCHOR = 5
BLOCKS = 4
_GRAMS = WINDOW - ANCHOR + 1
_HELD = 1 << 19  # anchors that a task looks through at once
_ANCHOR_NAMES = ["deal", "anchor", "text_hash", "doc_id", "known"]


def anchors_of(hashes: np.ndarray) -> np.ndarray:
    """For each window its anchor: the least hash of the short grams inside it.

    Equal windows have equal anchors, and neighbouring windows mostly share one, so there
    are far fewer anchors than windows to index.
    """
    grams = window_hashes(hashes, ANCHOR)
    if len(grams) < _GRAMS:
        return np.empty(0, np.uint64)
    least, width = grams, 1
    while width < _GRAMS:
        step = min(width, _GRAMS - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def text_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        words = [text_words(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([_digest(w) for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int64()),
            ],
            ["doc_id", "row_key", "digest", "n"],
        )


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Places at which the values of any column change, in rows sorted by them."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _anchor_rows(anchors: np.ndarray, ids: np.ndarray, texts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``deal, anchor, text_hash, doc_id, known`` of the anchors of some documents.

    Of equal texts only the least id is told. An anchor that two of the texts share is known to be
    shared: its rows go on by document, and just two rows without one tell the others. So
    an anchor has no more rows to meet than there were such sets of documents.
    """
    order = np.argsort(anchors, kind="stable")
    anchors, ids, texts = anchors[order], ids[order], texts[order]
    groups = _runs(anchors)
    several = np.repeat(np.diff(np.append(groups, len(anchors))) > 1, np.diff(np.append(groups, len(anchors))))
    # Most anchors are in one text; only the others have to be looked at more closely.
    order = np.lexsort((ids[several], texts[several], anchors[several]))
    close = [x[several][order] for x in (anchors, ids, texts)]
    at = _runs(close[0], close[2])
    anchors, ids, texts = (np.concatenate([x[~several], y[at]]) for x, y in zip((anchors, ids, texts), close))
    groups = _runs(anchors)
    sizes = np.diff(np.append(groups, len(anchors)))
    known = np.repeat(sizes > 1, sizes)
    told = np.concatenate([groups[sizes > 1], (groups + sizes - 1)[sizes > 1]])
    deal = np.where(known, mixed(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), anchors)
    own = pa.RecordBatch.from_arrays(
        [pa.array(deal), pa.array(anchors), pa.array(texts), pa.array(ids), pa.array(known)], _ANCHOR_NAMES
    )
    yield own
    if len(told):
        nobody = pa.nulls(len(told), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors[told]), pa.array(anchors[told]), pa.array(texts[told]), nobody, pa.array(np.zeros(len(told), bool))], _ANCHOR_NAMES
        )


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0

    def flushed() -> Iterator[pa.RecordBatch]:
        for rows in _anchor_rows(*map(np.concatenate, zip(*held))):
            for at in range(0, rows.num_rows, 1 << 14):
                yield rows.slice(at, 1 << 14)

    for batch in small_batches(batches, rows=128):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = text_words(text)
            if len(words) < WINDOW:
                continue
            own = np.unique(anchors_of(word_hashes(words))).view(np.int64)
            digest = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
            held.append((own, np.full(len(own), doc, np.int64), np.full(len(own), digest, np.int64)))
            count += len(own)
        if count >= _HELD:
            yield from flushed()
            held, count = [], 0
    if held:
        yield from flushed()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``anchor, doc_id`` of the anchors that two different texts have; rows come sorted by ``deal, text_hash, doc_id``."""
    names, left = ["anchor", "doc_id"], None
    for batch in batches:
        known = batch.column(4).to_numpy(zero_copy_only=False)
        sure = batch.filter(pa.array(known))
        yield pa.RecordBatch.from_arrays([sure.column(1), sure.column(3)], names)
        rest = batch.filter(pa.array(~known))
        anchors, texts = rest.column(1).to_numpy(), rest.column(2).to_numpy()
        real = rest.column(3).is_valid().to_numpy(zero_copy_only=False)
        ids = rest.column(3).fill_null(0).to_numpy()
        if left is not None:
            anchors, texts, real, ids = (np.concatenate(x) for x in zip(left, (anchors, texts, real, ids)))
        if not len(anchors):
            continue
        # Of rows of one text the first with an id counts; those without come before it.
        starts = np.zeros(len(anchors), bool)
        starts[_runs(anchors, texts)] = True
        first = real & (starts | ~np.append(False, real[:-1]))
        groups = _runs(anchors)
        sizes = np.diff(np.append(groups, len(anchors)))
        shared = np.add.reduceat(starts, groups) > 1
        met = np.repeat(shared, sizes) & first
        yield pa.RecordBatch.from_arrays([pa.array(anchors[met]), pa.array(ids[met])], names)
        # The last anchor may go on: of a shared one two rows without a document are kept, else its one document.
        if shared[-1]:
            left = anchors[[-1, -1]], texts[[groups[-1], -1]], np.zeros(2, bool), ids[[-1, -1]]
        else:
            own = groups[-1] + np.flatnonzero(first[groups[-1] :])[:1]
            own = own if len(own) else groups[-1:]
            left = anchors[own], texts[own], real[own], ids[own]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, rows=64):
        rows, firsts, seconds, places = [], [], [], []
        for row, (text, repeated) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
            hashes = word_hashes(text_words(text))
            if len(hashes) < WINDOW:
                continue
            wanted = repeated.values.to_numpy().view(np.uint64)
            wanted = np.sort(wanted)
            anchors = anchors_of(hashes)
            found = np.searchsorted(wanted, anchors)
            at = np.flatnonzero(wanted[np.minimum(found, len(wanted) - 1)] == anchors)
            first = window_hashes(hashes, WINDOW, at)
            # The second hash sees the words through another function, for 96 bits in all.
            second = window_hashes(mixed(hashes), WINDOW, at) >> np.uint64(32)
            rows.append(np.full(len(at), row))
            firsts.append(first.view(np.int64))
            seconds.append(second.astype(np.uint32).view(np.int32))
            places.append(at.astype(np.int32))
        if rows:
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(firsts)), pa.array(np.concatenate(seconds)),
                    batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(places)),
                ],
                ["h1", "h2", "doc_id", "row_key", "at"],
            )


def factors_of(hits: np.ndarray, width: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """``(start, end, source, source_start)`` of the greedy factors of one document, in words, end exclusive.

    ``hits`` has a row ``(place, block, source, source place)`` for each window and block. A factor goes on while the next
    window is at the next place of the same source; of the blocks the one that goes on longest counts.
    """
    if not len(hits):
        return []
    place, block, source, there = np.unique(hits, axis=0).T
    order = np.lexsort((place, block))
    place, block, source, there = place[order], block[order], source[order], there[order]
    # A block has one source for each window, so its hits are one a place; where does each stretch of them end?
    breaks = np.flatnonzero((np.diff(place) != 1) | (np.diff(there) != 1) | (np.diff(source) != 0) | (np.diff(block) != 0))
    stretch_end = place[np.append(breaks, len(place) - 1)][np.searchsorted(breaks, np.arange(len(place)))]
    # The best block at each place, then from factor to factor.
    order = np.lexsort((block, -stretch_end, place))
    best = order[_runs(place[order])]
    places, out, at = place[best], [], 0
    while at < len(best):
        hit = best[at]
        out.append((int(place[hit]), int(stretch_end[hit]) + width, int(source[hit]), int(there[hit])))
        at = int(np.searchsorted(places, stretch_end[hit], "right"))
    return out


def spans_of(factors: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Word spans that factors cover; they begin in order and may overlap."""
    spans: list[list[int]] = []
    for start, end, *_ in factors:
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    return [(s, e) for s, e in spans]


def repeated_places(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, row_key, copy_of, hits``: what each affected row repeats of earlier documents.

    ``copy_of`` is set for rows whose word sequence is that of an earlier document: the first of
    them; otherwise ``hits`` are the windows that also start in an earlier document, with
    the first such document of each block.
    """
    narrow = packed(
        docs, doc_id=F.col(f"`{doc_id}`").cast("bigint"),
        row_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), text=F.col(f"`{text}`"),
    ).drop("row").filter("doc_id is not null")
    texts = durable(narrow.mapInArrow(_texts, "doc_id bigint, row_key bigint, digest binary, n bigint").filter(F.col("n") >= WINDOW), "texts")
    firsts = texts.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = texts.join(firsts, "digest").filter("doc_id > first").groupBy("doc_id", "row_key").agg(F.min("first").alias("copy_of"))
    copies = durable(copies, "copies")

    # Anchors in texts that differ; only around them can a window be in two documents.
    anchors = narrow.select("doc_id", "text").mapInArrow(_anchors, "deal bigint, anchor bigint, text_hash bigint, doc_id bigint, known boolean")
    met = anchors.repartition("deal").sortWithinPartitions("deal", "text_hash", "doc_id")
    own = met.mapInArrow(_shared, "anchor bigint, doc_id bigint")
    own = own.join(firsts.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    own = durable(own.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors")), "anchors")

    looked_at = narrow.join(own, "doc_id")
    windows = durable(
        looked_at.mapInArrow(_windows, "h1 bigint, h2 int, doc_id bigint, row_key bigint, at int"), "windows"
    )
    block = F.pmod(F.xxhash64("doc_id"), F.lit(BLOCKS)).cast("int")
    # Document and place in one number, which aggregates by hash; a struct would be sorted.
    base = F.lit(1 << 32).cast("decimal(11,0)")
    spot = (F.col("doc_id").cast("decimal(38,0)") * base + F.col("at").cast("decimal(11,0)")).cast("decimal(38,0)")
    # At most BLOCKS sources a window, all in one shuffle. Written, so that the join has a shuffle of its own whose hot keys can be split.
    spots = [f"spot{b}" for b in range(BLOCKS)]
    index = windows.select("h1", "h2", "doc_id", block.alias("block"), spot.alias("spot")).groupBy("h1", "h2").agg(
        *[F.min(F.when(F.col("block") == b, F.col("spot"))).alias(spots[b]) for b in range(BLOCKS)], F.max("doc_id").alias("last")
    )
    # The first place is before the last document begins if these are two documents.
    index = index.filter(F.least(*spots) < F.col("last").cast("decimal(38,0)") * base)
    found = []
    for b, name in enumerate(spots):
        there = F.pmod(F.col(name), base)
        source = ((F.col(name) - there) / base).cast("bigint")
        found.append(F.when(F.col(name).isNotNull(), F.struct(F.lit(b).alias("block"), source.alias("source"), there.cast("int").alias("there"))))
    index = index.select("h1", "h2", F.filter(F.array(*found), lambda s: s.isNotNull()).alias("sources"))
    index = durable(index.select("h1", "h2", F.array_min(F.transform("sources", lambda s: s["source"])).alias("first"), "sources"), "index")
    again = windows.join(index, ["h1", "h2"]).filter("doc_id > first").select(
        "doc_id", "row_key", "at", F.filter("sources", lambda s: s["source"] < F.col("doc_id")).alias("sources")
    )
    again = again.join(copies, ["doc_id", "row_key"], "left_anti").groupBy("doc_id", "row_key").agg(
        F.collect_list(F.struct("at", "sources")).alias("hits")
    )
    none = F.lit(None).cast(again.schema["hits"].dataType)
    return again.select("doc_id", "row_key", F.lit(None).cast("bigint").alias("copy_of"), "hits").unionByName(
        copies.select("doc_id", "row_key", "copy_of", none.alias("hits"))
    )


_SPANS = "spans array<struct<start:bigint,end:bigint>>"
_FACTORS = "factors array<struct<start:bigint,end:bigint,source:bigint,source_start:bigint>>"


def _hit_rows(column: pa.ListArray) -> list[np.ndarray]:
    """The hits of each row of a column as :func:`factors_of` takes them."""
    ends = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy()))
    flat = column.flatten()
    at, sources = flat.field("at").to_numpy(), flat.field("sources")
    sizes, each = sources.value_lengths().to_numpy(), sources.flatten()
    rows = np.column_stack([np.repeat(at, sizes).astype(np.int64), *[each.field(n).to_numpy().astype(np.int64) for n in ("block", "source", "there")]])
    return np.split(rows, np.append(0, np.cumsum(sizes))[ends[1:-1]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    factor = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "source", "source_start")]))
    for batch in small_batches(batches):
        counts, gone, spans, factors, kept = [], [], [], [], []
        for text, copy_of, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), _hit_rows(batch.column(3))):
            words = text_words(text)
            if copy_of is not None:
                own = [(0, len(words), copy_of, 0)]
            else:
                own = factors_of(hits)
            left, at, covered = [], 0, spans_of(own)
            for s, e in covered:
                left += words[at:s]
                at = e
            left += words[at:]
            counts.append(len(words))
            gone.append(len(words) - len(left))
            spans.append([{"start": s, "end": e} for s, e in covered])
            factors.append([dict(zip(("start", "end", "source", "source_start"), f)) for f in own])
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span),
                pa.array(factors, factor), pa.array(kept, pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "spans", "factors", "kept_text"],
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, spans, factors, kept_text`` for every row of ``docs``.

    A word goes if a window of 13 consecutive words around it also starts in a document with
    a smaller id; windows are those of the input. ``factors`` say where else: words ``start`` to
    ``end`` are those of document ``source`` from ``source_start`` on; factors may overlap, and
    ``spans`` are what they cover. Words are compared byte for byte. Null texts have no words; a
    row without an id is neither reference nor cut; rows with equal ids are one document, and
    repeated rows come back repeated. An empty table gives no rows. Texts of any length are read whole.

    First, hashes of short anchors are reduced within tasks and met by key; windows are indexed only
    around anchors that two different texts share, which is where repeats can be. No key's
    documents are gathered: of each only one document a block is kept, and the join back to
    the index has one row a key on one side, so that a hot key's rows can be split. Runs
    jobs while it is called.
    """
    found = durable(repeated_places(docs, doc_id, text), "repeats")
    rows = packed(
        docs, doc_id=F.col(f"`{doc_id}`").cast("bigint"),
        row_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), text=F.col(f"`{text}`"),
    ).drop("row")
    marked = rows.join(found, ["doc_id", "row_key"], "left").select("doc_id", "text", "copy_of", "hits")
    return marked.mapInArrow(_cut, f"doc_id bigint, n_words bigint, n_removed bigint, {_SPANS}, {_FACTORS}, kept_text string")
