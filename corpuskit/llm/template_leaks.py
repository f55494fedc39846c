"""Benchmark questions in documents, also with other numbers, names or units put in.

Words are read as templates: numbers, units after numbers and names become typed
placeholders. Windows of template words are joined by hash between documents and benchmark;
windows at the same distance form one alignment. An alignment counts if it is long enough and
its slots agree: wherever the question repeats a value, the document repeats its own.

Questions with one template that repeat values in the same places are one class, of which only
one is looked for: a benchmark made from a few templates costs and finds a few classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import RememberedOften, packed, small_batches, unpacked, window_hashes, worker_state
from corpuskit.session import durable

WINDOW = 8
LEAST_WINDOWS = 6  # aligned windows that make a leak: 13 words, or all of a shorter question
LEAST_LITERALS = 4  # words in a window that are no placeholders
BITMAP_BITS = 1 << 24
_BUCKET_BITS = 32768  # positions in one row of Spark's bitmap functions

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
NUMBER_UNIT = re.compile(r"(\d[\d.,]*)([a-zµ°]+\d?)")
WORDS_FOR_NUMBERS = frozenset(
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres inch inches "
    "foot feet yard yards mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l "
    "liter liters litre litres gallon gallons cup cups s sec secs second seconds min mins minute minutes h hr hrs hour "
    "hours day days week weeks month months year years km/h mph m/s dollar dollars euro euros cent cents usd eur gbp "
    "percent degree degrees celsius fahrenheit c f k j kj w kw v a hz khz mhz ghz b kb mb gb tb bits bytes".split()
)
_EDGES = "\"'“”‘’«»()[]{}<>.,;:!?…*_`"
_LITERAL, _NUMBER, _CAPITAL, _UNIT, _NUMBER_UNIT = range(5)
_ENDS = 8  # flag: a sentence ends after this word
_PLACE = np.array([0x1357_9BDF_0246_8ACE + k for k in range(5)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _kinds(words: list[str]) -> list[tuple[int, int]]:
    """Per word: hash of its bare form in lower case, and its kind with the sentence flag."""
    out = []
    for word in words:
        if word.isascii() and word.isalpha() and word.islower():
            kind = _NUMBER if word in WORDS_FOR_NUMBERS else _UNIT if word in UNITS else _LITERAL
            out.append((xxhash.xxh3_64_intdigest(word), kind))
            continue
        bare = word.strip(_EDGES)
        low = bare.lower()
        if not bare[:1].isalpha() and bare[-1:] in "0123456789%" and NUMBER.fullmatch(bare) or low in WORDS_FOR_NUMBERS:
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        elif bare[:1].isupper() and any(c.islower() for c in bare[1:]):
            kind = _CAPITAL  # words all in capitals say nothing about names
        elif bare[:1].isdigit() and (m := NUMBER_UNIT.fullmatch(low)) and m[2] in UNITS:
            kind = _NUMBER_UNIT
        else:
            kind = _LITERAL
        ends = word.rstrip("\"'”’»)]}")[-1:] in ".!?:;…"
        out.append((xxhash.xxh3_64_intdigest(low), kind | _ENDS * ends))
    return out


def _numbers(words: list[str]) -> np.ndarray:
    """A row for each word: what :func:`_kinds` says of it."""
    known = worker_state("template_words", lambda: RememberedOften(_kinds, np.uint64, 200_000))
    return known.numbers(words)[0].reshape(-1, 2)


def template(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The template forms of a text's words, see :func:`_forms`."""
    return _forms(_numbers(words))


def _forms(numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hash of each word's template form, and which words are placeholders, in two forms.

    A unit counts only after a number. A capital counts in the first form only inside a sentence,
    in the second form anywhere, so that this form does not depend on what precedes a passage.
    """
    hashes, flags = numbers[:, 0], numbers[:, 1].astype(np.int64)
    kind, ends = flags & 7, flags >= _ENDS
    after_number = np.append(False, kind[:-1] == _NUMBER)
    inside = np.append(False, ~ends[:-1])
    values = (kind == _NUMBER) | (kind == _NUMBER_UNIT) | ((kind == _UNIT) & after_number)
    slots = [values | ((kind == _CAPITAL) & inside), values | (kind == _CAPITAL)]
    return [(np.where(slot, _PLACE[kind], hashes), slot) for slot in slots]


def windows_of(texts: list[str | None], width: int) -> Iterator[tuple[list[str], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """For each text its words, and by form: slots, hashes of template windows, which windows have enough literal words."""
    split = [t.split() if t else [] for t in texts]
    sizes = [len(words) if len(words) >= width else 0 for words in split]
    numbers = _numbers([w for words, size in zip(split, sizes) if size for w in words])
    at = 0
    for words, size in zip(split, sizes):
        forms = []
        for hashes, slot in _forms(numbers[at : at + size]) if size else ():
            literal = np.append(0, np.cumsum(~slot))
            enough = literal[width:] - literal[:-width] >= min(LEAST_LITERALS, width)
            forms.append((slot, window_hashes(hashes, width), enough))
        at += size
        yield words, forms


def _window_rows(rows: list, width: int, wanted=None) -> pa.RecordBatch:
    """``id, key, form, h, at, n, slots`` of the windows of ``(id, key, text)`` rows.

    Without ``wanted``, for benchmark items, slots tell only which values are the same: they hold
    the number of the value in the item.
    """
    ids, keys, kinds, hashes, places, totals, slots = [], [], [], [], [], [], []
    for (doc, key, _), (words, forms) in zip(rows, windows_of([text for *_, text in rows], width)):
        for form, (slot, own, enough) in enumerate(forms):
            at = np.flatnonzero(enough if wanted is None else enough & wanted(own))
            filled = {i: words[i].strip(_EDGES).lower() for i in np.flatnonzero(slot).tolist()} if len(at) else {}
            if wanted is None:
                number = {v: str(k) for k, v in enumerate(dict.fromkeys(filled.values()))}
                filled = {i: number[v] for i, v in filled.items()}
            for i in at.tolist():
                ids.append(doc)
                keys.append(key)
                kinds.append(form)
                hashes.append(int(own[i]) - (1 << 64) if own[i] >> np.uint64(63) else int(own[i]))
                places.append(i)
                totals.append(int(enough.sum()))
                slots.append([filled[j] for j in range(i, i + width) if j in filled])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(kinds, pa.int64()), pa.array(hashes, pa.int64()),
            pa.array(places, pa.int64()), pa.array(totals, pa.int64()), pa.array(slots, pa.list_(pa.string())),
        ],
        ["id", "key", "form", "h", "at", "n", "slots"],
    )


_SCHEMA = "id bigint, key bigint, form bigint, h bigint, at bigint, n bigint, slots array<string>"


def _benchmark_windows(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield _window_rows(list(zip(*[c.to_pylist() for c in batch.columns])), width)

    rows = packed(
        benchmark, id=F.col(f"`{item_id}`").cast("bigint"), key=F.lit(0).cast("bigint"), text=F.col(f"`{text}`")
    )
    return rows.drop("row").filter("id is not null").mapInArrow(run, _SCHEMA)


def item_classes(
    benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", width: int = WINDOW
) -> tuple[DataFrame, DataFrame]:
    """``(item_id, class_id, n_items)``, and the windows of the one item that stands for each class.

    ``class_id`` is the least id of the items that have the same template windows in the same places,
    and the same values repeated, and ``n_items`` their number. Items without windows are in
    no class. Items with equal ids are one item. An action.
    """
    windows = durable(_benchmark_windows(benchmark, item_id, item_text, width).distinct(), "benchmark-windows")
    # As long as the item is.
    whole = F.sort_array(F.collect_list(F.struct("form", "at", "h", "n", "slots")))
    of_item = windows.groupBy(F.col("id").alias("item_id")).agg(whole.alias("windows"))
    keyed = of_item.select("item_id", F.sha2(F.to_json("windows"), 256).alias("key"))
    classes = keyed.groupBy("key").agg(F.min("item_id").alias("class_id"), F.count("*").alias("n_items"))
    members = durable(keyed.join(classes, "key").select("item_id", "class_id", "n_items"), "item-classes")
    leaders = members.filter("item_id = class_id").select(F.col("class_id").alias("id"), "n_items")
    return members, durable(windows.join(leaders, "id"), "class-windows")


def _bitmap(windows: DataFrame) -> dict[int, bytes]:
    """Which hash positions the benchmark has: at most 512 rows of 4 KB, however large it is."""
    spot = F.pmod("h", F.lit(BITMAP_BITS))
    rows = windows.select((spot / _BUCKET_BITS).cast("int").alias("bucket"), (spot % _BUCKET_BITS).alias("bit"))
    return {r.bucket: bytes(r.bits) for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()}


def _document_windows(docs: DataFrame, doc_id: str, text: str, width: int, bitmap: dict[int, bytes]) -> DataFrame:
    size = _BUCKET_BITS // 8
    bits = b"".join(bitmap.get(i, b"").ljust(size, b"\0") for i in range(BITMAP_BITS // _BUCKET_BITS))
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8)

        def wanted(hashes: np.ndarray) -> np.ndarray:
            spot = hashes & np.uint64(BITMAP_BITS - 1)
            return (known[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in small_batches(batches):
            yield _window_rows(list(zip(*[c.to_pylist() for c in batch.columns])), width, wanted)

    rows = packed(
        docs, id=F.col(f"`{doc_id}`").cast("bigint"), key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), text=F.col(f"`{text}`")
    )
    return rows.drop("row").mapInArrow(run, _SCHEMA)


def alignments(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = WINDOW,
) -> DataFrame:
    """``doc_id, key, item_id, n_items, shift, matched, windows, agree`` for every class of items, distance and form that meet.

    ``item_id`` is the least of the class's ``n_items`` items, see :func:`item_classes`. ``matched`` of
    its ``windows`` windows lie in the document ``shift`` words further on; ``agree`` says
    that equal values of the item are equal in the document.
    """
    _, items = item_classes(benchmark, item_id, item_text, width)
    found = _document_windows(docs, doc_id, text, width, _bitmap(items))
    left = found.select("id", "key", "form", "h", "at", F.col("slots").alias("own"))
    right = items.select(
        F.col("id").alias("item_id"), "n_items", "form", "h", F.col("at").alias("item_at"), F.col("n").alias("windows"), F.col("slots").alias("theirs")
    )
    met = left.join(right, ["h", "form"]).select(
        "id", "key", "form", "item_id", "n_items", "windows", "at", (F.col("at") - F.col("item_at")).alias("shift"),
        F.arrays_zip("theirs", "own").alias("values"),
    )
    # An alignment is as long as its item, so what is collected for it is bounded by the item.
    lines = met.groupBy("id", "key", "form", "item_id", "n_items", "shift", "windows").agg(
        F.count_distinct("at").alias("matched"), F.array_distinct(F.flatten(F.collect_list("values"))).alias("values")
    )
    theirs = F.array_distinct(F.transform("values", lambda v: v["theirs"]))
    return lines.select(
        F.col("id").alias("doc_id"), "key", "item_id", "n_items", "shift", "matched", "windows", (F.size(theirs) == F.size("values")).alias("agree")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``doc_id, contaminated, items, n_items, n_windows`` for every row of ``docs``.

    ``items`` are the benchmark items found, in order, the least of each class of items with one
    template, and ``n_items`` is how many items these classes have (:func:`item_classes` names them);
    ``n_windows`` is the length of the longest alignment among them. A null text or an empty benchmark has no leaks; items or
    texts of fewer than ``WINDOW`` words, or whose windows are mostly placeholders, are not
    looked for; items without an id are left out. A row without an id is judged like any
    other. Repeated rows come back repeated, and whole texts are read.

    Documents are read once and only windows the benchmark may have leave their task, so the
    join moves little; a passage in very many documents is split by the join's skew handling.
    """
    return _joined(docs, benchmark, doc_id, text, **how).select(
        F.col("row")[doc_id].alias("doc_id"),
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("n_windows", F.lit(0)).cast("bigint").alias("n_windows"),
    )


def _hits(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, **how) -> DataFrame:
    lines = alignments(docs, benchmark, doc_id, text, **how)
    lines = lines.filter(F.col("agree") & (F.col("matched") >= F.least(F.col("windows"), F.lit(LEAST_WINDOWS))))
    found = lines.groupBy(F.coalesce("doc_id", F.lit(-1)).alias("hit_id"), F.col("key").alias("hit_key")).agg(
        F.array_sort(F.collect_set(F.struct("item_id", "n_items"))).alias("classes"), F.max("matched").alias("n_windows")
    )
    n_items = F.aggregate("classes", F.lit(0).cast("bigint"), lambda total, c: total + c["n_items"])
    return durable(found.select("hit_id", "hit_key", F.col("classes.item_id").alias("items"), n_items.alias("n_items"), "n_windows"), "leaks")


def _joined(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, **how) -> DataFrame:
    rows = packed(
        docs.select(doc_id, text),
        hit_id=F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-1)), hit_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")),
    )
    rows = rows.select(F.struct(F.col("row")[doc_id].alias(doc_id)).alias("row"), "hit_id", "hit_key")
    return rows.join(_hits(docs, benchmark, doc_id, text, **how), ["hit_id", "hit_key"], "left")


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the contaminated documents."""
    rows = packed(
        docs,
        hit_id=F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(-1)), hit_key=F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")),
    )
    return unpacked(rows.join(_hits(docs, benchmark, doc_id, text, **how).select("hit_id", "hit_key"), ["hit_id", "hit_key"], "left_anti"))
