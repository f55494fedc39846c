"""Near-duplicate groups by an LSH forest.

Every text has a MinHash signature. Several orders sort the texts by the signature read from
different places. Texts that share the first values in an order form a region there. First
each text is compared with its longest-common-prefix neighbour and with the hub of its regions,
which joins most of every group. Then whatever in a region is still apart is compared, unless
bit sketches of the two show that they cannot be similar enough. Texts of crowded regions meet
by an exact prefix filter instead. Links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import components, in_fewer, packed, small_batches, unpacked, window_hashes, word_hashes
from corpuskit.session import durable

SHINGLE = 5
PERCENT = 75
ORDERS = 20
BASE_DEPTH = 3
CROWD = 64  # a region with more pairs to compare than this squared is crowded
ROUNDS = 3  # of joining neighbours, before what is still apart is compared
SKETCH_WORDS = 16  # 64-bit words of a text's sketch: parities of its shingles, dealt over the bits
_VALUES = ORDERS * BASE_DEPTH
_WIDTH = 4  # bytes of a value
_LABEL_VALUES = 8  # of the signature, by which an order is sorted
_LABEL = _LABEL_VALUES * _WIDTH
_MERGE = 16  # tasks that add up what all tasks have counted
_BUCKET_BITS = 20  # shingles are counted in so many buckets, as a power of two
_FACTORS = (np.random.default_rng(20).integers(0, 1 << 63, _VALUES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, as bytes."""
    return text.encode().lower().split() if text else []


def node_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(window_hashes(h, min(SHINGLE, len(h))))


def signatures(sets: list[np.ndarray]) -> tuple[list[bytes | None], list[list[int] | None]]:
    """MinHash values of each set, most significant byte first, so that bytes sort like values;
    and the sketch. The shingle hashes are random already, so a product with an odd number is a
    hash function.

    Each shingle turns over one bit of the sketch. A shingle that both of two sets have turns
    over the same bit in both, so their sketches differ in no more bits than there are shingles
    that only one of them has.
    """
    full = [i for i, s in enumerate(sets) if len(s)]
    out: list[bytes | None] = [None] * len(sets)
    sketches: list[list[int] | None] = [None] * len(sets)
    if full:
        flat = np.concatenate([sets[i] for i in full])
        sizes = [len(sets[i]) for i in full]
        starts = np.cumsum([0] + sizes[:-1])
        high = np.empty((len(full), _VALUES), np.uint32)
        for k, factor in enumerate(_FACTORS):
            high[:, k] = np.minimum.reduceat((flat * factor).view(np.uint32)[1::2], starts)
        bits = SKETCH_WORDS * 64
        place = np.repeat(np.arange(len(full)) * bits, sizes) + (flat & np.uint64(bits - 1)).astype(np.int64)
        odd = (np.bincount(place, minlength=len(full) * bits) & 1).astype(np.uint8).reshape(len(full), bits)
        packed_bits = np.packbits(odd, axis=1).view(np.int64)
        values = high.astype(">u4")
        for row, i in enumerate(full):
            out[i] = values[row].tobytes()
            sketches[i] = packed_bits[row].tolist()
    return out, sketches


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        words = [words_of(t) for t in batch.column(1).to_pylist()]
        sets = [shingle_set(w) for w in words]
        leading, sketches = signatures(sets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([node_of(w) for w in words], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(leading, pa.binary()),
                pa.array(sketches, pa.list_(pa.int64())),
            ],
            ["doc_id", "key", "node", "n", "sig", "sketch"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, rows=128):
        nodes, sets = [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            if node_of(words) == wanted:
                nodes.append(wanted)
                sets.append(shingle_set(words).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent rows of one region but of different groups, with the number of leading values
    they share; rows whose sizes or sketches show that they are not near are left out."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        regions = batch.column(0).to_numpy(zero_copy_only=False)
        nodes, roots = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        labels = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).reshape(-1, _LABEL_VALUES)
        sketches = batch.column(4).flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS)
        sizes = batch.column(5).to_numpy()
        if last is not None:
            regions, nodes, roots = np.append(last[0], regions), [last[1], *nodes], [last[2], *roots]
            labels, sketches = np.vstack([last[3], labels]), np.vstack([last[4], sketches])
            sizes = np.append(last[5], sizes)
        last = regions[-1:], nodes[-1], roots[-1], labels[-1:], sketches[-1:], sizes[-1:]
        other = np.fromiter((x != y for x, y in zip(roots, roots[1:])), bool, len(roots) - 1)
        differing = np.bitwise_count(sketches[1:] ^ sketches[:-1]).sum(axis=1, dtype=np.int64)
        few = (100 + PERCENT) * differing <= (100 - PERCENT) * (sizes[1:] + sizes[:-1])
        few &= 100 * np.minimum(sizes[1:], sizes[:-1]) >= PERCENT * np.maximum(sizes[1:], sizes[:-1])
        at = np.flatnonzero((regions[1:] == regions[:-1]) & other & few)
        shared = np.cumprod(labels[at] == labels[at + 1], axis=1).sum(axis=1)
        a, b = [nodes[i] for i in at], [nodes[i + 1] for i in at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(shared, pa.int64())], ["a", "b", "shared"]
        )


def _orders(classes: DataFrame) -> DataFrame:
    """Every class once per order, with the key of its region there."""
    trees = F.sequence(F.lit(0), F.lit(ORDERS - 1))
    first = F.substring("sig", F.col("tree") * (BASE_DEPTH * _WIDTH) + 1, F.lit(BASE_DEPTH * _WIDTH))
    return classes.select("node", "sig", F.explode(trees).alias("tree")).select(
        F.xxhash64("tree", first).alias("region"), "tree", "node"
    )


def _label():
    """The signature as the order reads it: from the order's own values on, around the end."""
    around = F.concat("sig", F.substring("sig", F.lit(1), F.lit(_LABEL)))
    return F.substring(around, F.col("tree") * (BASE_DEPTH * _WIDTH) + 1, F.lit(_LABEL))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("sum"))
        .filter(100 * F.col("both") >= PERCENT * (F.col("sum") - F.col("both")))
        .select("a", "b")
    )


def _near_size(n, m):
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _near_sketch(x, y, n, m):
    """False only for pairs that cannot be similar enough: at least so many shingles differ."""
    words = [F.bit_count(F.get(x, i).bitwiseXOR(F.get(y, i))) for i in range(SKETCH_WORDS)]
    return (100 + PERCENT) * reduce(lambda a, b: a + b, words) <= (100 - PERCENT) * (n + m)


def _beside(own: DataFrame, parts: int) -> DataFrame:
    """``a, b, shared``: neighbours in the sorted orders that are in different groups."""
    placed = own.select("region", "node", "root", "label", "sketch", "n", "tree").repartitionByRange(parts, "tree", "label", "node")
    placed = placed.sortWithinPartitions("tree", "label", "node").select("region", "node", "root", "label", "sketch", "n")
    return placed.mapInArrow(_neighbours, "a binary, b binary, shared bigint")


def _first_candidates(orders: DataFrame, parts: int, rows: int) -> DataFrame:
    """Two pairs a text: with its nearest neighbour in any order, and with the hub of its regions.

    The more texts share a text's regions, the more it is a hub. Copies of one original differ
    from it less than from each other, and so it, or a close copy, becomes the hub.
    """
    beside = _beside(orders.withColumn("root", F.col("node")), parts)
    ways = F.array(F.struct("a", "b", "shared"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "shared"))
    both = beside.select(F.inline(ways))
    nearest = in_fewer(both.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")), rows // ORDERS).select("a", "best.b")
    met = orders.groupBy("node").agg(F.sum("k").alias("met"))
    known = durable(in_fewer(orders.select("region", "node", "n").join(met, "node"), rows), "met")
    hubs = known.groupBy("region").agg(F.max(F.struct("met", "node", "n")).alias("hub"))
    led = in_fewer(known.select("region", "node", "n").join(hubs, "region"), rows).groupBy("node", "n").agg(F.max("hub").alias("hub"))
    led = in_fewer(led, rows // ORDERS).filter(_near_size(F.col("n"), F.col("hub.n")))
    return in_fewer(_each_once(nearest.union(led.select(F.col("node").alias("a"), F.col("hub.node").alias("b")))), rows // ORDERS)


def _more_candidates(orders: DataFrame, labels: DataFrame, parts: int, rows: int, step: int) -> DataFrame:
    """Pairs of different groups, of the regions that hold several: neighbours in any order, and
    each text outside a region's largest group with some member of that group."""
    own = durable(
        in_fewer(orders.join(labels, "node", "left"), rows).select(
            "region", "tree", "label", "node", "n", "sketch", F.coalesce("root", "node").alias("root")
        ),
        "grouped",
    )
    groups = own.groupBy("region", "root").agg(
        F.count("*").alias("k"), F.min(F.struct(F.xxhash64("node", "tree", F.lit(step)), "node", "n", "sketch")).alias("one")
    )
    groups = in_fewer(groups, rows)
    tops = groups.groupBy("region").agg(F.count("*").alias("groups"), F.max(F.struct("k", "root", "one")).alias("top"))
    tops = in_fewer(tops.filter("groups > 1"), rows).select("region", F.col("top.root").alias("largest"), "top.one")
    several = durable(in_fewer(own.join(durable(tops, "tops"), "region"), rows), "several")
    near = _near_sketch(F.col("sketch"), F.col("one.sketch"), F.col("n"), F.col("one.n"))
    near &= _near_size(F.col("n"), F.col("one.n"))
    some = several.filter((F.col("root") != F.col("largest")) & near).select(F.col("node").alias("a"), F.col("one.node").alias("b"))
    return in_fewer(_each_once(in_fewer(_beside(several, parts), rows).select("a", "b").union(some)), rows)


def _each_once(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _regions(orders: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """``tree, node, n, root, largest, region`` of the regions that still hold several groups
    and are not crowded, and ``node, root`` of the texts in crowded ones."""
    own = orders.join(labels, "node", "left").select("region", "tree", "node", "n", F.coalesce("root", "node").alias("root"))
    own = durable(in_fewer(own, rows), "regions")
    groups = in_fewer(own.groupBy("region", "root").agg(F.count("*").alias("k")), rows)
    state = groups.groupBy("region").agg(
        F.count("*").alias("groups"), F.sum("k").alias("all"), F.max(F.struct("k", "root")).alias("top")
    )
    crowded = (F.col("all") - F.col("top.k")) * F.col("all") > CROWD * CROWD
    state = state.filter("groups > 1").select("region", F.col("top.root").alias("largest"), crowded.alias("crowded"))
    state = durable(in_fewer(state, rows), "region-state")
    settled = own.join(state.filter("not crowded").drop("crowded"), "region")
    crowd = own.join(state.filter("crowded").select("region"), "region", "left_semi").select("node", "root")
    crowd = in_fewer(crowd, rows).dropDuplicates(["node"])
    return durable(in_fewer(settled, rows), "settled"), durable(in_fewer(crowd, rows // ORDERS), "crowd")


def _apart(settled: DataFrame, classes: DataFrame, count: int) -> DataFrame:
    """Pairs in a region that are in different groups and one of which is outside the region's
    largest group, each once: in the first order that has both in one region."""
    keys = F.map_from_entries(F.collect_list(F.struct("tree", "region")))
    by_order = F.transform(F.sequence(F.lit(0), F.lit(ORDERS - 1)), lambda t: F.element_at(F.col("keys"), t))
    of_node = settled.groupBy("node").agg(keys.alias("keys")).select("node", by_order.alias("keys"))
    known = of_node.join(classes.select("node", "sketch"), "node")
    rows = durable(in_fewer(settled.join(known, "node"), count), "apart")
    strays = rows.filter("root != largest").select(
        "region", "tree", F.col("node").alias("a"), F.col("n").alias("an"), F.col("root").alias("ar"),
        F.col("keys").alias("ak"), F.col("sketch").alias("x"),
    )
    others = rows.select(
        F.col("region").alias("r"), F.col("node").alias("b"), F.col("n").alias("bn"), F.col("root").alias("br"),
        (F.col("root") != F.col("largest")).alias("stray"), F.col("keys").alias("bk"), F.col("sketch").alias("y"),
    )
    # Region keys differ between orders, so a common key is a common region.
    earlier = F.arrays_overlap(F.slice("ak", F.lit(1), F.col("tree")), F.slice("bk", F.lit(1), F.col("tree")))
    pairs = strays.join(
        others,
        (F.col("region") == F.col("r")) & (F.col("ar") != F.col("br")) & (~F.col("stray") | (F.col("a") < F.col("b")))
        & _near_size(F.col("an"), F.col("bn")) & _near_sketch(F.col("x"), F.col("y"), F.col("an"), F.col("bn"))
        & ~F.coalesce(earlier, F.lit(False)),
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)


def _bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many texts have a shingle of each bucket, as 4 MB, however many texts there are.

    A task makes one row of its counts, those other than zero; rows are added up in a few tasks, then in one.
    """

    def row(counts: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(counts).astype(np.int32)
        made = [pa.array([at.tobytes()], pa.binary()), pa.array([counts[at].tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(made, ["at", "counts"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BUCKET_BITS, np.int64)
        for batch in batches:
            counts += np.bincount(_buckets(batch.column(0).flatten().to_numpy()), minlength=1 << _BUCKET_BITS)
        yield row(counts)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BUCKET_BITS, np.int64)
        for batch in batches:
            for at, k in zip(batch.column(0), batch.column(1)):
                counts[np.frombuffer(at.as_buffer(), np.int32)] += np.frombuffer(k.as_buffer(), np.int64)
        yield row(counts)

    shape = "at binary, counts binary"
    rows = texts.select("shingles").mapInArrow(counted, shape)
    for parts in (_MERGE, 1):
        rows = rows.repartition(parts).mapInArrow(added, shape)
    counts = np.zeros(1 << _BUCKET_BITS, np.int32)
    for made in rows.collect():
        counts[np.frombuffer(made["at"], np.int32)] = np.minimum(np.frombuffer(made["counts"], np.int64), (1 << 31) - 1)
    return counts


def _prefixes(texts: DataFrame) -> DataFrame:
    """``shingle, node, root, n, place``: the leading shingles of each text, rare ones first.

    All texts have their shingles in one order: by the count of the bucket, then by value. Two
    texts with enough in common share one of the first ``n - least + 1``, where ``least`` is
    the least intersection that a text of ``n`` shingles can have with one near it. A shingle
    alone in its bucket is in no other text and is left out.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_bucket_counts(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sizes = batch.column(2).value_lengths().to_numpy()
            shingles = batch.column(2).flatten().to_numpy()
            text = np.repeat(np.arange(len(sizes)), sizes)
            counts = shared.value[_buckets(shingles)]
            order = np.lexsort((shingles, counts, text))
            place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            leading = sizes - -(-PERCENT * sizes // 100) + 1
            at = np.flatnonzero((place < leading[text]) & (counts[order] > 1))
            rows = pa.array(text[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shingles[order[at]]), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(sizes[text[at]].astype(np.int64)), pa.array(place[at]),
                ],
                ["shingle", "node", "root", "n", "place"],
            )

    columns = "shingle bigint, node binary, root binary, n bigint, place bigint"
    return texts.select("node", "root", "shingles").mapInArrow(run, columns)


def _crowd_pairs(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different groups that a prefix filter cannot tell apart: none that is similar
    enough is missing, however many texts share a passage."""
    rows = durable(_prefixes(durable(sets.join(crowd, "node"), "crowd-sets")), "prefixes")
    groups = rows.groupBy("shingle", "root").agg(F.count("*").alias("k"))
    tops = groups.groupBy("shingle").agg(F.count("*").alias("groups"), F.max(F.struct("k", "root")).alias("top"))
    rows = durable(rows.join(tops.filter("groups > 1").select("shingle", F.col("top.root").alias("largest")), "shingle"), "crowd-rows")
    strays = rows.filter("root != largest").select(
        "shingle", F.col("node").alias("a"), F.col("n").alias("an"), F.col("root").alias("ar"), F.col("place").alias("ap")
    )
    others = rows.select(
        F.col("shingle").alias("s"), F.col("node").alias("b"), F.col("n").alias("bn"), F.col("root").alias("br"), F.col("place").alias("bp"),
        (F.col("root") != F.col("largest")).alias("stray"),
    )
    # What two texts have in common cannot be more than what follows their first common shingle.
    rest = F.least(F.col("an") - F.col("ap"), F.col("bn") - F.col("bp"))
    pairs = strays.join(
        others,
        (F.col("shingle") == F.col("s")) & (F.col("ar") != F.col("br")) & (~F.col("stray") | (F.col("a") < F.col("b")))
        & _near_size(F.col("an"), F.col("bn")) & ((100 + PERCENT) * rest >= PERCENT * (F.col("an") + F.col("bn"))),
    )
    return _each_once(pairs)


def _joined(labels: DataFrame, more: DataFrame, rows: int) -> DataFrame:
    """The labels that ``more`` links make of these; known groups go in as stars, which are settled in few rounds."""
    return components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), rows)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two texts are linked when the intersection of their sets of five-word shingles is at
    least 75 % of the union; a component is what links reach. Null, empty and wordless
    texts have no shingles and are linked with nothing. A null id takes part by its text; it
    never names a component that has other ids, and a component of null ids has a null id
    and is kept. Rows with equal ids are one document, repeated rows come back repeated. An
    empty table gives no rows. Texts are read whole, whatever their length.

    Equal word sequences are one class from the start, reduced within tasks. Chance of a
    missed link at exactly 75 %: below 1e-4 (20 orders, depth 3), less above it. Nothing is
    capped: regions compare all that is still apart, crowded ones by an exact prefix filter.
    Runs jobs while it is called.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The key finds a text again whatever its id, also without one.
    key = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    narrow = packed(docs, doc_id=F.col(f"`{doc_id}`"), text=F.col(f"`{text}`"), key=key).drop("row")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    signed = durable(narrow.mapInArrow(_signed, f"doc_id {kind}, key bigint, node binary, n bigint, sig binary, sketch array<bigint>"), "signatures")
    count = signed.count()
    classes = durable(
        in_fewer(
            signed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("key").alias("key"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.max("sketch").alias("sketch")),
            count, 1 << 12,
        ),
        "classes",
    )
    rows = _orders(classes)
    shared = rows.groupBy("region").agg(F.count("*").alias("k")).filter("k > 1")
    rows = durable(in_fewer(rows.join(shared, "region"), count * ORDERS, 1 << 16), "shared-regions")
    columns = ["region", "k", "tree", "node", "n", "sketch"]
    orders = durable(in_fewer(rows.join(classes, "node"), rows.count()).select(*columns, _label().alias("label")), "orders")
    count = orders.count()
    wanted = orders.select("node").distinct().join(classes, "node").select("key", "node")
    texts = narrow.select("key", "text").join(wanted, "key").select("text", "node")
    sets = durable(texts.mapInArrow(_set_rows, "node binary, shingles array<bigint>").dropDuplicates(["node"]), "sets")

    labels = components(_confirmed(_first_candidates(orders, parts, count), sets), count // ORDERS)
    for step in range(1, ROUNDS):
        labels = _joined(labels, _confirmed(_more_candidates(orders, labels, parts, count, step), sets), count // ORDERS)
    settled, crowd = _regions(orders, labels, count)
    pairs = _apart(settled, classes, count).union(_crowd_pairs(crowd, sets)).distinct()
    labels = _joined(labels, _confirmed(pairs, sets), count // ORDERS)

    named = classes.select("node", "rep").join(labels, "node", "left").select(
        "node", "rep", F.coalesce("root", "node").alias("root")
    )
    named = durable(named, "labels")
    ids = named.groupBy("root").agg(F.min("rep").alias("component"))
    reached = named.join(ids, "root").select("node", "component")
    return signed.select("doc_id", "node", "n").join(reached, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("doc_id").eqNullSafe(F.col("component"))).otherwise(True).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are not the least of their component."""
    gone = near_duplicates(docs, doc_id, text).filter("not kept and doc_id is not null")
    gone = durable(gone.select(F.col("doc_id").alias("gone_id")).distinct(), "near-copies")
    rows = packed(docs, own_id=F.col(f"`{doc_id}`"))
    return unpacked(rows.join(gone, rows.own_id == gone.gone_id, "left_anti"))
