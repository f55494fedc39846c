"""A trie of conversation prefixes, its subtree totals by time-forward processing.

Conversations are rebuilt so that some share their first turns; each distinct sequence of first
turns is a node. The trie is cut into shards by subtree size: the rows under a node over a limit
give its band, and neighbouring nodes of one band are a shard, so shards have bounded size
whatever turns conversations share. Shards of band zero are whole subtrees; those above are parts
of single paths. Within a task, nodes come sorted by reverse level order, each takes what its
children sent it from a priority queue that spills, and sends its own totals on to its parent.
First all whole subtrees run, then the shards' totals across shard roots (few: their number is
bounded by the number of shards, not by the data), then the nodes above with what came up to them.

* Turns are ordered by ``turn``, null first; turns with one number by a digest of their content.
* Null roles and texts are empty; rows without a ``conv_id`` belong to no conversation and are left out.
* An empty table has no conversation and no node; further columns are left alone.
* Turns and prefixes are told apart by 128 bits of hash, texts stay where they are read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators import scan
from corpuskit.session import durable

# Who shares whose first turns.
FAMILY, PREFIXES = 5, 9

# A shard holds this part of all rows at most.
SHARDS = 1024
_IN_MEMORY = 1 << 17
_CHUNK_BITS = 12

_NODE = "depth bigint, k1 bigint, k2 bigint, conv_id bigint, parent_depth bigint, p1 bigint, p2 bigint, n_convs bigint"
_TOTALS = "n_children bigint, n_leaves bigint, saved_tokens bigint"


class SpillingQueue:
    """Least tuple of five longs first; what memory has no room for lies in sorted runs.

    Runs are unnamed files of the task, gone with it; a lost task starts anew without them.
    """

    _RECORD = "<5q"

    def __init__(self, most: int = _IN_MEMORY):
        self.most, self.heap, self.runs, self.spilled = most, [], [], 0

    def push(self, item: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        file = tempfile.TemporaryFile()
        for at in range(0, len(self.heap), 4096):
            file.write(b"".join(struct.pack(self._RECORD, *item) for item in self.heap[at : at + 4096]))
        file.seek(0)
        self.heap = []
        self.spilled += 1
        self._advance(self._read(file))

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while block := file.read(4096 * struct.calcsize(self._RECORD)):
                yield from struct.iter_unpack(self._RECORD, block)

    def _advance(self, run: Iterator[tuple[int, ...]]) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.runs, (head, id(run), run))

    def take(self, key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Removes and gives the items that begin with ``key``, if they are the least."""
        while self.heap and self.heap[0][:3] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:3] == key:
            head, _, run = heapq.heappop(self.runs)
            self._advance(run)
            yield head

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)


def _forward(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(most)
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            told = zip(*[columns[n].to_pylist() for n in _FORWARD])
            out: tuple[list, list, list] = ([], [], [])
            for depth, k1, k2, parent, p1, p2, top, children, leaves, saved in told:
                for message in queue.take((-depth, k1, k2)):
                    children += 1
                    leaves += message[3]
                    saved += message[4]
                for values, v in zip(out, (children, leaves, saved)):
                    values.append(v)
                if not top:
                    queue.push((-parent, p1, p2, leaves, saved))
            kept = [columns[n] for n in _KEPT]
            yield pa.record_batch([*kept, *[pa.array(v, pa.int64()) for v in out]], [*_KEPT, "n_children", "n_leaves", "saved_tokens"])
        if queue:
            raise RuntimeError("a node's parent is missing from its shard")

    return run


_FORWARD = "depth k1 k2 parent_depth p1 p2 top in_children in_leaves in_saved".split()
_KEPT = "depth k1 k2 conv_id parent_depth p1 p2 n_convs top".split()


def time_forward(nodes: DataFrame, *shard: str, most: int = _IN_MEMORY) -> DataFrame:
    """Subtree totals of a forest that ``shard`` columns cut into pieces no task is too small for.

    ``nodes`` have their place (depth, k1, k2), that of their parent, ``top`` where the parent is in
    no or another shard, and what is known before their children in the shard send theirs: number
    of children, leaves and saved tokens. Memory is a batch of nodes and the queue's ``most`` items.
    """
    dealt = nodes.repartition(*shard) if shard else nodes.coalesce(1)
    ordered = dealt.select(*_KEPT, "in_children", "in_leaves", "in_saved").sortWithinPartitions(F.desc("depth"), "k1", "k2")
    return ordered.mapInArrow(_forward(most), f"{_NODE}, top boolean, {_TOTALS}")


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, t1, t2, bytes)``: each conversation's turns numbered from 1. An action."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    narrow = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), text, role).alias("t2"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    return scan.numbered(narrow, ["conv_id"], ["turn", "t1", "t2"], "pos").drop("turn")


def borrowed(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(PREFIXES)).cast("bigint")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, length)`` and ``(conv_id, length, depth, t1, t2, bytes)`` of the rebuilt conversations. An action."""
    own = durable(turns(conversations), "turns")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    h = borrowed(F.col("conv_id"))
    members = sizes.withColumns({"base": family, "h": h}).join(base, "base", "left")
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    members = members.withColumn("shared", shared).withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    members = durable(members.select("conv_id", "base", "h", "shared", "length"), "members")
    first = own.filter((F.col("pos") < PREFIXES) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "length", "depth", "t1", "t2", "bytes"]
    taken = first.join(members, "base").filter("pos <= h").withColumn("depth", F.col("pos"))
    rest = own.join(members, "conv_id").filter("pos > h").withColumn("depth", F.col("shared") + F.col("pos") - F.col("h"))
    return members.select("conv_id", "length"), taken.select(*columns).unionByName(rest.select(*columns))


def places(conversations: DataFrame) -> DataFrame:
    """``(conv_id, length, depth, k1, k2, p1, p2, bytes)``: each rebuilt conversation on its path from the root.

    A prefix is the exclusive or of its turns, each hashed with its position. An action.
    """
    members, rows = rebuilt(conversations)
    rows = rows.withColumns({"h1": F.xxhash64("depth", "t1", "t2"), "h2": F.xxhash64("t2", "depth", "t1")}).drop("t1", "t2")
    ranged = scan.in_ranges(rows, ["conv_id"], ["depth"])
    paths = scan.running(ranged, {"k1": ("xor", F.col("h1")), "k2": ("xor", F.col("h2"))})
    paths = paths.withColumns({"p1": F.col("k1").bitwiseXOR(F.col("h1")), "p2": F.col("k2").bitwiseXOR(F.col("h2"))})
    nothing = F.lit(0).cast("bigint")
    roots = members.select("conv_id", "length", *[nothing.alias(c) for c in ("depth", "k1", "k2", "p1", "p2", "bytes")])
    return durable(paths.select(*roots.columns).unionByName(roots), "places")


def ends(paths: DataFrame) -> DataFrame:
    """``(k1, k2, depth, ends_sha256)`` of the nodes where conversations end.

    Ids are joined in blocks of ids that lie close together, and the blocks of a node pass
    through its digest one after another: no list of a node's members is ever held whole.
    """
    chunk = F.shiftright("conv_id", _CHUNK_BITS)
    blocks = paths.filter("depth = length").groupBy("depth", "k1", "k2", chunk.alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", "k1", "k2", "ends_sha256"]
        at, digest = None, None

        def made(done: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])], names)

        for batch in batches:
            done = []
            for depth, k1, k2, ids in zip(*[batch.column(n).to_pylist() for n in ("depth", "k1", "k2", "ids")]):
                if (depth, k1, k2) == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (depth, k1, k2), hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield made(done)
        if at is not None:
            yield made([(*at, digest.hexdigest())])

    dealt = blocks.repartition("k1", "k2").sortWithinPartitions("depth", "k1", "k2", "chunk")
    return dealt.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _parted(paths: DataFrame, shards: int) -> DataFrame:
    """The nodes with their band and the place of their shard's top node. An action."""
    place = ["depth", "k1", "k2"]
    nodes = durable(
        paths.groupBy(*place).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("below"),
            F.count_if(F.col("length") == F.col("depth")).alias("n_ends"),
            F.max("bytes").alias("bytes"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
        ),
        "nodes",
    )
    total = (nodes.filter("depth = 0").first() or {"below": 0})["below"]
    limit = max(1, total // shards)
    nodes = nodes.withColumn("band", F.floor((F.col("below") - 1) / limit))
    # The root is on every path: its band is known without a join.
    banded = paths.filter("depth > 0").join(nodes.select(*place, "band"), place).select("conv_id", "band", *place)
    roots = paths.filter("depth = 0").select("conv_id", F.floor(F.lit(total - 1) / limit).alias("band"), *place)
    tops = banded.unionByName(roots).groupBy("conv_id", "band").agg(F.min(F.struct(*place)).alias("shard"))
    return durable(
        nodes.join(tops, ["conv_id", "band"]).select(
            *place,
            "conv_id",
            (F.col("depth") - 1).alias("parent_depth"),
            "p1",
            "p2",
            "n_convs",
            "band",
            "shard",
            F.struct(*place).eqNullSafe(F.col("shard")).alias("top"),
            (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("own_leaf"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
        ),
        "parted-nodes",
    )


def _sent(tops: DataFrame) -> DataFrame:
    """What top nodes send to the nodes above them, summed for each receiver before it moves."""
    return tops.groupBy(F.col("parent_depth").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved")
    )


def _receiving(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    got = nodes.join(messages, ["depth", "k1", "k2"], "left")
    none = F.lit(0).cast("bigint")
    return got.withColumns(
        {
            "in_children": F.coalesce("in_children", none),
            "in_leaves": F.coalesce("in_leaves", none) + F.col("own_leaf"),
            "in_saved": F.coalesce("in_saved", none) + F.col("own_saved"),
        }
    )


def totals(paths: DataFrame, shards: int = SHARDS, most: int = _IN_MEMORY) -> DataFrame:
    """Every node with its children, and the leaves and saved tokens of its subtree. An action."""
    nodes = _parted(paths, shards)
    none = F.lit(0).cast("bigint")
    low = nodes.filter("band = 0").withColumns({"in_children": none, "in_leaves": F.col("own_leaf"), "in_saved": F.col("own_saved")})
    low = durable(time_forward(low.withColumns({"s1": F.col("shard.k1"), "s2": F.col("shard.k2")}), "s1", "s2", most=most), "low-totals")
    high = nodes.filter("band > 0")
    from_low = durable(_sent(low.filter("top")), "low-messages")
    # Across shard roots: a shard is one node of the tree of shards, its parent the shard its top node hangs on.
    fed = durable(_receiving(high, from_low), "fed-nodes")
    sums = fed.groupBy("shard").agg(F.sum("in_leaves").alias("in_leaves"), F.sum("in_saved").alias("in_saved"))
    above = high.select(F.col("depth").alias("parent_depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("shard").alias("up"))
    heads = fed.filter("top").select("depth", "k1", "k2", "conv_id", "parent_depth", "p1", "p2", "n_convs", "shard")
    tree = heads.join(sums, "shard").join(above, ["parent_depth", "p1", "p2"], "left")
    tree = tree.select(
        "depth", "k1", "k2", "conv_id", F.coalesce("up.depth", F.lit(-1)).alias("parent_depth"),
        F.coalesce("up.k1", none).alias("p1"), F.coalesce("up.k2", none).alias("p2"), "n_convs",
        F.col("up").isNull().alias("top"), none.alias("in_children"), "in_leaves", "in_saved",
    )
    whole = time_forward(tree, most=most).select("depth", "k1", "k2", "n_leaves", "saved_tokens")
    hung = heads.filter("depth > 0").join(whole, ["depth", "k1", "k2"])
    from_high = _sent(hung)
    both = from_low.unionByName(from_high).groupBy("depth", "k1", "k2").agg(
        *[F.sum(c).alias(c) for c in ("in_children", "in_leaves", "in_saved")]
    )
    up = _receiving(high, both).withColumns({"s1": F.col("shard.k1"), "s2": F.col("shard.k2"), "s0": F.col("shard.depth")})
    return low.unionByName(time_forward(up, "s0", "s1", "s2", most=most))


def trie(conversations: DataFrame, shards: int = SHARDS, most: int = _IN_MEMORY) -> DataFrame:
    """A row per node of the trie: smallest member, place, parent's smallest member, totals and who ends there.

    Runs jobs while it is called.
    """
    paths = places(conversations)
    place = ["depth", "k1", "k2"]
    done = durable(totals(paths, shards, most), "trie-totals")
    parents = done.select(
        F.col("depth").alias("parent_depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    full = done.join(ends(paths), place, "left").join(parents, ["parent_depth", "p1", "p2"], "left")
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
