"""Shards along a Hilbert curve over quantised metadata, so that files can be pruned by any of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.common import packed
from corpuskit.session import durable

SHARDS = 16
BITS = 5
_DIMENSIONS = 3


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _rotated(x: int, by: int) -> int:
    by %= _DIMENSIONS
    return ((x >> by) | (x << (_DIMENSIONS - by))) & (2**_DIMENSIONS - 1)


def curve_steps() -> tuple[list[int], list[int]]:
    """For each state and octant: the octant's place on the curve and the state inside it.

    A state is the corner where the curve enters a cube and the axis along which it leaves
    it. Octants follow the Gray code, turned to that corner and axis; a child cube enters at
    the corner its parent's path reaches it by.
    """
    digits, states = [], []
    for state in range(2**_DIMENSIONS * _DIMENSIONS):
        entry, axis = divmod(state, _DIMENSIONS)
        for octant in range(2**_DIMENSIONS):
            turned = _rotated(octant ^ entry, axis + 1)
            place = next(i for i in range(2**_DIMENSIONS) if _gray(i) == turned)
            enter = 0 if place == 0 else _gray(2 * ((place - 1) // 2))
            changed = place if place % 2 else place - 1  # whose trailing ones give the axis
            inner = 0 if place == 0 else (len(bin(changed)) - len(bin(changed).rstrip("1"))) % _DIMENSIONS
            digits.append(place)
            states.append((entry ^ _rotated(enter, -(axis + 1))) * _DIMENSIONS + (axis + inner + 1) % _DIMENSIONS)
    return digits, states


def curve_index(x: Column, y: Column, z: Column, bits: int = BITS) -> Column:
    """Place of cell ``(x, y, z)`` on the Hilbert curve through a cube of ``2^bits`` cells a side."""
    digits, states = (F.array(*[F.lit(v) for v in values]) for values in curve_steps())

    def step(acc: Column, bit: Column) -> Column:
        octant = F.lit(0)
        for i, c in enumerate("xyz"):
            one = F.getbit(acc[c], bit)
            octant = octant + one.cast("int") * (1 << i)
        slot = acc["state"] * 8 + octant
        return F.struct(
            acc["x"].alias("x"), acc["y"].alias("y"), acc["z"].alias("z"),
            F.get(states, slot).alias("state"), (acc["index"] * 8 + F.get(digits, slot)).cast("bigint").alias("index"),
        )

    start = F.struct(
        x.cast("int").alias("x"), y.cast("int").alias("y"), z.cast("int").alias("z"),
        F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("index"),
    )
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["index"])


def cells(size: Column, *labels: Column) -> list[Column]:
    """Quantised metadata: size on a logarithmic scale, and each label in one of 32 classes."""
    top = 2**BITS - 1
    scaled = F.least(F.floor(F.log2(size.cast("double")) * 1.5), F.lit(top))
    hashed = [F.pmod(F.xxhash64(F.coalesce(label.cast("string"), F.lit(""))), F.lit(top + 1)) for label in labels]
    return [F.greatest(scaled, F.lit(0)).cast("int"), *[h.cast("int") for h in hashed]]


def shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", labels: tuple[str, str] = ("source", "lang"),
    n_shards: int = SHARDS,
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` for every row of ``docs``.

    Rows are ordered by curve index, then by id, checksum and size, and the order is cut into
    ``n_shards`` runs whose row counts differ by one at most; ``slot`` counts from 0 within a
    run. Null text: size 1, checksum 0. Null labels count as empty, a null id sorts first.
    Repeated rows take places next to each other; an empty table gives no rows.

    Only ids and metadata are sorted. A crowded curve cell is split between tasks, as the
    range partitioning cuts by id as well; offsets have one row per task. Runs jobs while
    it is called.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = (F.octet_length(content) + 1).cast("bigint")
    narrow = packed(
        docs,
        doc_id=F.col(f"`{doc_id}`"),
        size=size,
        text_crc32=F.crc32(content.cast("binary")),
        curve=curve_index(*cells(size, *[F.col(f"`{c}`") for c in labels])),
    ).drop("row")
    order = ["curve", "doc_id", "text_crc32", "size"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        durable(narrow, "metadata")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "curve-order",
    )
    # One row per task, whatever the size of the table.
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0))
    offsets = (
        placed.groupBy("part").agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"), F.sum("n").over(everywhere).alias("total"))
    )
    # The first `extra` runs hold one row more than the others; together they hold `wide` rows.
    ranked = placed.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", "curve",
        (F.col("offset") + F.col("place")).alias("rank"),
        F.expr(f"total div {n_shards}").alias("base"),
        (F.col("total") % n_shards).alias("extra"),
    ).withColumn("wide", F.col("extra") * (F.col("base") + 1))
    run = "IF(rank < wide, rank div (base + 1), extra + (rank - wide) div greatest(base, 1))"
    start = "IF(run < extra, run * (base + 1), wide + (run - extra) * base)"
    return ranked.withColumn("run", F.expr(run)).select(
        "doc_id", "size", "text_crc32", "curve",
        F.col("run").cast("int").alias("shard"), (F.col("rank") - F.expr(start)).cast("bigint").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", **how) -> None:
    """``docs`` as Parquet under ``path/shard=N``, each file a run of the curve.

    Rows meet their shard by id, checksum and size, so texts move once; rows equal in all three go
    to one shard, the first of theirs, each once. Files are cut by curve and id, so a crowded cell of
    the curve fills several. A label is one of 32 classes by hash: a file's classes are few, but a
    class holds several labels. Null labels count as empty. A column ``shard`` of the input gives way.
    """
    placed = shards(docs, doc_id, text, **how).groupBy(
        F.col("doc_id").alias("s_id"), F.col("text_crc32").alias("s_crc"), F.col("size").alias("s_size")
    ).agg(F.min(F.struct("shard", "curve")).alias("to"))
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = packed(
        docs, own_id=F.col(f"`{doc_id}`"), crc=F.crc32(content.cast("binary")), own_size=(F.octet_length(content) + 1).cast("bigint")
    )
    same = rows.own_id.eqNullSafe(placed.s_id) & (rows.crc == placed.s_crc) & (rows.own_size == placed.s_size)
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "shard"]
    out = rows.join(placed, same).select(*own, F.col("to.shard").alias("_shard"), F.col("to.curve").alias("_curve"), F.col("own_id").alias("_id"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_shard", "_curve", "_id"]
    dealt = out.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_curve", "_id")
    dealt.withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)
