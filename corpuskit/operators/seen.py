"""What has been seen before, as a Bloom filter that is built, merged and asked in parts.

A filter is a table of bitmaps, one for each bucket of the hash, so it can be of any size: it is
aggregated within tasks, merged by an aggregate, and rows to be looked up meet the bitmap of their
own bucket only. It never denies what it holds; what it seems to hold is compared exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators.dedup import first_occurrences
from corpuskit.session import durable

# The bitmaps of Spark's bitmap functions have this many bits.
BITS = 1 << 15
# With this many keys a bucket, about one unseen key in a hundred seems seen.
KEYS_PER_BUCKET = BITS // 10
_PROBES = 4
# Small enough to be sent to all tasks: 4 MB of bitmaps.
_SENT_BUCKETS = 1024


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def _places(key: Column) -> Column:
    """The bits of a key in the bitmap of its bucket."""
    h = F.xxhash64(F.lit(1), key)
    return F.array(*[F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BITS - 1)) for i in range(_PROBES)])


def _has_bit(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


@dataclass(frozen=True)
class SeenFilter:
    """``table`` is ``(bucket, bits)`` for the buckets that hold any key of ``buckets`` there are."""

    table: DataFrame
    buckets: int

    @classmethod
    def of(cls, keys: DataFrame, column: str, buckets: int) -> SeenFilter:
        """The keys of a column; plan a bucket for every ``KEYS_PER_BUCKET`` distinct keys that are to come."""
        key = F.col(column)
        spread = keys.filter(key.isNotNull()).select(_bucket(key, buckets).alias("bucket"), F.explode(_places(key)).alias("place"))
        return cls(spread.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), buckets)

    @classmethod
    def sent(cls, keys: DataFrame, column: str) -> SeenFilter:
        """A filter of the fixed size that goes to every task: of 3 million keys it lets a hundredth of the others pass, of more more."""
        return cls.of(keys, column, _SENT_BUCKETS)

    def merged(self, other: SeenFilter) -> SeenFilter:
        if self.buckets != other.buckets:
            raise ValueError("filters with different numbers of buckets cannot be merged")
        both = self.table.unionByName(other.table)
        return SeenFilter(both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")), self.buckets)

    def possible(self, rows: DataFrame, column: str, send: bool = False) -> DataFrame:
        """The rows whose key the filter may hold: all that it does, and about a hundredth of the others.

        ``send`` gives the filter to every task, for filters of a small fixed number of buckets.
        """
        table = self.table.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
        asked = rows.withColumn("_bucket", _bucket(F.col(column), self.buckets))
        met = asked.join(F.broadcast(table) if send else table, "_bucket")
        return met.filter(F.forall(_places(F.col(column)), lambda p: _has_bit(F.col("_bits"), p))).select(*rows.columns)

    def save(self, path: str) -> None:
        self.table.withColumn("buckets", F.lit(self.buckets)).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SeenFilter:
        table = spark.read.schema("bucket bigint, bits binary, buckets int").parquet(path)
        first = table.select("buckets").first()
        return cls(table.select("bucket", "bits"), first.buckets if first else 1)


def known_hits(new: DataFrame, known: DataFrame, seen: SeenFilter, hash_column: str = "content_hash") -> DataFrame:
    """The hashes of ``new`` that ``known`` has. An action.

    ``seen`` is the filter of ``known`` (of more, at need). Of the new hashes only those it may
    hold go on; of the known ones only those that may be among these leave their task, so what
    is shuffled is about the number of repeats, not the size of what is known.
    """
    maybe = durable(seen.possible(new.select(hash_column), hash_column).distinct(), "maybe-seen")
    wanted = SeenFilter.sent(maybe, hash_column)
    return maybe.join(wanted.possible(known.select(hash_column), hash_column, send=True), hash_column, "left_semi")


def add_increment(known: DataFrame, new: DataFrame, content: Column, *order: str, seen: SeenFilter) -> tuple[DataFrame, SeenFilter]:
    """``known`` with the rows of ``new`` not seen before, each content once, and the filter of both. An action."""
    fresh = durable(first_occurrences(new, content, *order), "increment")
    hits = known_hits(fresh, known, seen)
    added = fresh.join(hits, "content_hash", "left_anti")
    return known.unionByName(added), seen.merged(SeenFilter.of(added, "content_hash", seen.buckets))
