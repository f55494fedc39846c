"""Dataset versions: fingerprints, differences, stable positions."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.session import durable

_CHUNK = 15  # hex digits: 60 bits, so sums of up to 10**19 rows fit decimal(38)
_CHUNKS = 4


def _chunk_sums(digest: Column) -> list[Column]:
    return [
        F.sum(F.conv(F.substring(digest, 1 + i * _CHUNK, _CHUNK), 16, 10).cast("decimal(20,0)"))
        .cast("decimal(38,0)")
        .alias(f"s{i}")
        for i in range(_CHUNKS)
    ]


def fingerprint(df: DataFrame, content: Column, by: str = "split") -> DataFrame:
    """``(by, rows, digest)``: the same for the same rows in any order or partitioning.

    Sums of pieces of each row's SHA-256 merge in any order, so no task sees more than
    partial sums; the digest is a SHA-256 over the sums.
    """
    sums = (
        df.select(by, F.sha2(content, 256).alias("d"))
        .groupBy(by)
        .agg(F.count("*").alias("rows"), *_chunk_sums(F.col("d")))
    )
    joined = F.concat_ws(":", "rows", *[F.col(f"s{i}").cast("string") for i in range(_CHUNKS)])
    return sums.select(by, "rows", F.sha2(joined, 256).alias("digest"))


def version_digest(prints: DataFrame) -> str:
    """One digest over all fingerprints, however many parts there are. An action."""
    parts = prints.select(F.sha2(F.concat_ws("|", *prints.columns), 256).alias("d"))
    sums = parts.agg(F.count("*").alias("n"), *_chunk_sums(F.col("d"))).first()
    return hashlib.sha256(":".join(map(str, sums)).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def is_committed(spark: SparkSession, path: str) -> bool:
    return _exists(spark, os.path.join(path, "commit", "_SUCCESS"))


def write_version(tables: DataFrame | dict[str, DataFrame], base: str, prints: DataFrame) -> str:
    """Writes tables under ``version=<digest>`` and commits them; an existing version is left as it is.

    The digest covers the fingerprints, which are those of the rows of all tables (per split,
    say, and of the vocabulary). Each table goes to a fresh folder and its rows are counted
    there; only if they are as many as the fingerprints say is the commit record written, as
    the last step. What a failed attempt leaves has no commit record and counts as absent.
    Runs jobs while it is called.
    """
    tables = {"data": tables} if isinstance(tables, DataFrame) else tables
    spark = prints.sparkSession
    path = os.path.join(base, f"version={version_digest(prints)}")
    if is_committed(spark, path):
        return path
    written = []
    for name, df in tables.items():
        folder = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(os.path.join(path, folder))
        written.append((name, folder, spark.read.schema(df.schema).parquet(os.path.join(path, folder)).count()))
    expected = prints.agg(F.sum("rows")).first()[0] or 0
    if sum(n for _, _, n in written) != expected:
        raise RuntimeError(f"{path}: {written} written, {expected} rows expected")
    record = spark.createDataFrame(written, "name string, folder string, rows bigint").coalesce(1)
    record.write.mode("overwrite").json(os.path.join(path, "commit"))
    return path


def read_version(spark: SparkSession, path: str, name: str = "data") -> DataFrame:
    """A table of a committed version."""
    if not is_committed(spark, path):
        raise FileNotFoundError(f"{path} has no commit record")
    record = spark.read.schema("name string, folder string, rows bigint").json(os.path.join(path, "commit"))
    folder = record.filter(F.col("name") == name).first()["folder"]
    return spark.read.parquet(os.path.join(path, folder))


def fingerprint_changes(old: DataFrame, new: DataFrame, by: str = "split") -> DataFrame:
    """Parts that appeared, vanished or changed between two fingerprints."""
    a = old.select(by, F.col("rows").alias("old_rows"), F.col("digest").alias("old_digest"))
    b = new.select(by, F.col("rows").alias("new_rows"), F.col("digest").alias("new_digest"))
    both = a.join(b, by, "full_outer")
    change = (
        F.when(F.col("old_digest").isNull(), "added")
        .when(F.col("new_digest").isNull(), "removed")
        .when(F.col("old_digest") == F.col("new_digest"), "same")
        .otherwise("changed")
    )
    return both.select(by, "old_rows", "new_rows", change.alias("change"))


def version_diff(old: DataFrame, new: DataFrame, content: Column) -> DataFrame:
    """Records added, removed and kept, counting repeats: one shuffle of hashes.

    Equal to ``exceptAll`` both ways plus ``intersectAll`` on the hashes.
    """

    def hashes(df: DataFrame, is_new: int) -> DataFrame:
        return df.select(F.sha2(content, 256).alias("h"), F.lit(is_new).alias("is_new"))

    both = (
        hashes(old, 0)
        .unionByName(hashes(new, 1))
        .groupBy("h")
        .agg(F.count_if(F.col("is_new") == 0).alias("o"), F.count_if(F.col("is_new") == 1).alias("n"))
    )
    zero = F.lit(0)
    return both.agg(
        F.coalesce(F.sum(F.greatest(F.col("n") - F.col("o"), zero)), zero).alias("added"),
        F.coalesce(F.sum(F.greatest(F.col("o") - F.col("n"), zero)), zero).alias("removed"),
        F.coalesce(F.sum(F.least("o", "n")), zero).alias("kept"),
    )


class Buckets:
    """A version's content hashes in folders by their first digits, and a digest for each folder.

    Two versions are compared folder by folder: rows are read only where the digests differ, so
    a small change to a large dataset costs a small read.
    """

    _DIGESTS = "bucket string, rows bigint, digest string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def write(cls, df: DataFrame, content: Column, path: str, digits: int = 2) -> Buckets:
        """Stores the hashes of ``df`` in ``16 ** digits`` folders, then the digests. An action.

        Tasks write ranges of hashes, so a folder has as many files as its hashes fill; a text that
        makes up most of the rows is one row with its number of copies.
        """
        spark = df.sparkSession
        counted = df.select(F.sha2(content, 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        counted.repartitionByRange(parts, "h").withColumn("bucket", F.substring("h", 1, digits)).write.partitionBy("bucket").parquet(f"{path}/hashes")
        made = cls(spark, path)
        rows = made._hashes().select("bucket", "n", F.sha2(F.concat_ws(":", "h", "n"), 256).alias("d"))
        sums = rows.groupBy("bucket").agg(F.sum("n").alias("rows"), *_chunk_sums(F.col("d")))
        joined = F.concat_ws(":", *[F.col(f"s{i}").cast("string") for i in range(_CHUNKS)])
        sums.select("bucket", "rows", F.sha2(joined, 256).alias("digest")).coalesce(1).write.parquet(f"{path}/digests")
        return made

    def _hashes(self) -> DataFrame:
        return self.spark.read.schema("h string, n bigint, bucket string").parquet(f"{self.path}/hashes")

    def digests(self) -> DataFrame:
        return self.spark.read.schema(self._DIGESTS).parquet(f"{self.path}/digests")

    def changed(self, other: Buckets) -> list[str]:
        """The folders in which two versions differ; there are few folders, whatever the rows. An action."""
        mine, theirs = (b.digests().select("bucket", F.col("digest").alias(n)) for b, n in ((self, "a"), (other, "b")))
        both = mine.join(theirs, "bucket", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        return sorted(r.bucket for r in both.select("bucket").collect())

    def rows_in(self, buckets: list[str]) -> DataFrame:
        return self._hashes().filter(F.col("bucket").isin(buckets))

    def diff(self, new: Buckets) -> DataFrame:
        """``(added, removed, kept)`` from this version to ``new``, as :func:`version_diff` counts them. An action."""
        buckets = self.changed(new)
        a, b = (v.rows_in(buckets).select("h", F.col("n").alias(n)) for v, n in ((self, "o"), (new, "n")))
        zero = F.lit(0).cast("bigint")
        both = a.join(b, "h", "full_outer").select(F.coalesce("o", zero).alias("o"), F.coalesce("n", zero).alias("n"))
        same = self.digests().filter(~F.col("bucket").isin(buckets)).agg(F.coalesce(F.sum("rows"), zero)).scalar()
        return both.agg(
            F.coalesce(F.sum(F.greatest(F.col("n") - F.col("o"), zero)), zero).alias("added"),
            F.coalesce(F.sum(F.greatest(F.col("o") - F.col("n"), zero)), zero).alias("removed"),
            (F.coalesce(F.sum(F.least("o", "n")), zero) + same).alias("kept"),
        )


def number_rows(df: DataFrame, key: str, out: str, start: Column | int = 0) -> DataFrame:
    """Contiguous numbers in ``key`` order without sorting everything in one task.

    Rows are range-partitioned and sorted, and each keeps its partition and its place in
    it. That is written down first, because a second pass over the range partitioning
    need not cut at the same places. The offsets then have one row per partition.
    """
    placed = durable(
        df.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    first = F.lit(start) if isinstance(start, int) else start
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(out, (first + F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_part", "_place", "_offset")
    )
