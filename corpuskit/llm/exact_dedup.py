"""Exact duplicates: local, salted and global combining of equal texts.

Texts are equal when they are identical after lower-casing A-Z. Each task first combines its own
equal texts, so a text that makes up a third of the corpus leaves a task as one row. Those rows
meet by digest and a salt, and what is left of each salted group meets by digest alone. The
digest only deals rows out: every stage groups by the whole content, so texts that share a digest
stay apart. Documents then learn their group by a join on the digest, narrow on both sides,
whose hot keys adaptive execution splits; the documents of a digest that several texts share
(none with SHA-256) join on the content as well.

* Null and missing texts count as empty; empty texts are equal to each other.
* The row with the largest ``doc_id`` stays; rows of one group that tie at it (one id given
  twice, or no row with an id) all count as the one that stays. A null id is less than any other.
* Very long texts are grouped like others; aggregation spills where a task's texts exceed memory.
* An empty table gives no rows; further columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.session import durable

# A text that every one of n tasks holds meets in this many groups of n / SALTS rows each, and then SALTS rows meet.
SALTS = 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def combined(keyed: DataFrame) -> DataFrame:
    """``(digest, content, keep_id, group_size)``, a row per text of ``keyed(doc_id, digest, content)``."""
    local = keyed.withColumn("salt", F.spark_partition_id() % SALTS)
    salted = local.groupBy("digest", "salt", "content").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # At most SALTS rows a text are left; dealt by digest alone, texts of one digest can be counted in place.
    meeting = salted.select("digest", "content", "keep_id", "group_size").repartition("digest")
    return meeting.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs(doc_id, text)``.

    ``keep_id`` is the id of the row that stays of the equal texts, ``group_size`` their number.
    ``digest`` may be any function of the content: a poor one costs time, not correctness.
    Runs jobs while it is called.
    """
    content = docs.select("doc_id", normalised(F.col("text")).alias("content"))
    keyed = content.withColumn("digest", digest(F.col("content")))
    found = combined(keyed).groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    found = durable(found, "exact-groups")
    alone = found.filter("texts = 1").drop("texts")
    shared = found.filter("texts > 1").select("digest")
    out = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    narrow = keyed.select("doc_id", "digest", sha256(F.col("content")).alias("text_sha256"))
    judged = narrow.join(alone, "digest").select(*out)
    if shared.isEmpty():
        return judged
    clashing = keyed.join(shared, "digest", "left_semi")
    apart = clashing.join(combined(clashing), ["digest", "content"]).withColumn("text_sha256", sha256(F.col("content")))
    return judged.unionByName(apart.select(*out))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that tie, one.

    Runs jobs while it is called.
    """
    text = normalised(F.col("text"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text.alias("content"))
    keyed = keyed.withColumn("digest", sha256(F.col("content")))
    best = durable(combined(keyed.select(F.col("id").alias("doc_id"), "digest", "content")).select("digest", "keep_id"), "exact-kept")
    same = (F.col("keyed.digest") == F.col("best.digest")) & F.col("id").eqNullSafe(F.col("keep_id"))
    stay = keyed.alias("keyed").join(best.alias("best"), same, "left_semi").dropDuplicates(["digest", "content"])
    return stay.select(*[F.col("row")[c].alias(c) for c in docs.columns])
