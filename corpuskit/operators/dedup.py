"""Exact duplicates: within a corpus, and against what was seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions.text import content_hash


def first_occurrences(
    df: DataFrame,
    content: Column,
    *order: str,
    keep_empty: bool = False,
    hash_column: str = "content_hash",
) -> DataFrame:
    """Of rows with equal content keep the first in ``order``; adds the content hash.

    Ranking to one lets Spark drop all but one row per hash *before* the shuffle
    (partial group limit), so a text that makes up a third of the corpus sends one row
    per task, and every row is read and hashed once. With ``keep_empty`` rows without
    content are no duplicates of each other.
    """
    identity: list[Column] = [F.col(hash_column)]
    if keep_empty:
        identity.append(F.when(content == "", F.struct(*order)))
    ranked = df.withColumn(hash_column, content_hash(content)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*identity).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def unseen(new: DataFrame, known: DataFrame, hash_column: str = "content_hash") -> DataFrame:
    """Rows of ``new`` whose hash is not in ``known``.

    ``new`` comes from :func:`first_occurrences`, so no hash repeats in it and the join
    cannot be skewed by it; the other side carries hashes only.
    """
    return new.join(known.select(hash_column), hash_column, "left_anti")


def add_increment(known: DataFrame, new: DataFrame, content: Column, *order: str) -> DataFrame:
    """``known`` followed by the rows of ``new`` not seen before, each content once."""
    fresh = unseen(first_occurrences(new, content, *order), known)
    return known.unionByName(fresh)
