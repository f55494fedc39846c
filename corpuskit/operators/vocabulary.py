"""A vocabulary learned from a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit import fixed
from corpuskit.session import durable


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Occurrences per token; counted within each task before the shuffle.

    The outer form of explode: for the plain one Spark adds a filter on the array's size,
    pushes it down, and tokenises every text a second time to evaluate it.
    """
    each = df.select(F.explode_outer(tokens).alias("token")).filter(F.col("token").isNotNull())
    return each.groupBy("token").agg(F.count("*").alias("n"))


def first_of(rows: DataFrame, column: str, n: int, group: int = 1 << 16) -> DataFrame:
    """The ``n`` first values of a column of distinct texts, in order of their characters.

    Rows are counted by their first characters, and of the prefixes in order all that lie wholly
    among the first ``n`` are taken; the one at the cut is looked at more closely, two characters
    more each time, until it holds no more than ``group`` rows. Only those are put in order, so
    no task gets more than ``group`` of them however many rows there are. Runs jobs while it is called.
    """
    taken, rest, room, length = rows.limit(0), rows, n, 2
    while room > 0:
        prefix = F.substring(column, 1, length)
        counted = rest.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("k"))
        # A row per prefix that occurs.
        before = F.sum("k").over(Window.partitionBy(F.lit(0)).orderBy("prefix")) - F.col("k")
        last = counted.withColumn("before", before).filter(F.col("before") < room).orderBy(F.desc("prefix")).first()
        if last is None:
            return taken
        cut = F.lit(last["prefix"])
        if last["before"] + last["k"] <= room:
            return taken.unionByName(rest.filter(prefix <= cut))
        taken = taken.unionByName(rest.filter(prefix < cut))
        rest, room = rest.filter(prefix == cut), room - last["before"]
        if last["k"] <= group:
            place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(column))
            return taken.unionByName(rest.withColumn("_place", place).filter(F.col("_place") <= room).drop("_place"))
        length += 2
    return taken


def learn_vocabulary(df: DataFrame, tokens: str = "tokens", size: int = fixed.VOCABULARY_SIZE) -> DataFrame:
    """``(id, token)``: special tokens first, then the most frequent tokens, ties by token.

    ``size`` counts the specials and is the model's vocabulary size. First the count at rank
    ``size`` is found from how many tokens have each count; then tokens above it are taken, and of
    those at it the first by :func:`first_of`, however many there are. Only ``size`` rows are
    numbered. Runs jobs while it is called.
    """
    specials = fixed.SPECIAL_TOKENS
    if size <= len(specials):
        raise ValueError("size must exceed the number of special tokens")
    wanted = size - len(specials)
    counted = durable(token_counts(df, tokens), "token-counts")
    # One row per distinct count: at most the square root of twice the tokens of the corpus.
    per_count = counted.groupBy("n").agg(F.count("*").alias("k"))
    above = F.sum("k").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"))) - F.col("k")
    cut = per_count.withColumn("above", above).filter(F.col("above") < wanted).orderBy("n").first()
    top = counted
    if cut and cut["above"] + cut["k"] > wanted:
        tied = counted.filter(F.col("n") == cut["n"])
        top = counted.filter(F.col("n") > cut["n"]).unionByName(first_of(tied, "token", wanted - cut["above"]))
    elif cut:
        top = counted.filter(F.col("n") >= cut["n"])
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "token"))
    learned = top.select((place - 1 + len(specials)).cast("int").alias("id"), "token")
    fixed_rows = df.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate(specials)], "id int, token string"
    )
    return fixed_rows.unionByName(learned)


def vocabulary_properties(vocabulary: DataFrame) -> DataFrame:
    """Vocabulary size and the ids of the special tokens."""
    return vocabulary.agg(
        F.count("*").alias("vocab_size"),
        *[
            F.max(F.when(F.col("token") == t, F.col("id"))).alias(name)
            for name, t in zip(("pad_id", "unk_id", "bos_id", "eos_id"), fixed.SPECIAL_TOKENS)
        ],
    )
