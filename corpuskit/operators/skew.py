"""Joins whose hot keys are split over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import durable

ROWS_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, on: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``(on, _fan)``: keys with more than ``rows_per_task`` rows, with the tasks each should fill.

    All of them: keys are counted exactly, within tasks before the shuffle. There can be no
    more of them than ``rows / rows_per_task``, which bounds what is broadcast. A null key
    joins with nothing and is left out.
    """
    counted = df.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_task)
    return durable(counted.select(on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_fan")), "hot-keys")


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: str,
    *,
    spread_by: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """:func:`skewed_join` for plans that adaptive execution leaves alone, as where it is switched off.

    Rows with a hot key are dealt out by a hash of ``spread_by`` (a row id), and the
    ``small`` rows of just those keys are repeated, once per share. Without hot keys this
    is the plain join. ``large`` is read once to look for them, so it should be a table or
    a cheap projection of one; the count is an action. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    hot = hot_keys(large, on, rows_per_task)
    if hot.isEmpty():
        return large.join(small, on, how)
    fans = F.broadcast(hot)
    fan = F.coalesce("_fan", F.lit(1))
    dealt = large.join(fans, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), fan).cast("int"))
    repeated = small.join(fans, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1)))
    return dealt.drop("_fan").join(repeated.drop("_fan"), [on, "_salt"], how).drop("_salt")


def skewed_join(large: DataFrame, small: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join where some keys of ``large`` may hold a large share of its rows; ``inner`` or ``left``.

    Adaptive execution sees the sizes of the shuffled partitions and splits those that are too
    large, reading the other side's partition once per part; nothing has to be counted before.
    It can do so only where both sides come straight out of a shuffle of the join's own, so the
    join has a second key, a hash of the first, by which neither side is partitioned yet - not
    even one that was just grouped by ``on``. Null keys join with nothing.

    Needs ``spark.sql.adaptive.enabled`` and ``spark.sql.adaptive.skewJoin.enabled``, both on by default.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keyed = [df.withColumn("_hash", F.xxhash64(on)) for df in (large, small)]
    return keyed[0].join(keyed[1], [on, "_hash"], how).drop("_hash")
